import uuid

import pytest

from docflow import config, engines
from docflow.operators.registry import load
from docflow.plans import jobs
from docflow.sources import sinks

EN = "The house by the sea and the garden of that man were old and it was for the cat. " * 4
FILES = "sha256 string, path string, content string"


@pytest.fixture
def store(spark, tmp_path):
    def run(df):
        path = f"{tmp_path}/steps/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return run


def hidden(folder):
    return [p for p in folder.rglob(".*") if p.is_file() and not p.name.endswith(".crc")]


def test_every_file_has_an_outcome(spark, tmp_path):
    (tmp_path / "out/blocked").mkdir(parents=True)
    (tmp_path / "out/wall").write_text("a file")
    df = spark.createDataFrame([("s1", "x/a.md", "é"), ("s2", "../up.md", "no"), ("s3", "wall/b.md", "no"), ("s4", "blocked", "no"), ("s5", "y.md", None)], FILES)
    got = {r.key: r for r in sinks.write_with_outcome(df, f"{tmp_path}/out", f"{tmp_path}/log").collect()}
    assert got["s1"].error is None and (got["s1"].bytes, len(got["s1"].sha256)) == (2, 64) and (tmp_path / "out/x/a.md").read_text("utf-8") == "é"
    assert all(got[k].error for k in ("s2", "s3", "s4", "s5")) and not (tmp_path / "up.md").exists()
    assert "leaves the folder" in got["s2"].error and not hidden(tmp_path / "out")
    errors = {r.sha256: r.why for r in sinks.write_errors(spark.createDataFrame(got.values()), "why").collect()}
    assert set(errors) == {"s2", "s3", "s4", "s5"} and errors["s3"].startswith("not written: wall/b.md: ")


def test_a_run_lost_between_the_steps_is_completed(spark, tmp_path, monkeypatch):
    out, log = tmp_path / "out", f"{tmp_path}/log"
    df = spark.createDataFrame([(f"s{i}", f"d{i}/f.md", f"text {i}") for i in range(6)], FILES)
    with monkeypatch.context() as m:
        m.setattr(sinks, "_finished", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            sinks.write_with_outcome(df, str(out), log)
    assert len(hidden(out)) == 6 and not list(out.rglob("f.md"))
    [staged] = [p for p in hidden(out) if p.parent.name == "d0"]
    staged.rename(out / "d0/f.md")  # one had its name already
    (out / "d1" / staged.name).write_text("left by a lost task")
    hidden(out / "d2")[0].unlink()
    assert sinks.recover(spark, log) == 1 and sinks.recover(spark, log) == 0
    assert sorted(p.parent.name for p in out.rglob("f.md")) == ["d0", "d1", "d3", "d4", "d5"] and not hidden(out)
    before = {p: p.stat().st_mtime_ns for p in out.rglob("f.md")}
    again = {r.key: r.error for r in sinks.write_with_outcome(df, str(out), log).collect()}
    assert set(again.values()) == {None} and len(list(out.rglob("f.md"))) == 6
    assert {p: p.stat().st_mtime_ns for p in before} == before  # what the manifest has is not written again
    changed = df.selectExpr("sha256", "path", "concat(content, '!') as content")
    sinks.write_with_outcome(changed, str(out), log).collect()
    assert (out / "d3/f.md").read_text() == "text 3!"
    sinks.forget(spark, log)
    assert sinks.outcomes(spark, log, str(out)) is None


def blocked(root, *names):
    for n in names:
        path = root / n
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("in the way")


def test_blocked_paths_end_as_errors_and_are_due_again(spark, tmp_path, store):
    root = tmp_path
    (root / "to_translate").mkdir()
    (root / "to_translate/a.pdf").write_text(EN)
    (root / "to_translate/b.pdf").write_text(f"{EN} b")
    c = config.load(None, str(root))
    blocked(root, "step1_md/a", "translated_md/b")
    step = lambda: {r.original_name: r.step1 for r in jobs.extract(spark, c, f"{root}/r", store, engine="text").collect()}
    first = step()
    assert (first["a.pdf"].status, first["a.pdf"].md_relpath, first["b.pdf"].status) == ("error", None, "done") and "not written: a/a.md" in first["a.pdf"].error
    (root / "step1_md/a").unlink()
    assert step()["a.pdf"].status == "done" and (root / "step1_md/a/a.md").exists()

    turn = lambda: {r.original_name: r.translation_md for r in jobs.translate(spark, c, f"{root}/r", f"{root}/blocks", store, "upper", slots=2).collect()}
    first = turn()
    assert (first["b.pdf"].status, first["b.pdf"].translated_md_relpath, first["a.pdf"].status) == ("error", None, "done") and "not written: b/b.he.md" in first["b.pdf"].error
    (root / "translated_md/b").unlink()
    assert turn()["b.pdf"].status == "done" and (root / "translated_md/b/b.he.md").exists()


def test_blocked_pictures_end_as_errors(spark, tmp_path, store):
    (tmp_path / "to_translate").mkdir()
    (tmp_path / "to_translate/a.pdf").write_text(EN)
    engines.EXTRACTORS["drawn"], engines.IMAGES["drawn"] = engines.form_feed_pages, lambda content: iter([("png", b"1")])
    c = config.load(None, str(tmp_path))
    blocked(tmp_path, "step1_md/a/images")
    one = jobs.extract(spark, c, f"{tmp_path}/r", store, engine="drawn").first().step1
    assert one.status == "error" and "images/image-0001.png" in one.error


@pytest.mark.parametrize("way", ["translated/a", "translated/a/a.pdf/x"])
def test_blocked_docx_is_an_error_in_quarantine(spark, tmp_path, store, way):
    (tmp_path / "to_translate").mkdir()
    (tmp_path / "to_translate/a.pdf").write_text(EN)
    c = config.load(None, str(tmp_path))
    blocked(tmp_path, way)
    run = lambda **k: jobs.translate_docx(spark, c, f"{tmp_path}/r", store, "upper", "text", slots=2, **k).first().translation_docx
    first = run()
    assert (first.status, first.translated_relpath) == ("error", None) and "not written: a/" in first.error
    assert (tmp_path / "error_translate/a.pdf").exists() and not (tmp_path / "to_translate/a.pdf").exists()
    (tmp_path / "error_translate/a.pdf").rename(tmp_path / "to_translate/a.pdf")
    (tmp_path / way).rename(tmp_path / "moved")
    for p in (tmp_path / "translated/a/a.he.docx", tmp_path / "translated/a/a.pdf"):
        if p.is_dir():
            p.rmdir()
    assert run(reset_errors=True).status == "translated" and (tmp_path / "translated/a/a.he.docx").is_file()
    assert load(spark, f"{tmp_path}/r").count() == 1
