import os
import uuid

import pytest
from pyspark.sql import functions as F

from docflow import config
from docflow.operators import registry
from docflow.plans import jobs
from docflow.sources import files, ledger

EN = "The house by the sea and the garden of that man were old and it was for the cat. " * 4


@pytest.fixture
def store(spark, tmp_path):
    def run(df):
        path = f"{tmp_path}/steps/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return run


@pytest.fixture
def root(tmp_path):
    src = tmp_path / "to_translate"
    src.mkdir()
    (src / "a b+c%20.pdf").write_text(f"{EN} a")
    (src / "b.pdf").write_text(f"{EN} b")
    (src / "copy.pdf").write_text(f"{EN} b")
    return tmp_path


def altered(path):
    """Other bytes of the same length under the same time: whoever reads the file sees another content."""
    stat = path.stat()
    path.write_bytes(b"?" * stat.st_size)
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))


def by_name(df):
    return {r.original_name: r for r in df.collect()}


def test_only_new_files_are_read(spark, root, store):
    c = config.load(None, str(root))
    step = lambda **k: by_name(jobs.extract(spark, c, f"{root}/r", store, engine="text", **k))
    first = step()
    assert {n: (r.step1.status, r.duplicates) for n, r in first.items()} == {"a b+c%20.pdf": ("done", []), "b.pdf": ("done", ["copy.pdf"])}
    held = ledger.load(spark, f"{root}/r-files")
    assert held.count() == 3 and held.select("sha256").distinct().count() == 2
    for p in (root / "to_translate").iterdir():
        altered(p)
    commits = registry._state(spark, f"{root}/r")[0], registry._state(spark, f"{root}/r-files")[0]
    assert step() == first  # nothing is read, nothing is written
    assert commits == (registry._state(spark, f"{root}/r")[0], registry._state(spark, f"{root}/r-files")[0])
    (root / "to_translate/new.pdf").write_text(f"{EN} new")
    second = step()
    assert set(second) == {*first, "new.pdf"} and second["new.pdf"].step1.status == "done" and {n: second[n] for n in first} == first
    (root / "to_translate/b.pdf").write_text(f"{EN} other and longer")
    step()
    assert registry.load(spark, f"{root}/r").count() == 4  # its length tells; the content before stays known


def test_a_limit_reads_what_is_due(spark, root, store):
    c = config.load(None, str(root))
    got = by_name(jobs.extract(spark, c, f"{root}/r", store, engine="text", limit=1))
    assert {n: r.step1 and r.step1.status for n, r in got.items()} == {"a b+c%20.pdf": "done", "b.pdf": None}
    altered(root / "to_translate/a b+c%20.pdf")
    got = by_name(jobs.extract(spark, c, f"{root}/r", store, engine="text", limit=1))
    assert {n: r.step1.status for n, r in got.items()} == {"a b+c%20.pdf": "done", "b.pdf": "done"}


def test_a_lost_run_is_made_good(spark, root, store, monkeypatch):
    """The driver is lost after the ledger has the files and before the registry has them."""
    c = config.load(None, str(root))
    with monkeypatch.context() as m:
        m.setattr(jobs, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            jobs.extract(spark, c, f"{root}/r", store, engine="text")
    assert ledger.load(spark, f"{root}/r-files").count() == 3
    assert {r.step1.status for r in jobs.extract(spark, c, f"{root}/r", store, engine="text").collect()} == {"done"}


def test_jobs_keep_what_others_commit_meanwhile(spark, root, store):
    """While extract runs, another writer adds an entry and a duplicate's name; both stay."""
    c = config.load(None, str(root))
    other = spark.createDataFrame([("z" * 64, "other.pdf", "p")], "sha256 string, name string, path string")

    def slow(df, done=[]):
        if not done and "error" in df.columns:
            done.append(registry.update(spark, f"{root}/r", lambda state: registry.upserted(state, other)))
        return store(df)

    got = by_name(jobs.extract(spark, c, f"{root}/r", slow, engine="text"))
    assert set(got) == {"other.pdf", "a b+c%20.pdf", "b.pdf"} and got["b.pdf"].step1.status == "done" and got["other.pdf"].step1 is None


def test_translate_and_summaries_read_what_is_due(spark, root, store):
    c = config.load(None, str(root))
    jobs.extract(spark, c, f"{root}/r", store, engine="text")
    turn = lambda **k: by_name(jobs.translate(spark, c, f"{root}/r", f"{root}/blocks", store, "upper", slots=2, **k))
    assert turn(limit=1)["b.pdf"].translation_md is None
    (root / "step1_md/a b+c%20/a b+c%20.md").unlink()  # done: not looked at again
    assert {n: r.translation_md.status for n, r in turn().items()} == {"a b+c%20.pdf": "done", "b.pdf": "done"}
    tell = lambda **k: {r.outcome: r.n for r in jobs.summaries(spark, c, f"{root}/r", store, "latin", **k).collect()}
    assert tell() == {"summarized": 2}
    before = {r.sha256: r.summary for r in registry.load(spark, f"{root}/r").collect()}
    for p in (root / "translated_md").rglob("*.md"):
        altered(p)
    assert tell() == {"cached": 2} and {r.sha256: r.summary for r in registry.load(spark, f"{root}/r").collect()} == before
    (root / "translated_md/b/b.he.md").write_text(f"{EN} It was a new day. " * 3)
    assert tell() == {"cached": 1, "summarized": 1}


def test_a_missing_source_is_passed_over(spark, root, store):
    c = config.load(None, str(root))
    jobs.extract(spark, c, f"{root}/r", store, engine="text")
    (root / "step1_md/b/b.md").unlink()
    got = by_name(jobs.translate(spark, c, f"{root}/r", f"{root}/blocks", store, "upper", slots=2))
    assert got["b.pdf"].translation_md is None and got["a b+c%20.pdf"].translation_md.status == "done"


def test_content_by_path(spark, root):
    listed = files.listed(spark, str(root / "to_translate"))
    more = listed.unionByName(spark.createDataFrame([(f"file:{root}/gone.pdf", "gone.pdf", 1)], "path string, name string, length long").withColumn("mtime", F.current_timestamp()))
    got = {r.name: (r.content, r.error) for r in files.with_content(more, text=True).collect()}
    assert got["b.pdf"] == (f"{EN} b", None) and got["gone.pdf"] == (None, "missing") and got["a b+c%20.pdf"][0] == f"{EN} a"
    big = spark.range(100).selectExpr("concat('x', id) as path", "1000L as length")
    assert files._dealt(big, 5000).rdd.getNumPartitions() == 20
    read = files.read_files(more, "text").collect()
    assert sum(r.sha256 is None for r in read) == 1 and len(read) == 4
