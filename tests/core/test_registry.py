import json

import pytest
from pyspark.sql import functions as F

from docflow import config
from docflow.operators import registry


def files(spark, *rows):
    return spark.createDataFrame([(s, n, i) for i, (s, n) in enumerate(rows)], "sha256 string, name string, path int")


def test_upsert_lists_each_name_once(spark):
    reg = registry.upsert(registry.empty(spark), files(spark, ("x", "A"), ("x", "B"), ("x", "B"), ("y", "C")))
    reg = registry.upsert(reg, files(spark, ("x", "A"), ("x", "D"), ("z", "E")))
    got = {r.sha256: (r.original_name, r.duplicates, r.page_count, r.has_pictures) for r in reg.collect()}
    assert got == {"x": ("A", ["B", "D"], 0, False), "y": ("C", [], 0, False), "z": ("E", [], 0, False)}
    again = registry.upsert(reg, files(spark, ("x", "A"), ("x", "D"), ("z", "E")))
    assert sorted(map(str, again.collect())) == sorted(map(str, reg.collect()))


def test_versions_and_json(spark, tmp_path):
    path = str(tmp_path / "reg")
    assert registry.load(spark, path).count() == 0
    reg = registry.upsert(registry.empty(spark), files(spark, ("x", "שלום"), ("y", "b")))
    first = registry.save(reg, path)
    second = registry.save(registry.upsert(registry.load(spark, path), files(spark, ("z", "c"))), path)
    assert first != second and registry.current(spark, path) == second and registry.load(spark, path).count() == 3
    registry.write_json(registry.load(spark, path), f"{tmp_path}/json")
    rows = [json.loads(line) for p in sorted((tmp_path / "json").glob("part-*")) for line in p.read_text("utf-8").splitlines()]
    assert [r["sha256"] for r in rows] == ["x", "y", "z"] and rows[0]["original_name"] == "שלום"
    (tmp_path / "log.json").write_text(json.dumps({"q": {"original_name": "n", "step1": {"status": "done", "image_count": 2}, "summary": {"source_fingerprint": {"size": 3, "mtime": 4}}}}))
    one = registry.read_json(spark, str(tmp_path / "log.json")).first()
    assert (one.sha256, one.step1.image_count, one.summary.source_fingerprint.mtime) == ("q", 2, 4)


def test_a_lost_run_leaves_the_version_before(spark, tmp_path, monkeypatch):
    """A driver lost before or after the pointer's rename, or that left half a version, costs nothing; other versions stay."""
    path = str(tmp_path / "reg")
    one = registry.upsert(registry.empty(spark), files(spark, ("x", "a")))
    first = registry.save(one, path)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(registry, "_point", lost)
        for _ in range(2):
            with pytest.raises(OSError, match="lost"):
                registry.save(registry.upsert(one, files(spark, ("y", "b"))), path)
    assert registry.current(spark, path) == first and registry.load(spark, path).count() == 1
    second = registry.save(registry.upsert(registry.load(spark, path), files(spark, ("z", "c"))), path)
    assert registry.current(spark, path) == second and {r.sha256 for r in registry.load(spark, path).collect()} == {"x", "z"}
    assert (tmp_path / "reg" / first).exists() and len([p for p in (tmp_path / "reg").iterdir() if p.name.startswith("v-")]) == 4
    third = registry.save(registry.load(spark, path), path)
    fourth = registry.save(registry.load(spark, path), path)
    named = sorted(p.name for p in (tmp_path / "reg").iterdir() if p.name.startswith("CURRENT-"))
    assert len(named) == 2 and not (tmp_path / "reg" / first).exists() and (tmp_path / "reg" / third).exists() and registry.current(spark, path) == fourth
    number = int(named[-1].removeprefix("CURRENT-"))
    with pytest.raises(OSError, match="another writer"):
        registry._point(spark, path, fourth, number)


def size_of(folder):
    return sum(p.stat().st_size for p in folder.rglob("*.parquet"))


def test_a_commit_writes_in_proportion_to_its_change(spark, tmp_path):
    path = str(tmp_path / "reg")
    many = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("sha256"), F.concat(F.lit("n"), F.col("id")).alias("name"), F.col("id").cast("int").alias("path"))
    registry.save(registry.upsert(registry.empty(spark), many), path)
    known = many.first().sha256
    change = lambda *rows: registry.update(spark, path, lambda state: registry.upserted(state, files(spark, *rows)))
    number = change(("new", "A"), (known, "again"))
    [delta] = [p for p in (tmp_path / "reg").iterdir() if p.name.startswith("d-")]
    [base] = [p for p in (tmp_path / "reg").iterdir() if p.name.startswith("v-")]
    assert size_of(delta) < size_of(base) / 20 and spark.read.parquet(str(delta)).count() == 2
    assert change(("new", "A"), (known, "again")) == number and len(list((tmp_path / "reg").glob("d-*"))) == 1  # nothing changes: nothing is written
    change(("new", "B"))
    got = {r.sha256: (r.original_name, r.duplicates) for r in registry.load(spark, path).filter(F.col("sha256").isin("new", known)).collect()}
    assert got["new"] == ("A", ["B"]) and got[known][1] == ["again"] and registry.load(spark, path).count() == 20001
    registry.compact(spark, path)
    assert registry.load(spark, path).count() == 20001 and len(registry._state(spark, path)[1]) == 1


def test_deltas_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "MOST_DELTAS", 3)
    path = str(tmp_path / "reg")
    for i in range(8):
        registry.update(spark, path, lambda state, i=i: registry.upserted(state, files(spark, (f"s{i % 5}", f"n{i}"))))
        assert len(registry._state(spark, path)[1]) <= 4
    assert {r.sha256: r.duplicates for r in registry.load(spark, path).collect()} == {"s0": ["n5"], "s1": ["n6"], "s2": ["n7"], "s3": [], "s4": []}
    assert len([p for p in (tmp_path / "reg").iterdir() if p.name.startswith("CURRENT-")]) <= 2


def test_two_writers_at_once_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "reg")

    def write(who):
        for i in range(4):
            registry.update(spark, path, lambda state: registry.upserted(state, files(spark, (f"{who}{i}", "n"), ("shared", f"{who}{i}"))))

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, "abc"))
    got = {r.sha256: r for r in registry.load(spark, path).collect()}
    assert set(got) == {"shared", *(f"{w}{i}" for w in "abc" for i in range(4))}
    assert {got["shared"].original_name, *got["shared"].duplicates} == {f"{w}{i}" for w in "abc" for i in range(4)}


def test_a_pointer_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "reg")
    registry.save(registry.upsert(registry.empty(spark), files(spark, ("x", "a"))), path)
    with pytest.raises(FileExistsError):
        registry._point(spark, path, "v-other", 1)
    assert registry.load(spark, path).count() == 1 and not [p for p in (tmp_path / "reg").iterdir() if p.name.startswith("_")]


def test_work_list_and_filters(spark):
    rows = [("1", "b.pdf", "done"), ("2", "A.pdf", None), ("3", "c.PDF", "error"), ("4", None, None)]
    df = spark.createDataFrame([(s, n, (st,)) for s, n, st in rows], "sha256 string, original_name string, translation_docx struct<status: string>")
    pending = registry.is_pending(F.col("translation_docx.status"))
    assert [r.sha256 for r in registry.work_list(df, pending).collect()] == ["4", "2", "3"]
    assert registry.work_list(df, pending, 0).count() == 0 and registry.work_list(df, registry.is_pending(F.lit("done"), True)).count() == 4
    assert registry.without_errors(df).count() == 3 and registry.with_sha_prefix(df, "3").count() == 1
    assert [r[0] for r in df.select(registry.needs_ocr(F.lit(199)), ).limit(1).collect()] == [True]
    listing = spark.createDataFrame([("b.pdf",)], "path string")
    assert registry.existing(df, listing, "original_name").count() == 1 and registry.existing(df, listing, "original_name", "left_anti").count() == 3


def test_config(tmp_path):
    (tmp_path / "c.toml").write_text('[translation]\nretries = 7\nother = 1\n[step1]\nocr_language = "deu"\n[mine]\nx = 1\n[drive]\nfolder_url = "https://h/f/ABC/?usp=x"\n')
    c = config.load(str(tmp_path / "c.toml"), str(tmp_path))
    assert (c.retries, c.ocr_min_chars, c.folder_id, c.raw["mine"]["x"]) == (7, 200, "ABC", 1)
    assert c.ocr_languages() == ["deu", "heb", "eng+heb"] and c.source_dir == str(tmp_path / "to_translate")
    assert json.loads(c.dump())["settings"]["translation"]["chunk_char_limit"] == 4500
    assert config.load(None).engine == "google"
