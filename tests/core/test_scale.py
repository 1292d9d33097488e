import time
import uuid

import pytest
from pyspark.sql import functions as F

from docflow import config, engines
from docflow.engines import Paced
from docflow.functions import fixed
from docflow.operators import report, translate
from docflow.plans import jobs
from docflow.sources import files


@pytest.fixture
def store(spark, tmp_path):
    def run(df):
        path = f"{tmp_path}/steps/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return run


def test_a_long_file_is_spread_over_tasks(spark, tmp_path, store):
    (tmp_path / "long.pdf").write_text("\f".join(f"page {i}" for i in range(1, 10001)))
    (tmp_path / "short.pdf").write_text("one\ftwo")
    listed = files.listed(spark, str(tmp_path))
    read = store(files.read_files(listed, "text", store=store).withColumn("task", F.spark_partition_id()))
    long = read.filter(F.col("path").endswith("long.pdf"))
    assert long.count() == 10000 and long.filter("text <> concat('page ', page_no)").isEmpty() and long.select("page_no").distinct().count() == 10000
    per_task = [r["count"] for r in long.groupBy("task").count().collect()]
    assert len(per_task) > 10 and max(per_task) <= 10 * files.PART_PAGES
    assert [r.text for r in read.filter(F.col("path").endswith("short.pdf")).orderBy("page_no").collect()] == ["one", "two"]
    assert read.select("path", "sha256").distinct().count() == 2


def test_a_range_that_fails_is_the_file_s_error(spark, tmp_path, store):
    def pages(content):
        for i in range(30):
            if i == 25:
                raise ValueError("page 26 is broken")
            yield f"{i} " * 100, 0

    (tmp_path / "to_translate").mkdir()
    (tmp_path / "to_translate/a.pdf").write_text("x")
    engines.EXTRACTORS["broken"] = engines._ranged(pages, lambda content: 30)
    read = files.read_files(files.listed(spark, f"{tmp_path}/to_translate"), "broken", part_pages=10, store=store).collect()
    assert sum(r.error is None for r in read) == 20 and [r.error for r in read if r.error] == ["pages from 21: page 26 is broken"]
    one = jobs.extract(spark, config.load(None, str(tmp_path)), f"{tmp_path}/r", store, engine="broken").first().step1
    assert one.status == "error" and "page 26" in one.error and not (tmp_path / "step1_md/a/a.md").exists()


class Clock:
    def __init__(self):
        self.now = 1000.0

    def sleep(self, s):
        self.now += s


def test_slots_share_a_rate_and_a_pause(tmp_path):
    clock, calls, failing = Clock(), [], {"x"}

    def engine(slot):
        def run(text):
            calls.append((slot, clock.now))
            if text in failing:
                failing.discard(text)
                raise RuntimeError(f"{fixed.RATE_LIMIT[0]} now")
            return text

        return run

    make = lambda slot: Paced(engine(slot), rate=2.0, slots=2, slot=slot, pause=f"{tmp_path}/pause", sleep=clock.sleep, clock=lambda: clock.now)
    a, b = make(0), make(1)
    for _ in range(4):
        a("a"), b("b")
    times = [t for _, t in calls]
    assert all(sum(s <= t < s + 1 for t in times) <= 3 for s in times) and times[-1] - times[0] >= 3
    with pytest.raises(RuntimeError):
        a("x")
    noted = clock.now
    b("b")
    assert calls[-1][1] >= noted + fixed.RATE_LIMIT_WAITS[0] - 0.01  # b was told by a


def test_a_rate_holds_over_all_tasks(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def make():
        def run(text):
            (log / uuid.uuid4().hex).write_text(str(time.time()))
            return text.upper()

        return run

    texts = spark.range(40).select(F.col("id").cast("string").alias("src_sha"), F.concat(F.lit("t"), F.col("id")).alias("source"))
    got = translate.run_engine(texts, make, slots=8, rate=20.0, pause=f"{tmp_path}/pause").collect()
    assert len(got) == 40 and all(r.text and r.error is None for r in got)
    times = sorted(float(p.read_text()) for p in log.iterdir())
    assert len(times) == 40 and max(sum(s <= t < s + 1 for t in times) for s in times) <= 20 + 8


def test_index_in_pages(spark, tmp_path, store):
    rows = spark.range(2503).select(F.concat(F.lit("N"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("original_name"), F.sha2(F.col("id").cast("string"), 256).alias("sha256"))
    rows = rows.withColumn("row", F.concat(F.lit("<tr>"), "original_name", F.lit("</tr>"))).repartition(7)
    made = {r.path: r.content for r in report.pages(rows, None, "now", store, per_page=1000).collect()}
    assert set(made) == {"index.html", "index-2.html", "index-3.html"}
    assert [made[n].count("<tr>") for n in ("index.html", "index-2.html", "index-3.html")] == [1000, 1000, 503]
    assert made["index-2.html"].index("N01000") < made["index-2.html"].index("N01999") and "N01000" not in made["index.html"]
    assert 'href="index.html"' in made["index-2.html"] and 'href="index-3.html"' in made["index-2.html"] and 'href="index-2.html"' in made["index.html"] and "1 / 3" in made["index.html"]
    [empty] = report.pages(rows.limit(0), None, "now", store).collect()
    assert empty.path == "index.html" and "<tr>" not in empty.content
    numbers = [r.number for r in report.numbered(rows, store).orderBy("original_name").collect()]
    assert numbers == list(range(2503))


def test_index_files_and_cli(spark, tmp_path, store, monkeypatch, capsys):
    from docflow import cli

    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    (tmp_path / "to_translate").mkdir()
    for i in range(5):
        (tmp_path / f"to_translate/f{i}.pdf").write_text(f"scan {i}")
    assert cli.main(["extract", "--root", str(tmp_path), "--engine", "text", "--ocr", "text"]) == 0
    assert (tmp_path / "step1_md/f0/f0.md").read_text() == "<!-- page 1 (lang=eng) -->\n\nscan 0"
    assert cli.main(["index", "--root", str(tmp_path), "--per-page", "2"]) == 0
    made = sorted(p.name for p in tmp_path.glob("index*.html"))
    assert made == ["index-2.html", "index-3.html", "index.html"] and (tmp_path / "index.html").read_text("utf-8").count("<tr>") == 2
    assert cli.main(["summarize", "--root", str(tmp_path), "--sha", "zz"]) == 1 and "zz" in capsys.readouterr().out
