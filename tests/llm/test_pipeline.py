import corpus_pipeline
from docflow.llm.common import stored, table


def test_stages_take_effect_and_keep_columns(spark):
    d = "/root/testdata/sf0.001"
    docs = table(spark, d, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, d), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and 0 < out.count() <= before
            assert out.filter("n_chars <> length(text)").count() == 0
            before = out.count()
            docs = out
    lengths = {r.sequence_id: r.n for r in out.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert max(lengths.values()) <= 2048 and out.select("doc_id").distinct().count() == docs.count()


def test_stages_against_brute_force(spark, tmp_path):
    import test_decontaminate
    import test_jaccard
    import test_linededup

    docs, bench = test_decontaminate.cases()
    rows = [(i, t) for i, (_, t) in enumerate(docs)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(test_linededup.corpus(3))]
    rows += [(300 + i, t) for i, (_, t) in enumerate(test_jaccard.corpus(5, 6, 6))]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    cut = {d: set(gone) for d, _, gone in test_linededup.brute(rows)}
    want = []
    for i, t in rows:
        left = t if t is None or not cut[i] else "\n".join(s for k, s in enumerate(t.split("\n")) if k not in cut[i])
        if t is None or not cut[i] or left.strip():
            want.append((i, left))
    out = stored(corpus_pipeline.line_dedup(spark, df, str(tmp_path)), "t2")
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted(want)

    parts = {d: c for d, _, c in test_jaccard.brute(want, 5, 80)}
    want = [(i, t) for i, t in want if parts[i] == i]
    out = stored(corpus_pipeline.near_duplicates(spark, out, str(tmp_path)), "t3")
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted(want)

    hit = {r[0] for r in test_decontaminate.brute(want, bench) if r[-1]}
    want = [(i, t) for i, t in want if i not in hit]
    out = stored(corpus_pipeline.benchmark_decontamination(spark, out, str(tmp_path)), "t4")
    assert hit and sorted((r.doc_id, r.text) for r in out.collect()) == sorted(want)


def test_small_steps_have_garbage_collected(spark, monkeypatch):
    """A step that is over at once adds to the driver's garbage too; once the heap has grown, such a step has it collected."""
    from docflow.llm import common

    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    monkeypatch.setattr(common, "LARGE_STEP", 10**6)
    monkeypatch.setattr(common, "HEAP_SHARE", 0)
    before = full()
    stored(spark.range(3).toDF("x"), "small-step")
    assert full() > before


def test_steps_give_back_memory_outside_the_heap(spark, monkeypatch):
    """What the driver's JVM has freed outside its heap goes back after a large step, and after a small one once the heap has grown."""
    from docflow.llm import common

    assert common.trimmed(spark)
    calls, trimmed = [], common.trimmed
    monkeypatch.setattr(common, "trimmed", lambda s: calls.append(trimmed(s)))
    for large, share in ((0, 1), (10**6, 0), (10**6, 1)):
        monkeypatch.setattr(common, "LARGE_STEP", large)
        monkeypatch.setattr(common, "HEAP_SHARE", share)
        stored(spark.range(3).toDF("x"), "trimmed-step")
    assert calls == [True, True]
