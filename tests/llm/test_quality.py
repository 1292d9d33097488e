import zlib

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from docflow.llm import quality
from docflow.llm.common import stored, utf8
from docflow.llm.quality import isotonic, kept, scores, statistics

GOOD, BAD = "The quiet river ran past the old mill, and nobody spoke. {}", "BUY!! $$$ NOW!! %%% {} ### $$$ !!"


def tables(spark, n=240):
    docs = [(i, (GOOD if i % 3 else BAD).format(" ".join(f"w{i * k % 17}" for k in range(i % 40))), "extra") for i in range(n)]
    docs += [(n, "", "x"), (n + 1, None, "x"), (None, "text", "x"), (1, "a" * 300_000, "x"), (n + 2, "$$$ " * 50, "x")]
    labels = [(i, int(i % 3 > 0)) for i in range(n)] + [(5, None), (None, 1), (7, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_rows_are_told_apart(spark):
    docs, labels = tables(spark)
    got = [r for r in scores(docs, labels).collect()]
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    out = [(r.score, r.doc_id % 3 > 0) for r in got if r.held_out and r.doc_id < 240 and r.doc_id != 1]
    assert len(out) > 30 and np.mean([(s >= 0.7) == y for s, y in out]) > 0.95
    names = {r.doc_id for r in kept(docs, labels).collect()}
    assert kept(docs, labels).columns == docs.columns and 242 not in names and 4 in names


def test_without_labels_or_rows(spark):
    docs, labels = tables(spark, 30)
    assert {r.score for r in scores(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in scores(docs, labels.filter("quality = 1")).collect()} == {1.0}
    assert scores(docs.limit(0), labels).count() == 0


def test_statistics_do_not_depend_on_blocks():
    texts = ["", "one Line\nTWO!! lines\n", "é ñ " * 100, "x", "a b c d e a b c d e", "  \n\n"]
    whole = statistics(*utf8(pa.array(texts)))
    assert np.allclose(whole, np.vstack([statistics(*utf8(pa.array([t]))) for t in texts])) and np.isfinite(whole).all()


def nearest(x, y):
    """The isotonic fit at each distinct x by the min-max formula: the largest over starts of the least mean over ends."""
    at = np.unique(x)
    mean = lambda a, b: y[(x >= at[a]) & (x <= at[b])].mean()
    return at, np.array([max(min(mean(a, b) for b in range(i, len(at))) for a in range(i + 1)) for i in range(len(at))])


def test_isotonic_is_the_nearest_monotone_fit():
    rng = np.random.default_rng(2)
    for n, top in ((200, 20), (60, 60), (30, 4), (1, 1), (5, 1)):
        x, y = rng.integers(0, top, n).astype(float), (rng.random(n) < 0.5).astype(float)
        at, value = isotonic(x, y)
        assert (np.diff(at) > 0).all() and (np.diff(value) > 0).all()
        places, want = nearest(x, y)
        blocks = [places[want == v] for v in np.unique(want)]
        assert np.allclose(value, np.unique(want))
        for own, middle in zip(blocks, at):  # a block's place is the mean x of its rows
            assert np.isclose(middle, x[(x >= own.min()) & (x <= own.max())].mean())


def test_query_against_a_plain_model(spark, tmp_path):
    """Scores of the query equal those of the same method written plainly, with one matrix of all rows in place of summed parts."""
    docs, labels = tables(spark)
    docs.filter("doc_id is not null").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    model = quality.fit(stored(quality.vectors(docs.filter("doc_id is not null")), "v"), labels)
    rows = sorted(((r.doc_id, r.text) for r in docs.filter("doc_id is not null").collect()), key=str)
    stats = statistics(*utf8(pa.array([t or "" for _, t in rows]))).astype(float)
    y = {}
    for r in labels.collect():
        if r.doc_id is not None and r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            y.setdefault(r.doc_id, []).append(r.quality)
    own = np.array([d in y for d, _ in rows])
    target = np.array([np.mean(y[d]) for d, _ in rows if d in y])
    x = stats[own]
    assert np.allclose(model.center, x.mean(0), rtol=1e-6) and np.allclose(model.scale[x.std(0) > 1e-5], x.std(0)[x.std(0) > 1e-5], rtol=1e-3)
    z = model.lift(x)
    penalty = np.diag(np.append(np.full(z.shape[1] - 1, quality.RIDGE * len(z)), 1e-9))
    assert np.allclose(model.weights[:, 0], np.linalg.solve(z.T @ z + penalty, z.T @ target), atol=1e-6)
    want = np.clip(np.interp(model.lift(stats) @ model.weights[:, 0], model.at, model.value), 0, 1)
    got = sorted(((r.doc_id, r.score, r.held_out, r.predicted) for r in quality.op9_quality_classifier(spark, str(tmp_path)).collect()), key=str)
    assert sorted(((d, round(s, 6)) for (d, _), s in zip(rows, want)), key=str) == sorted(((d, round(s, 6)) for d, s, _, _ in got), key=str)
    assert all(p == (s >= 0.7) and h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, s, h, p in got)


def test_repeated_rows_count_once(spark):
    docs, labels = tables(spark, 120)
    many = docs.unionByName(docs.filter("doc_id = 3").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n"))
    a = {r.doc_id: r.score for r in scores(docs.filter("doc_id < 120"), labels).collect() if r.doc_id != 1}
    b = {r.doc_id: r.score for r in scores(many.filter("doc_id < 120"), labels).collect() if r.doc_id != 1}
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_rows_without_an_id_are_judged_by_their_own_text(spark):
    docs, labels = tables(spark, 300)
    names = {r.doc_id for r in kept(docs, labels).collect()}
    none = docs.select(*(F.lit(None).cast("long").alias(c) if c == "doc_id" else c for c in docs.columns))
    both = docs.unionByName(none)
    good = sorted(r.text or "" for r in docs.collect() if r.doc_id in names)
    assert sorted(r.text or "" for r in kept(both, labels).collect() if r.doc_id is None) == good and 0 < len(good) < docs.count()
