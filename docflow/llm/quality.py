"""Quality classifier: random Fourier features of document statistics, ridge by summed normal equations, isotonic calibration.

One pass over the texts makes a short vector of statistics for each document (shares of kinds of bytes and of
single marks, word and line lengths, repetition of words, runs and lines). The vectors, not the texts, are stored,
joined with the labels and scored. cos(Wx + b) of ``features`` random directions approximates a Gaussian kernel of
the standardised statistics. Each partition sums its rows' normal equations, one set for each of FOLDS folds; the
sums, of fixed size and number, are added up and solved. A row's out-of-fold score comes from the
equations without its fold; isotonic regression of the labels on these scores calibrates the final model.

Labels are those of the rows that are not held out (crc32 of doc_id as text, mod 4, is not 2). Only the fit is
bounded: it takes at most about ``sample_rows`` labelled rows, chosen by a hash of doc_id.

Defined results: a null or empty text is scored as an empty one; without labels every score is 0.5; with one
class every score is that class; several labels of a doc_id are averaged and null labels are none; a null doc_id is
never labelled and not held out; repeated rows give a row each; an empty table gives no rows; other columns
are ignored by scores() and kept by kept().
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_WORDS, blocks, held_out, run_hashes, stored, table, without, word_hashes, words

SAMPLE_ROWS = 40_000
FEATURES = 256
FOLDS = 5
SUMS = 8
RIDGE = 1e-3
THRESHOLD = 0.7
_MARKS = b"|!%&$*#@<>{}[]()=+-_/\\^~`\"';:?.,"
_NOT_NEWLINE = np.array([b != 10 for b in range(256)])


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes per document."""
    at = np.searchsorted(doc, np.arange(n + 1))
    return np.array([len(np.unique(hashes[a:b])) for a, b in zip(at, at[1:])])


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of statistics for each document of a block."""
    n = len(offs) - 1
    size = np.diff(offs)
    histogram = np.zeros((n, 256))
    for lo in range(0, len(data), 1 << 22):
        part = data[lo : lo + (1 << 22)]
        doc = np.searchsorted(offs, np.arange(lo, lo + len(part)), "right") - 1 if n > 1 else np.zeros(len(part), np.int64)
        histogram += np.bincount(doc * 256 + part, minlength=256 * n).reshape(n, 256)
    share = histogram / np.maximum(size, 1)[:, None]
    starts, ends, doc = words(data, offs, SPACE_WORDS)
    hashes = word_hashes(data, starts, ends)
    lens = (ends - starts).astype(float)
    count = np.bincount(doc, minlength=n)
    per = np.maximum(count, 1)
    mean = np.bincount(doc, lens, n) / per
    deviation = np.sqrt(np.maximum(np.bincount(doc, lens**2, n) / per - mean**2, 0))
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    ups, lows = (np.append(0, np.cumsum(x)) for x in (upper, lower))
    many_up, any_low = ups[ends] - ups[starts] > 1, lows[ends] - lows[starts] > 0
    rate = lambda x: np.bincount(doc, x, n) / per
    first, last = (data[starts], data[ends - 1]) if len(starts) else (data[:0], data[:0])
    letters = (last >= 128) | ((last | 32) >= 97) & ((last | 32) <= 122)
    runs = run_hashes(hashes, 4)
    whole = doc[: len(runs)] == doc[3:] if len(runs) else np.empty(0, bool)
    run_doc = doc[: len(runs)][whole]
    run_count = np.bincount(run_doc, minlength=n)
    a, z, line_doc = words(data, offs, _NOT_NEWLINE)
    lines = np.bincount(line_doc, minlength=n)
    line_lens = (z - a).astype(float)
    line_mean = np.bincount(line_doc, line_lens, n) / np.maximum(lines, 1)
    entropy = -(share * np.log(np.maximum(share, 1e-12))).sum(1)
    columns = [
        np.log1p(size), np.log1p(count), np.log1p(lines), mean, deviation, np.log1p(line_mean),
        share[:, 65:91].sum(1), share[:, 97:123].sum(1), share[:, 48:58].sum(1), share[:, 128:].sum(1), share[:, 32], share[:, 10], share[:, :9].sum(1) + share[:, 14:32].sum(1), entropy,
        rate(many_up & ~any_low), rate((first >= 65) & (first <= 90)), rate(~letters), rate(lens == 1), rate(lens > 20),
        _distinct(hashes, doc, n) / per, _distinct(runs[whole], run_doc, n) / np.maximum(run_count, 1), _distinct(word_hashes(data, a, z), line_doc, n) / np.maximum(lines, 1),
        *(np.sqrt(share[:, m]) for m in _MARKS),
    ]
    return np.column_stack(columns).astype(np.float32)


def vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, key, stats) of every row; key is the text's xxhash64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in blocks(batches):
            rows = statistics(data, offs)
            stats = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), stats], ["doc_id", "key", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("key", F.xxhash64("text")).mapInArrow(run, "doc_id long, key long, stats array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(float) if len(column) else np.empty((0, 0))


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray  # one column for all rows, then one for each fold left out
    at: np.ndarray  # isotonic steps: raw scores and calibrated values
    value: np.ndarray

    def lift(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.center) / self.scale, -6, 6)
        z = np.cos(x @ self.directions + self.shifts) * np.sqrt(2 / len(self.shifts))
        return np.column_stack([z, np.ones(len(z))])

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return np.full(len(stats), self.value[0])
        return np.clip(np.interp(self.lift(stats) @ self.weights[:, 0], self.at, self.value), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function nearest to y, as block means at the blocks' mean x (equal x pooled first)."""
    x, back = np.unique(x, return_inverse=True)
    weight = np.bincount(back).astype(float)
    y = np.bincount(back, y) / weight
    blocks_: list[list[float]] = []
    for a, b, w in zip(x.tolist(), y.tolist(), weight.tolist()):
        blocks_.append([a * w, b * w, w])
        while len(blocks_) > 1 and blocks_[-2][1] * blocks_[-1][2] >= blocks_[-1][1] * blocks_[-2][2]:
            last = blocks_.pop()
            blocks_[-1] = [p + q for p, q in zip(blocks_[-1], last)]
    b = np.array(blocks_)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def labelled(rows: DataFrame, labels: DataFrame, label: str, sample_rows: int) -> DataFrame:
    """rows with y, the mean label of their doc_id: those not held out, at most about sample_rows by a hash of doc_id. Rows of one
    doc_id and text count once; where ids have so many texts that the rows exceed twice sample_rows, some are taken by a hash."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).filter("doc_id is not null and y is not null")
    y = y.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("y").alias("y"))
    n = y.count()
    if n > sample_rows:
        y = y.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * sample_rows / n))
    found = stored(rows.join(y, "doc_id").dropDuplicates(["doc_id", "key"]), "labelled")
    n = found.count()
    return found if n <= 2 * sample_rows else found.filter(F.pmod(F.xxhash64("doc_id", "key", F.lit("row")), F.lit(1 << 30)) < int((1 << 30) * 2 * sample_rows / n))


def fit(vecs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, features: int = FEATURES, seed: int = 1) -> Model:
    train = labelled(vecs, labels, label, sample_rows).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(SUMS)).cast("int")).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    train = stored(train, "quality-train")  # cut off from its inputs: three passes read it

    def moments(rows: pa.Table) -> pa.Table:
        x = _matrix(rows.column("stats").combine_chunks())
        return pa.table({"n": [len(x)], "s": [x.sum(0).tolist()], "q": [(x**2).sum(0).tolist()], "few": [x[np.argsort(rows.column("doc_id").to_numpy())[:64]].ravel().tolist()], "y": [float(sum(rows.column("y").to_pylist()))]})

    found = train.groupBy("part").applyInArrow(moments, "n long, s array<double>, q array<double>, few array<double>, y double").collect()
    found.sort(key=lambda r: (r.n, r.y))
    n, positive = sum(r.n for r in found), sum(r.y for r in found)
    none = np.empty(0)
    if not n or positive in (0, n):
        return Model(none, none, none, none, none, none, np.array([positive / n if n else 0.5]))
    center = sum(np.array(r.s) for r in found) / n
    scale = np.sqrt(np.maximum(sum(np.array(r.q) for r in found) / n - center**2, 0))
    scale[scale < 1e-6] = 1.0
    few = np.clip((np.concatenate([np.array(r.few).reshape(-1, len(center)) for r in found]) - center) / scale, -6, 6)
    square = (few**2).sum(1)
    far = np.sqrt(np.maximum(square[:, None] + square[None] - 2 * few @ few.T, 0))
    width = float(np.median(far[far > 1e-6])) if (far > 1e-6).any() else 1.0
    rng = np.random.default_rng(seed)
    model = Model(center, scale, rng.normal(size=(len(center), features)) / width, rng.uniform(0, 2 * np.pi, features), none, none, none)

    def equations(rows: pa.Table) -> pa.Table:
        z, y, fold = model.lift(_matrix(rows.column("stats").combine_chunks())), rows.column("y").to_numpy(), rows.column("fold").to_numpy()
        return pa.table({"fold": pa.array(range(FOLDS), pa.int32()), "a": pa.array([(z[fold == f].T @ z[fold == f]).tobytes() for f in range(FOLDS)], pa.binary()), "b": pa.array([(z[fold == f].T @ y[fold == f]).tobytes() for f in range(FOLDS)], pa.binary())})

    a, b = np.zeros((FOLDS, features + 1, features + 1)), np.zeros((FOLDS, features + 1))
    for r in sorted(train.groupBy("part").applyInArrow(equations, "fold int, a binary, b binary").collect(), key=lambda r: (r.fold, bytes(r.b))):
        a[r.fold] += np.frombuffer(r.a).reshape(features + 1, -1)
        b[r.fold] += np.frombuffer(r.b)
    penalty = np.diag(np.append(np.full(features, RIDGE * n), 1e-9))
    solve = lambda keep: np.linalg.solve(a[keep].sum(0) + penalty, b[keep].sum(0))
    model.weights = np.column_stack([solve(np.arange(FOLDS) >= 0), *(solve(np.arange(FOLDS) != f) for f in range(FOLDS))])

    def out_of_fold(rows: pa.Table) -> pa.Table:
        z, fold = model.lift(_matrix(rows.column("stats").combine_chunks())), rows.column("fold").to_numpy()
        return pa.table({"raw": (z * model.weights[:, 1 + fold].T).sum(1), "y": rows.column("y")})

    pairs = train.groupBy("part").applyInArrow(out_of_fold, "raw double, y double").toPandas()
    model.at, model.value = isotonic(pairs["raw"].to_numpy(), pairs["y"].to_numpy())
    return model


def _scores(docs: DataFrame, labels: DataFrame, label: str = "quality", **options) -> DataFrame:
    """(doc_id, key, score) of every row of docs."""
    vecs = stored(vectors(docs), "quality-vectors")
    model = docs.sparkSession.sparkContext.broadcast(fit(vecs, labels, label, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(model.value.scores(_matrix(batch.column("stats"))) if batch.num_rows else [], pa.float64())], ["doc_id", "key", "score"])

    return vecs.mapInArrow(run, "doc_id long, key long, score double")


def scores(docs: DataFrame, labels: DataFrame, label: str = "quality", **options) -> DataFrame:
    """(doc_id, held_out, score) of every row of docs."""
    return _scores(docs, labels, label, **options).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score")


def kept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of docs that score threshold or more; every column stays. A row goes if a row of its doc_id is rejected,
    a row without an id if its own text is.
    Without labels to learn from nothing is known against any row, and all stay."""
    if labels.filter(F.col(options.get("label", "quality")).isNotNull() & ~held_out(F.col("doc_id"))).isEmpty():
        return docs
    return without(docs, _scores(docs, labels, **options).filter(F.col("score") < threshold), "rejected")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
