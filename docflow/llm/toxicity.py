"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learned from document labels.

A document is a bag of sentences; only documents are labelled. A sentence's log-odds are a bias and the
weights of its words and of the beginnings of its longer words (hashed into 2**BITS buckets); a document is toxic if any sentence is:
P = 1 - prod(1 - p_s). The weights are those that maximise the likelihood of the document labels under this noisy-or, so that
the sentences that explain the label take the blame, and the same scores locate them afterwards. Words are
chosen first by how far their document frequency differs between the classes. A last step calibrates P on
documents that the fit did not see.

Labels are those of the rows that are not held out; the fit takes at most about ``sample_rows`` labelled documents,
chosen by a hash of doc_id, whose ids alone are broadcast (a bounded number). Scoring sees every whole text.

Defined results: a null or empty text has no sentences and the calibrated score of P = 0; without labels, or with
one class, every score is the mean label (0.5 without any); several labels of a doc_id are averaged and count as 1
from 0.5; a null doc_id is never labelled and not held out; repeated rows give a row each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, LOWER, U64, blocks, held_out, mix, stored, table, word_hashes, words

SAMPLE_ROWS = 24_000
BITS = 20
PREFIXES = (4, 5, 6, 7, 8)
VOCABULARY = 4096
EPOCHS = 250
THRESHOLD = 0.3
_STOPS = np.array([b in b".!?\n" for b in range(256)])


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of words, buckets): whole words first, then the beginnings of longer words."""
    yield np.arange(len(starts)), (word_hashes(data, starts, ends) >> U64(64 - BITS)).astype(np.int64)
    padded = np.append(data, np.zeros(max(PREFIXES), np.uint8))
    packed = np.zeros(len(starts), U64)
    for i in range(max(PREFIXES)):
        packed |= padded[starts + i].astype(U64) << U64(8 * i)
        if i + 1 in PREFIXES:
            longer = np.flatnonzero(ends - starts > i + 1)
            yield longer, (mix(packed[longer] + U64(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> U64(64 - BITS)).astype(np.int64)


def sentences(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a block: bucket and sentence of every feature of every word; document, first byte and end of every
    sentence. A sentence ends after . ! ? or a line break; one without words isn't counted."""
    low = LOWER[data]
    starts, ends, doc = words(low, offs, ALNUM_WORDS)
    if not len(starts):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty
    stops = np.append(0, np.cumsum(_STOPS[data]))[starts]
    new = np.append(True, (stops[1:] != stops[:-1]) | (doc[1:] != doc[:-1]))
    sentence = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    places, buckets = zip(*_features(low, starts, ends))
    return np.concatenate(buckets), sentence[np.concatenate(places)], doc[first], starts[first], ends[last]


@dataclass
class Model:
    weights: np.ndarray  # by bucket
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def doubt(self, bucket: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        """-log(1 - p) of every sentence."""
        z = np.bincount(sentence, self.weights[bucket], n) + self.bias
        return np.logaddexp(0, z)

    def calibrated(self, total: np.ndarray) -> np.ndarray:
        """Scores of documents from the sums of their sentences' doubts."""
        if self.constant is not None:
            return np.full(len(total), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * _logit(total) + self.shift, -50, 50)))


def _logit(total: np.ndarray) -> np.ndarray:
    """log(P / (1 - P)) for P = 1 - exp(-total)."""
    total = np.clip(total, 1e-6, 50)
    return np.where(total > 30, total, np.log(np.expm1(np.minimum(total, 30))))


def train_noisy_or(bucket: np.ndarray, sentence: np.ndarray, doc: np.ndarray, y: np.ndarray, size: int, epochs: int = EPOCHS, l2: float = 2e-5) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of y; doc is the document of each sentence. Adam on all rows."""
    n = len(y)
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[-1] = -5.0
    for t in range(1, epochs + 1):
        z = np.bincount(sentence, w[bucket], len(doc)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        total = np.bincount(doc, np.logaddexp(0, z), n)
        pull = np.where(y > 0, -1 / np.expm1(np.clip(total, 1e-4, 50)), 1.0)
        g = p * pull[doc] / n
        grad = np.append(np.bincount(bucket, g[sentence], size), g.sum()) + l2 * w
        grad[-1] -= l2 * w[-1]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w[:-1], float(w[-1])


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        g = np.array([((p - y) * x).sum() + 1e-2 * (a - 1), (p - y).sum()])
        q = p * (1 - p)
        h = np.array([[(q * x * x).sum() + 1e-2, (q * x).sum()], [(q * x).sum(), q.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (a, b) if a > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).filter("doc_id is not null and y is not null")
    y = y.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("y").alias("y"))
    n = y.count()
    if n > sample_rows:  # a bounded number of ids, so they may be broadcast
        y = y.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * sample_rows / n))

    # Rows that are the same count once, and texts of one id are few, or fewer are taken, by their hash.
    sample = stored(docs.join(F.broadcast(y), "doc_id").select("doc_id", "text", "y").dropDuplicates(["doc_id", "text"]), "toxicity-sample")
    rows = sample.count()
    if rows > 2 * sample_rows:
        sample = sample.filter(F.pmod(F.xxhash64("doc_id", "text", F.lit("row")), F.lit(1 << 30)) < int((1 << 30) * 2 * sample_rows / rows))

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, 1 << BITS), np.int64)
        for batch, data, offs in blocks(batches):
            bucket, sentence, doc, _, _ = sentences(data, offs)
            pairs = np.unique(doc[sentence] << BITS | bucket) if len(doc) else bucket
            y = batch.column("y").to_numpy() >= 0.5
            for one in (0, 1):
                count[one] += np.bincount(pairs[y[pairs >> BITS] == one] & ((1 << BITS) - 1), minlength=1 << BITS)
        some = np.flatnonzero(count.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[0, some], pa.int64()), pa.array(count[1, some], pa.int64())], ["bucket", "negative", "positive"])

    size = sample.agg(F.count(F.lit(1)), F.count_if(F.col("y") >= 0.5)).first()
    if not size[1] or size[0] == size[1]:
        return Model(np.zeros(1 << BITS), -20.0, constant=float(size[1] / size[0]) if size[0] else 0.5)
    df = sample.mapInArrow(frequency, "bucket int, negative long, positive long").groupBy("bucket").agg(F.sum("negative").alias("n"), F.sum("positive").alias("p"))
    rate_n, rate_p, both = F.col("n") / (size[0] - size[1]), F.col("p") / size[1], (F.col("n") + F.col("p")) / size[0]
    contrast = F.abs(rate_p - rate_n) / F.sqrt(both * (1 - both) * (1 / size[1] + 1 / (size[0] - size[1])) + 1e-9)
    chosen = df.filter("n + p >= 5").orderBy(contrast.desc(), "bucket").limit(VOCABULARY).toPandas()["bucket"].to_numpy()
    place = np.full(1 << BITS, -1, np.int64)
    place[np.sort(chosen)] = np.arange(len(chosen))
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in blocks(batches):
            bucket, sentence, doc, _, _ = sentences(data, offs)
            at = shared.value[bucket]
            own = np.flatnonzero(at >= 0)
            own = own[np.argsort(sentence[own], kind="stable")]
            at, sentence = at[own], sentence[own]
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            word = np.searchsorted(sentence, cut)
            rows = [(at[a:b].astype("<i4").tobytes(), (sentence[a:b] - s).astype("<i4").tobytes(), int(e - s)) for a, b, s, e in zip(word, word[1:], cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int32())], ["doc_id", "y", "bucket", "sentence", "n"])

    rows = sample.mapInArrow(bags, "doc_id long, y double, bucket binary, sentence binary, n int").toPandas().sort_values(["doc_id", "bucket"], kind="stable", ignore_index=True)
    later = mix(rows["doc_id"].to_numpy().astype(np.int64).view(U64)) % U64(4) == 1  # a quarter of the sample calibrates the rest
    if not 0 < (rows["y"][~later] >= 0.5).sum() < (~later).sum():
        later[:] = False
    part = rows[~later]
    w, bias = train_noisy_or(*_arrays(part), (part["y"].to_numpy() >= 0.5).astype(float), len(chosen))
    model = Model(np.zeros(1 << BITS), bias)
    model.weights[np.sort(chosen)] = w
    part = rows[later]
    if 0 < (part["y"] >= 0.5).sum() < len(part):
        bucket, sentence, doc = _arrays(part)
        z = np.bincount(sentence, w[bucket], len(doc)) + bias
        model.slope, model.shift = _platt(_logit(np.bincount(doc, np.logaddexp(0, z), len(part))), (part["y"].to_numpy() >= 0.5).astype(float))
    return model


def _arrays(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = rows["n"].to_numpy().astype(np.int64)
    before = np.cumsum(n) - n
    bucket = [np.frombuffer(b, "<i4") for b in rows["bucket"]]
    sentence = [np.frombuffer(s, "<i4") + b for s, b in zip(rows["sentence"], before)]
    return np.concatenate(bucket).astype(np.int64), np.concatenate(sentence).astype(np.int64), np.repeat(np.arange(len(n)), n)


SPANS = "doc_id long, score double, n_sentences int, sentence_starts array<int>, sentence_ends array<int>, sentence_scores array<double>"


def scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, **options) -> DataFrame:
    """(doc_id, held_out, score, n_sentences) of every row, and of documents from threshold up the sentences whose own
    score is that high, or else their highest: starts and ends in code points, end exclusive, and scores."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, data, offs in blocks(batches):
            bucket, sentence, doc, start, end = sentences(data, offs)
            doubt = model.doubt(bucket, sentence, len(doc))
            score = model.calibrated(np.bincount(doc, doubt, batch.num_rows))
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            spans: list[list[list]] = [[], [], []]
            own = model.calibrated(doubt)
            for i in range(batch.num_rows):
                found: list[list] = [[], [], []]
                if score[i] >= threshold and cut[i] < cut[i + 1]:
                    each = own[cut[i] : cut[i + 1]]
                    at = np.flatnonzero(each >= threshold)
                    at = at if len(at) else each.argmax(keepdims=True)
                    points = np.append(0, np.cumsum(data[offs[i] : offs[i + 1]] & 0xC0 != 0x80))
                    found = [points[start[cut[i] + at] - offs[i]].tolist(), points[end[cut[i] + at] - offs[i]].tolist(), each[at].tolist()]
                for column, value in zip(spans, found):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64()), pa.array(np.diff(cut), pa.int32()), *(pa.array(c, pa.list_(k)) for c, k in zip(spans, (pa.int32(), pa.int32(), pa.float64())))],
                ["doc_id", "score", "n_sentences", "sentence_starts", "sentence_ends", "sentence_scores"],
            )

    found = docs.mapInArrow(run, SPANS)
    return found.withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_sentences", "sentence_starts", "sentence_ends", "sentence_scores")
