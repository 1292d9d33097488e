"""Benchmark decontamination by a prefix-filtered set join of word shingles.

A benchmark window (``window`` consecutive words of an item, or the whole of a shorter item) occurs in a
document only if all its shingles do. So of its shingles, ordered by rarity over all documents, the necessary
prefix is the rarest one alone: only that one is joined with the documents' shingles. A hit fixes the place of the
window in the document; the length and positional bounds drop places that cross the document's ends, and
the rest is verified word by word over the window.

Items are taken in blocks of at most ``block_bytes`` of text, so what is sent to the executors is bounded however
large the benchmark is; each block is held against all rows of the documents. Rarity is counted over all
documents. Only hits are shuffled, and only where there is more than one block.

Words are compared by 64-bit hashes, and a window by those of all its words.

Defined results: a null or empty text has no words and no hits; an item without words has no windows; a null
item_id counts as the id ""; rows of one item_id are one item; repeated documents give a row each; an empty
benchmark hits nothing; other columns are ignored by hits() and kept by decontaminated().
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, LOWER, U64, blocks, run_hashes, stored, table, without, word_hashes, words

WINDOW = 10
SHINGLE = 5
BLOCK_BYTES = 8 << 20
_BITS = 20
HITS = "doc_id long, key long, n_words long, starts array<int>, ends array<int>, items array<string>"


@dataclass
class Windows:
    """The windows of a block of items: words of all items in a row, and per window its first word, length and item."""

    ids: list[str]
    hashes: np.ndarray
    first: np.ndarray
    length: np.ndarray
    item: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[str, str]], window: int) -> "Windows":
        ids = sorted({i for i, _ in rows})
        text = [t.encode() for _, t in rows]
        offs = np.cumsum([0, *map(len, text)])
        data = LOWER[np.frombuffer(b"".join(text), np.uint8)]
        starts, ends, row = words(data, offs, ALNUM_WORDS)
        hashes = word_hashes(data, starts, ends)
        at = np.searchsorted(row, np.arange(len(rows) + 1))
        place = {i: k for k, i in enumerate(ids)}
        first, length, item = [], [], []
        for r, (i, _) in enumerate(rows):
            n = int(at[r + 1] - at[r])
            for k in range(max(1, n - window + 1) if n else 0):
                first.append(at[r] + k)
                length.append(min(n, window))
                item.append(place[i])
        return cls(ids, hashes, np.array(first, np.int64), np.array(length, np.int64), np.array(item, np.int64))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, words, window, offset) of every shingle of every window; a window shorter than size is one shingle."""
        parts = []
        for n in np.unique(self.length):
            own, k = np.flatnonzero(self.length == n), int(min(n, size))
            runs = run_hashes(self.hashes, k)
            for offset in range(int(n) - k + 1):
                parts.append((runs[self.first[own] + offset], np.full(len(own), k), own, np.full(len(own), offset)))
        if not parts:
            return np.empty(0, U64), *(np.empty(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(x) for x in zip(*parts))


class Lookup:
    """Places of known hashes among many: a bit table first, then binary search."""

    def __init__(self, known: np.ndarray):
        self.known = known  # sorted, distinct
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[(known & U64((1 << _BITS) - 1)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of hashes that are known, their numbers)."""
        at = np.flatnonzero(self.bits[(hashes & U64((1 << _BITS) - 1)).astype(np.int64)])
        if not len(at) or not len(self.known):
            return at[:0], at[:0]
        number = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
        ok = self.known[number] == hashes[at]
        return at[ok], number[ok]


def _runs(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, and whether each lies in one document."""
    runs = run_hashes(hashes, k)
    return runs, doc[: len(runs)] == doc[k - 1 :] if len(runs) else np.empty(0, bool)


def _doc_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    starts, ends, doc = words(data, offs, ALNUM_WORDS)
    return word_hashes(data, starts, ends), doc


def rarity(docs: DataFrame, lookups: dict[int, Lookup]) -> dict[tuple[int, int], int]:
    """The number of documents that hold each known shingle, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(lookups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = {k: np.zeros(len(x.known), np.int64) for k, x in shared.value.items()}
        for batch, data, offs in blocks(batches):
            hashes, doc = _doc_words(data, offs)
            for k, lookup in shared.value.items():
                runs, whole = _runs(hashes, doc, k)
                at, number = lookup.find(runs)
                keep = whole[at]
                pairs = np.unique(doc[at[keep]] * len(lookup.known) + number[keep])
                count[k] += np.bincount(pairs % max(1, len(lookup.known)), minlength=len(lookup.known))
        for k, c in count.items():
            some = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k), pa.int32()), pa.array(some, pa.int64()), pa.array(c[some], pa.int64())], ["k", "number", "n"])

    counted = docs.select("text").mapInArrow(run, "k int, number long, n long").groupBy("k", "number").agg(F.sum("n").alias("n"))
    return {(r.k, r.number): r.n for r in counted.collect()}


def _hits_of_block(docs: DataFrame, rows: list[tuple[str, str]], window: int, size: int) -> DataFrame:
    found = Windows.of(rows, window)
    hashes, k, win, offset = found.shingles(size)
    lookups = {int(n): Lookup(np.unique(hashes[k == n])) for n in np.unique(k)}
    df = rarity(docs, lookups) if lookups else {}
    prefix: dict[int, tuple] = {}
    number = np.zeros(len(hashes), np.int64)
    for n, lookup in lookups.items():
        number[k == n] = np.searchsorted(lookup.known, hashes[k == n])
    order = np.array([df.get((int(a), int(b)), 0) for a, b in zip(k, number)], np.int64)
    ranked = np.lexsort((offset, hashes, order, win))
    rarest = ranked[np.unique(win[ranked], return_index=True)[1]] if len(ranked) else ranked
    rarest = rarest[order[rarest] > 0]  # a shingle that no document holds ends its window
    for n in np.unique(k[rarest]):
        own = rarest[k[rarest] == n]
        own = own[np.argsort(hashes[own], kind="stable")]
        known, begin = np.unique(hashes[own], return_index=True)
        prefix[int(n)] = (Lookup(known), np.append(begin, len(own)), win[own], offset[own])
    shared = docs.sparkSession.sparkContext.broadcast((found, prefix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench, index = shared.value
        for batch, data, offs in blocks(batches):
            hashes, doc = _doc_words(data, offs)
            at = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            where, which = [], []
            for n, (lookup, begin, wins, offsets) in index.items():
                runs, whole = _runs(hashes, doc, n)
                place, number = lookup.find(runs)
                place, number = place[whole[place]], number[whole[place]]
                times = begin[number + 1] - begin[number]
                place = np.repeat(place, times)
                entry = np.repeat(begin[number], times) + np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
                w = wins[entry]
                begins = place - offsets[entry]
                d = doc[place]
                fits = (begins >= at[d]) & (begins + bench.length[w] <= at[d + 1])
                begins, w = begins[fits], w[fits]
                for j in range(int(bench.length.max())):
                    far = bench.length[w] > j
                    ok = np.ones(len(w), bool)
                    ok[far] = hashes[begins[far] + j] == bench.hashes[bench.first[w[far]] + j]
                    begins, w = begins[ok], w[ok]
                where.append(begins)
                which.append(w)
            where = np.concatenate(where) if where else np.empty(0, np.int64)
            which = np.concatenate(which) if which else np.empty(0, np.int64)
            d = doc[where] if len(where) else where
            ranked = np.lexsort((where, d))
            where, which, d = where[ranked], which[ranked], d[ranked]
            cut = np.searchsorted(d, np.arange(batch.num_rows + 1))
            starts, ends, items = [], [], []
            for i in range(batch.num_rows):
                own = slice(cut[i], cut[i + 1])
                if cut[i] == cut[i + 1]:
                    starts.append([])
                    ends.append([])
                    items.append([])
                    continue
                s, e = _merged(where[own] - at[i], where[own] - at[i] + bench.length[which[own]])
                starts.append(s)
                ends.append(e)
                items.append([bench.ids[x] for x in np.unique(bench.item[which[own]])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(np.diff(at), pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "key", "n_words", "starts", "ends", "items"],
            )

    return docs.mapInArrow(run, HITS)


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Spans in order of their starts, with those that touch joined."""
    reach = np.maximum.accumulate(ends)
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new].tolist(), reach[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)].tolist()


def hits(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per row of docs: doc_id, n_words, starts and ends of hit spans of words, and the items that occur."""
    return _hits(docs, benchmark, **options).drop("key")


def _hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, size: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """hits() with key, the text's xxhash64."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("key", F.xxhash64("text"))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n_blocks = max(1, math.ceil((items.agg(F.sum(F.octet_length("text") + F.length("item_id") + 16)).first()[0] or 0) / block_bytes))
    if n_blocks == 1:
        return _hits_of_block(docs, [tuple(r) for r in items.collect()], window, size)
    items = stored(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))), "benchmark")
    parts = None
    for b in range(n_blocks):
        part = stored(_hits_of_block(docs, [(r.item_id, r.text) for r in items.filter(F.col("block") == b).collect()], window, size).filter(F.size("items") > 0), "hits")
        parts = part if parts is None else parts.unionByName(part)
    span = F.arrays_zip("starts", "ends")
    parts = parts.groupBy("doc_id", "key").agg(F.array_sort(F.flatten(F.collect_list(span))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends = [], []
            for spans in batch.column("spans").to_pylist():
                s, e = _merged(np.array([x["starts"] for x in spans]), np.array([x["ends"] for x in spans]))
                starts.append(s)
                ends.append(e)
            yield pa.RecordBatch.from_arrays([batch.column("hit_id"), batch.column("hit_key"), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), batch.column("items")], ["hit_id", "hit_key", "starts", "ends", "items"])

    merged = parts.withColumnsRenamed({"doc_id": "hit_id", "key": "hit_key"}).mapInArrow(join, "hit_id long, hit_key long, starts array<int>, ends array<int>, items array<string>")
    count = _hits_of_block(docs, [], window, size).select("doc_id", "key", "n_words")
    empty = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    both = count.join(merged, count["doc_id"].eqNullSafe(merged["hit_id"]) & count["key"].eqNullSafe(merged["hit_key"]), "left")
    return both.select("doc_id", "key", "n_words", empty("starts", "int"), empty("ends", "int"), empty("items", "string"))


def digests(found: DataFrame) -> DataFrame:
    """The columns of op6 from those of hits()."""
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id",
        "n_words",
        (total("ends") - total("starts")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs in which no window occurs; every column stays. Rows with a contaminated row's doc_id go too;
    rows without an id are judged by their own text."""
    return without(docs, _hits(docs, benchmark, **options).filter(F.size("items") > 0), "contaminated")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP6_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '{_CLASS}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOW}, '{_CLASS}') AS w FROM benchmark),
bw AS (SELECT item_id, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i, w FROM b WHERE len(w) > 0),
bs AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM bw),
ns AS (SELECT DISTINCT n FROM bs),
dp AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, ns WHERE len(w) >= n),
ds AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM dp),
h AS (SELECT doc_id, item_id, i, n FROM ds JOIN bs USING (n, g)),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS place FROM h),
c AS (SELECT doc_id, count(*) AS n_hit FROM p GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
