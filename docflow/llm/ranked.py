"""Ranked lexical search: the highest-scoring documents of every item, by the three phases of TPUT over postings by term.

Postings are laid out by term and falling contribution, so that a frequent term's list lies over as many partitions as it
needs. An item's score is the sum of its terms' contributions. The phases, for all items of a block at once:

1. The heads of the lists are fetched, k postings each. The k-th best score of an item among their documents is a lower bound
   of its k-th score.
2. That bound divided by the item's number of lists is its uniform threshold: a document that is below it in every list can't be among
   the k. Postings at or above the threshold are fetched from every list. A document's sum over them, and what it may have in
   the lists where it wasn't seen (below the threshold, and at most the list's largest), is an upper bound of its score.
3. Documents whose upper bound reaches the lower one of an item are candidates; their terms are looked up and scored exactly.

A posting that several items ask for is fetched once, and documents meet items in memory: no rows are made of pairs of
documents and items but the k best that each task has of an item.

Only terms of items are kept of the documents: up to TERMS of them by a table sent to the tasks, beyond that by a join. Items are
taken in blocks of about SENT_ROWS of their terms, which are sent to the tasks; each block reads the postings anew. Terms are compared by
64-bit hashes. Nothing is cut: thresholds drop only what provably can't be in the result.

Defined results: a null or empty text has no terms, and such a document isn't counted; an item without terms, or whose terms no
document has, gives no rows; rows of one item_id (also null) are one item, a term counts once; rows of one doc_id are
documents each; a row without an id is a document whose ties come last; equal scores go by ascending doc_id; repeated documents
tie; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, LOWER, U64, blocks, stored, table, word_hashes, words
from .decontaminate import Lookup

BEST = 10
TERMS = 1_000_000  # terms of items that are sent to the tasks, 8 bytes each; more are joined
SENT_ROWS = 250_000  # terms of items in a block, about; an item's terms are never parted
_SCHEMA = "doc long, doc_id long, n long, terms array<long>, tf array<long>"


def term_counts(docs: DataFrame, known: np.ndarray | None = None) -> DataFrame:
    """(doc, doc_id, n, terms, tf) of rows (doc, doc_id, text) with terms: their number, and the different ones with their counts; of
    known terms only, if given (sorted hashes)."""
    shared = None if known is None else docs.sparkSession.sparkContext.broadcast(Lookup(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in blocks(batches):
            data = LOWER[data]
            starts, ends, doc = words(data, offs, ALNUM_WORDS)
            n = np.bincount(doc, minlength=batch.num_rows)
            hashes = word_hashes(data, starts, ends)
            if shared is not None:
                at, _ = shared.value.find(hashes)
                hashes, doc = hashes[at], doc[at]
            order = np.lexsort([hashes, doc])
            hashes, doc = hashes[order], doc[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            tf = np.diff(np.append(first, len(hashes)))
            some = np.flatnonzero(n)
            bounds = np.append(np.searchsorted(doc[first], some), len(first))
            lists = lambda v: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(some)) for c in ("doc", "doc_id")), pa.array(n[some], pa.int64()), lists(hashes[first].view(np.int64)), lists(tf)], ["doc", "doc_id", "n", "terms", "tf"])

    return docs.mapInArrow(run, _SCHEMA)


class Lists:
    """The lists of a block of items by term: for each term the items that have it, with the term's weight."""

    def __init__(self, rows: pa.Table):
        item, term, w = (rows.column(c).to_numpy() for c in ("item", "term", "w"))
        self.items, at = np.unique(item, return_inverse=True)
        order = np.argsort(term, kind="stable")
        self.terms, first = np.unique(term[order], return_index=True)
        self.first = np.append(first, len(term))
        self.item, self.w = at[order], w[order]
        self.top = rows.column("top").to_numpy()[order]
        self.size = np.bincount(at, minlength=len(self.items))
        # documents that are worked on at a time: neither their cells nor what they have of all lists exceeds a bound
        self.rows = max(1, min((1 << 21) // max(1, len(self.items)), (1 << 22) // max(1, len(term))))
        self.exact = float((self.w * self.top).max(initial=0)) * self.size.max(initial=0) < 1 << 53

    def spread(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, list): for each of terms, by its place, the lists of items that have it."""
        if not len(terms) or not len(self.terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        n = np.where(self.terms[at] == terms, self.first[at + 1] - self.first[at], 0)
        place = np.repeat(np.arange(len(terms)), n)
        return place, np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + self.first[at][place]

    def sums(self, rows: int, row: np.ndarray, lists: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Sums of values by (row, item)."""
        key, cells = row * len(self.items) + self.item[lists], rows * len(self.items)
        if self.exact:
            out = np.bincount(key, value, cells).astype(np.int64)
        else:
            out = np.zeros(cells, np.int64)
            np.add.at(out, key, value)
        return out.reshape(rows, -1)


class _Best:
    """The k best (score, doc_id) of each item among those that come by; ties go by doc_id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.found: list[np.ndarray] = [np.empty((0, 4), np.int64)]  # item, score, null id, id
        self.held = 0

    def add(self, score: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        row, item = np.nonzero(score >= self.least)
        self.found.append(np.column_stack([item, score[row, item], no_id[row], doc[row]]))
        self.held += len(row)
        if self.held > 4 * self.k * len(self.least) + 100_000:
            self.settle()

    def settle(self) -> np.ndarray:
        all_ = np.concatenate(self.found)
        all_ = all_[np.lexsort([all_[:, 3], all_[:, 2], -all_[:, 1], all_[:, 0]])]
        nth = np.arange(len(all_)) - np.searchsorted(all_[:, 0], all_[:, 0])
        self.found, self.held = [all_[nth < self.k]], int((nth < self.k).sum())
        last = all_[nth == self.k - 1]
        self.least[last[:, 0]] = last[:, 1]
        return self.found[0]


def _scored(rows: DataFrame, lists: Lists, k: int) -> DataFrame:
    """(item, doc_id, score): exact scores of rows (doc_id, m, terms, tf) for all items of lists; of each task an item's k best."""
    held = rows.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = held.value
        best = _Best(len(lists.items), k)
        for whole in batches:
            for i in range(0, whole.num_rows, lists.rows):
                batch = whole.slice(i, lists.rows)
                n, column = batch.num_rows, batch.column("terms")
                row = np.repeat(np.arange(n), np.diff(column.offsets.to_numpy()))
                tf, m = batch.column("tf").flatten().to_numpy(), batch.column("m").to_numpy()[row]
                place, own = lists.spread(column.flatten().to_numpy())
                u = 1_000_000_000 * tf // (1000 * tf + 8 * m)
                ids = batch.column("doc_id")
                best.add(lists.sums(n, row[place], own, lists.w[own] * u[place]), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        out = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(lists.items[out[:, 0]]), pa.array(out[:, 3], pa.int64(), mask=out[:, 2] > 0), pa.array(out[:, 1])], ["item", "doc_id", "score"])

    return rows.select("doc_id", "m", "terms", "tf").mapInArrow(run, "item long, doc_id long, score long")


def _kth(scores: DataFrame, k: int) -> dict[int, int]:
    """The k-th largest score of each item that has so many."""
    nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    return {r["item"]: r["score"] for r in scores.select("item", "score").withColumn("nth", nth).filter(F.col("nth") <= k).filter(F.col("nth") == k).collect()}


def postings(found: DataFrame) -> DataFrame:
    """(term, doc, u) of found (doc, m, terms, tf), by term and falling u: a contribution is u times the term's weight."""
    one = found.select("doc", "m", F.explode(F.arrays_zip("terms", "tf")).alias("x"))
    return one.select(F.col("x.terms").alias("term"), "doc", F.expr("cast((1000000000 * x.tf) div (1000 * x.tf + 8 * m) as int)").alias("u"))


def _m(docs: int, length: int) -> Column:
    return F.expr(f"cast(10 + (cast(90 as decimal(2,0)) * cast(n as decimal(18,0)) * cast({docs} as decimal(18,0))) div cast({max(1, length)} as decimal(18,0)) as long)").alias("m")


def candidates(held: DataFrame, lists: Lists, least: np.ndarray, k: int) -> DataFrame:
    """(doc) that may be among the k best of an item: phase 2. held is (term, doc, u), least a lower bound of each item's k-th score.

    Fetched are the postings that reach the uniform threshold of an item that has the term. A task sees all that is fetched of its
    documents; the k-th partial sum that it has seen of an item is a lower bound too."""
    spark = held.sparkSession
    threshold = np.maximum(1, -(-least // lists.size))
    weight = np.maximum(1, lists.w)
    need = np.minimum.reduceat(-(-threshold[lists.item] // weight), lists.first[:-1])
    rows = pa.table({"term": lists.terms, "need": need})
    needs = F.broadcast(spark.createDataFrame(rows.to_pandas(), "term long, need long"))  # a row for each term of the block
    bound = np.minimum(threshold[lists.item] - 1, lists.w * lists.top)
    shared = spark.sparkContext.broadcast((lists, bound, np.bincount(lists.item, bound, len(lists.items)).astype(np.int64), least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, bound, all_, least = shared.value
        kept = np.empty((0, len(lists.items)), np.int64)
        left: list[tuple[np.ndarray, ...]] = []

        def judged(doc: np.ndarray, term: np.ndarray, u: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal kept
            names, row = np.unique(doc, return_inverse=True)
            at = np.searchsorted(row, np.arange(0, len(names) + lists.rows, lists.rows))
            for i in range(len(at) - 1):
                own = slice(at[i], at[i + 1])
                if at[i] == at[i + 1]:
                    continue
                n = int(row[at[i + 1] - 1]) - i * lists.rows + 1
                place, list_ = lists.spread(term[own])
                r = row[own][place] - i * lists.rows
                value = lists.sums(n, r, list_, lists.w[list_] * u[own][place])
                upper = value + all_ - lists.sums(n, r, list_, bound[list_])
                kept = np.concatenate([kept, value])
                if len(kept) > k:
                    kept = -np.partition(-kept, k - 1, 0)[:k]
                low = np.maximum(least, kept.min(0)) if len(kept) == k else least
                some = np.flatnonzero(((upper >= low) & (upper > 0)).any(1))
                yield pa.RecordBatch.from_arrays([pa.array(names[i * lists.rows :][some])], ["doc"])

        for batch in batches:
            doc, term, u = (batch.column(c).to_numpy() for c in ("doc", "term", "u"))
            if not len(doc):
                continue
            last = int(np.searchsorted(doc, doc[-1]))  # the last document may go on in the next batch
            if last == 0 and left and left[0][0][0] == doc[0]:
                left.append((doc, term, u))
                continue
            parts = [*left, (doc[:last], term[:last], u[:last])]
            left = [(doc[last:], term[last:], u[last:])]
            yield from judged(*(np.concatenate(x) for x in zip(*parts)))
        if left:
            yield from judged(*(np.concatenate(x) for x in zip(*left)))

    fetched = held.join(needs, "term").filter(F.col("u") >= F.col("need")).select("doc", "term", F.col("u").cast("long").alias("u"))
    return fetched.repartition("doc").sortWithinPartitions("doc").mapInArrow(run, "doc long")


def _block(found: DataFrame, held: DataFrame, lists: Lists, k: int) -> DataFrame:
    """(item, doc_id, score): the best of the items of lists, k of each and maybe more."""
    spark = found.sparkSession
    terms = F.broadcast(spark.createDataFrame(pa.table({"term": lists.terms}).to_pandas(), "term long"))
    nth = F.row_number().over(Window.partitionBy("term").orderBy(F.desc("u"), "doc"))
    heads = held.join(terms, "term").withColumn("nth", nth).filter(F.col("nth") <= k).select("doc").distinct()
    of = lambda docs: found.join(docs, "doc", "left_semi")
    first = _kth(_scored(of(stored(heads, "heads")), lists, k), k)
    least = np.array([first.get(int(i), 1) for i in lists.items], np.int64)
    return _scored(of(stored(candidates(held, lists, least, k), "candidates")), lists, k)


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, known_terms: int = TERMS, block_rows: int = SENT_ROWS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents (doc_id, text) of every item (item_id, text), with scores above 0."""
    spark, item = docs.sparkSession, F.xxhash64(F.col("item_id").cast("string"))
    texts = items.select(item.alias("doc"), F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = stored(term_counts(texts).select(F.col("doc").alias("item"), F.explode("terms").alias("term")).distinct(), "item-terms")
    names = items.select(item.alias("item"), "item_id").distinct()
    terms = wanted.select("term").distinct()
    few = terms.count() <= known_terms
    known = np.sort(np.array([r.term for r in terms.collect()], np.int64).view(U64)) if few else None  # known_terms at most
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(term_counts(rows, known), "document-terms")
    n, length = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = found.select("doc", "doc_id", _m(n, length), "terms", "tf")
    held = postings(found)
    held = held if few else held.join(terms, "term", "left_semi")
    held = stored(held.repartitionByRange("term", F.desc("u")).sortWithinPartitions("term", F.desc("u")), "postings")
    facts = held.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("u").cast("long").alias("top"))
    w = F.floor(1000 * F.log((2.0 * n + 2) / (2.0 * F.col("df") + 1))).cast("long")
    lists = stored(wanted.join(facts, "term").select("item", "term", w.alias("w"), "top").filter("w > 0"), "weighted-terms")
    blocks_ = -(-lists.count() // block_rows)
    scores = None
    for b in range(blocks_):
        own = lists.filter(F.pmod(F.xxhash64("item", F.lit("block")), F.lit(blocks_)) == b).toArrow()  # about block_rows
        if own.num_rows:
            part = _block(found, held, Lists(own), k)
            scores = part if scores is None else scores.unionByName(part)
    if scores is None:
        scores = spark.createDataFrame([], "item long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = scores.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS doc, doc_id, {_TERMS} AS t FROM documents),
s AS (SELECT CAST(count(*) AS HUGEINT) AS n_docs, CAST(sum(len(t)) AS HUGEINT) AS n_terms FROM d WHERE len(t) > 0),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
p AS MATERIALIZED (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY doc, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * CAST(n_docs AS DOUBLE) + 2) / (2 * CAST(df AS DOUBLE) + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
m AS (SELECT doc, doc_id, CAST(100 - 90 + (90 * len(t) * n_docs) // n_terms AS BIGINT) AS m FROM d, s WHERE len(t) > 0),
r AS (
  SELECT item_id, doc, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc) GROUP BY item_id, doc, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= {BEST}
"""
