"""Approximate nearest neighbours by inner product over balanced posting lists.

The index is a set of lists, each around a centroid. The centroids are fitted on a bounded sample and split where lists
come out too large; a vector near a boundary is put into each list whose centroid is almost as near as its nearest. The
centroids' neighbour graph is small and held in memory by every task: vectors and queries find their lists by walking it. A
query opens every list whose centroid is not much farther than the nearest one (distance-ratio pruning): few where vectors
are clustered, many where they aren't, with no cap. In the open lists every score is computed.

A larger inner product is a smaller distance once each vector gets one more component that brings all to one length, so lists
are those of Euclidean distance. Vectors far longer than the 99th percentile would spoil that; they are in lists of their own that every
query opens.

Equal vectors are one entry with their smallest ids (as many as a result can hold), so that copies cost neither a long
list nor a long search; equal queries are searched once. Small lists lie together in buckets of a bounded number of rows, large
ones are cut over several, and many queries of one bucket are dealt to several tasks; a task holds the rows of one
bucket and lets the queries stream by. Only counts of lists reach the driver.

Defined results: vectors that are null, empty or zero, or hold a null or non-finite component, and rows without an id, take no part.
Only vectors of one number of components are compared; each such group is searched by itself. Rows of one id and one
vector are one row; rows of one id with different vectors are different rows, each a query and a candidate. The query's
own row is no candidate, its copies under other ids are. Equal scores go by the smaller id. Fewer candidates than asked for
give all of them; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import finite, joined, stored, table

NEAREST = 20
QUERY_STEP = 20
SAMPLE_ROWS = 40_000  # vectors that centroids are fitted on, about
LIST_ROWS, MOST_LISTS = 200, 1024  # a centroid for so many vectors, up to so many; more vectors make lists longer, which are cut
COPIES, BOUNDARY = 2, 1.05  # lists of a vector at most, and how much farther than its nearest centroid another may be
OPEN = 1.2  # a query opens lists up to this many times as far as the nearest
LEAST_OPEN = 16  # and so many of the nearest at least, and as many as hold FULL times the rows asked for
FULL = 4
LONG = 1.2  # times the 99th percentile of lengths, from where vectors are in lists of their own
BUCKET_ROWS, BUCKET_QUERIES = 1 << 14, 1 << 15
DEGREE, ENTRIES = 16, 8
_BLOCK = 1024


@dataclass
class Graph:
    """Centroids, each tied to its nearest ones and to the next by number, so that all can be reached from any."""

    centroids: np.ndarray
    ties: np.ndarray = field(init=False)
    square: np.ndarray = field(init=False)
    entries: np.ndarray = field(init=False)

    def __post_init__(self):
        n = len(self.centroids)
        self.square = (self.centroids**2).sum(1)
        far = self.square[:, None] + self.square - 2 * self.centroids @ self.centroids.T
        near = np.argsort(far, 1, kind="stable")[:, 1 : DEGREE + 1]
        self.ties = np.column_stack([near, (np.arange(n) + 1) % n])
        chosen, least = [0], far[0].copy()
        while len(chosen) < min(ENTRIES, n):  # far from one another
            chosen.append(int(least.argmax()))
            least = np.minimum(least, far[chosen[-1]])
        self.entries = np.array(chosen)

    def search(self, x: np.ndarray, ratio: float, least: int = 1) -> np.ndarray:
        """Squared distances of rows to centroids, infinite where the walk didn't come by. From the entries it opens the ties of
        every centroid within ratio times the nearest distance so far, and of the ``least`` nearest, until there is none left."""
        n, k = len(x), len(self.centroids)
        far, opened = np.full((n, k), np.inf), np.zeros((n, k), bool)
        own, least = (x**2).sum(1), min(least, k)
        rows, nodes = np.repeat(np.arange(n), len(self.entries)), np.tile(self.entries, n)
        while len(rows):
            for i in range(0, len(rows), 1 << 16):
                r, c = rows[i : i + (1 << 16)], nodes[i : i + (1 << 16)]
                far[r, c] = np.maximum(own[r] + self.square[c] - 2 * np.einsum("ij,ij->i", x[r], self.centroids[c]), 0)
            reach = np.maximum(far.min(1) * ratio**2, np.partition(far, least - 1, 1)[:, least - 1])
            r, c = np.nonzero((far <= reach[:, None]) & ~opened & np.isfinite(far))
            opened[r, c] = True
            pairs = (r[:, None] * k + self.ties[c]).ravel()
            pairs = np.unique(pairs[np.isinf(far.ravel()[pairs])])
            rows, nodes = pairs // k, pairs % k
        return far


def fitted(x: np.ndarray, lists: int, rounds: int = 6, seed: int = 1) -> np.ndarray:
    """Centroids of rows; of a list of more than twice its share one half gets the centroid of one of the smallest lists."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(lists, len(x)), replace=False)].copy()
    for turn in range(rounds):
        number = np.concatenate([((c**2).sum(1) - 2 * x[i : i + 4096] @ c.T).argmin(1) for i in range(0, len(x), 4096)])
        size = np.bincount(number, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, number, x)
        c[size > 0] = sums[size > 0] / size[size > 0, None]
        small = np.argsort(size, kind="stable").tolist()
        for big in np.flatnonzero(size > 2 * len(x) / len(c))[::-1] if turn < rounds - 1 else []:
            if size[small[0]] * 2 >= size[big]:
                break
            own = x[number == big]
            c[small.pop(0)] = own[((own - c[big]) ** 2).sum(1).argmax()]
    return c


@dataclass
class Index:
    graph: Graph
    length: float

    def lift(self, x: np.ndarray) -> np.ndarray:
        square = (x**2).sum(1)
        return np.column_stack([x, np.sqrt(np.maximum(self.length**2 - square, 0))])

    def lists_of(self, x: np.ndarray, copies: int = COPIES, boundary: float = BOUNDARY) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every row: the nearest list, and others about as near, up to copies of them; long rows are in the last."""
        far = self.graph.search(self.lift(x), boundary, copies)
        order = np.argsort(far, 1, kind="stable")[:, :copies]
        near = np.take_along_axis(far, order, 1)
        ok = near <= near[:, :1] * boundary**2
        long = np.sqrt((x**2).sum(1)) > self.length
        ok[long, 1:] = False
        order[long, 0] = len(self.graph.centroids)
        rows, k = np.nonzero(ok)
        return rows, order[rows, k]

    def open_to(self, q: np.ndarray, ratio: float, size: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists that each query opens: those within ratio, and the nearest ones up to LEAST_OPEN and until their
        sizes sum up to need; that of long vectors always."""
        q0 = np.column_stack([q, np.zeros(len(q))])
        far = self.graph.search(q0, ratio, LEAST_OPEN)
        poor = np.flatnonzero((np.isfinite(far) * size).sum(1) < need)
        far[poor] = self.graph.search(q0[poor], ratio, len(size))  # of few rows: all centroids
        order = np.argsort(far, 1, kind="stable")
        near = np.take_along_axis(far, order, 1)
        filled = np.cumsum(size[order], 1) - size[order]
        ok = (near <= near[:, :1] * ratio**2) | (filled < need)
        ok[:, :LEAST_OPEN] = True
        rows, k = np.nonzero(ok & np.isfinite(near))
        lists, extra = order[rows, k], np.arange(len(q))
        return np.concatenate([rows, extra]), np.concatenate([lists, np.full(len(q), len(self.graph.centroids))])


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last, so that equal rows give equal scores anywhere."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def entries(rows: DataFrame, keep: int, queries: int = QUERY_STEP) -> DataFrame:
    """(h1, h2, vec, ids, is_query) of every different vector of rows (vec_id, vec, h1, h2): its keep smallest ids."""
    asks = (F.col("vec_id") % queries == 0).alias("asks")
    nth = F.row_number().over(Window.partitionBy("h1", "h2", "asks").orderBy("vec_id"))
    least = rows.select("h1", "h2", "vec", "vec_id", asks).dropDuplicates(["h1", "h2", "vec_id"]).withColumn("nth", nth).filter(F.col("nth") <= keep)
    ids = F.slice(F.array_sort(F.collect_list("vec_id")), 1, keep).alias("ids")  # of 2 * keep rows at most
    return least.groupBy("h1", "h2").agg(F.first("vec").alias("vec"), ids, F.max("asks").alias("is_query"))


def build(points: DataFrame, sample_rows: int = SAMPLE_ROWS, list_rows: int = LIST_ROWS, most_lists: int = MOST_LISTS) -> Index:
    """Centroids and graph from about sample_rows of points (h1, vec), taken by their hash; the index of all rows is laid out by them."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    n, high, top = points.agg(F.count(F.lit(1)), F.percentile_approx(norm, 0.99, 1000), F.max(norm)).first()
    length = min(top, high * LONG)
    part = 1 << 30
    some = points if n <= sample_rows else points.filter(F.pmod(F.xxhash64("h1", F.lit("sample")), F.lit(part)) < int(part * sample_rows / n))
    found = some.select("h1", "h2", "vec").toArrow()
    order = np.lexsort([found.column("h2").to_numpy(), found.column("h1").to_numpy()])
    x = _matrix(found.column("vec"))[order] if len(order) else np.zeros((1, 1))
    index = Index(None, length)
    lifted = index.lift(x[np.sqrt((x**2).sum(1)) <= length])
    index.graph = Graph(fitted(lifted if len(lifted) else index.lift(x), max(1, min(most_lists, n // list_rows))))
    return index


def _layout(points: list[int], asked: list[int], bucket_rows: int, bucket_queries: int) -> np.ndarray:
    """(first bucket, cuts of the list, cuts of its queries) of each list: small lists share a bucket, large ones are cut."""
    out, bucket, rows, queries = np.ones((len(points), 3), np.int64), 0, 0, 0
    for i, (p, q) in enumerate(zip(points, asked)):
        if p > bucket_rows or q > bucket_queries:
            out[i] = (bucket + 1, -(-p // bucket_rows) or 1, -(-q // bucket_queries) or 1)
            bucket, rows, queries = bucket + 1 + int(out[i, 1] * out[i, 2]), 0, 0
            continue
        if rows + p > bucket_rows or queries + q > bucket_queries:
            bucket, rows, queries = bucket + 1, 0, 0
        out[i, 0], rows, queries = bucket, rows + p, queries + q
    return out


class _Bucket:
    """The rows of one bucket, and the best of them for queries that stream by."""

    def __init__(self, rows: pa.Table, best: int):
        lists = rows.column("list").to_numpy()
        order = np.argsort(lists, kind="stable")
        self.vec, self.ids = _matrix(rows.column("vec"))[order], [v for v in rows.column("ids").to_pylist()]
        self.ids = [self.ids[i] for i in order]
        self.h1 = rows.column("h1").to_numpy()[order]
        names, first = np.unique(lists[order], return_index=True)
        self.at = {int(n): (int(a), int(b)) for n, a, b in zip(names, first, np.append(first[1:], len(lists)))}
        self.best = best
        self.most = best * COPIES + 8  # so many entries hold ``best`` different ones, with some that rounding has put in wrong order

    def answer(self, vec: np.ndarray, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """(query, entry) of the entries that may be among the best of each query."""
        score, place = np.full((len(vec), self.most), -np.inf), np.full((len(vec), self.most), -1)
        asking: dict[int, list[int]] = {}
        for i, own in enumerate(lists):
            for n in own:
                asking.setdefault(n, []).append(i)
        for n, rows in sorted(asking.items()):
            a, b = self.at.get(n, (0, 0))
            for i in range(a, b, 4096):
                found = vec[rows] @ self.vec[i : min(b, i + 4096)].T
                where = np.broadcast_to(np.arange(i, i + found.shape[1]), found.shape)
                if found.shape[1] > self.most:
                    top = np.argpartition(-found, self.most - 1, 1)[:, : self.most]
                    found, where = np.take_along_axis(found, top, 1), np.take_along_axis(where, top, 1)
                both, places = np.column_stack([score[rows], found]), np.column_stack([place[rows], where])
                top = np.argpartition(-both, self.most - 1, 1)[:, : self.most]
                score[rows], place[rows] = np.take_along_axis(both, top, 1), np.take_along_axis(places, top, 1)
        q, k = np.nonzero(place >= 0)
        return q, place[q, k]

    def results(self, batch: pa.Table) -> Iterator[pa.RecordBatch]:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            vec = _matrix(part.column("vec"))
            query, place = self.answer(vec, part.column("lists").to_pylist())
            score = inner(vec[query], self.vec[place])
            order = np.lexsort([place, -score, query])
            out: dict[str, list] = {"query": [], "vec_id": [], "score": [], "h": []}
            last, seen, count, edge = -1, set(), 0, None
            for q, p, s in zip(query[order].tolist(), place[order].tolist(), score[order].tolist()):
                if q != last:
                    last, seen, count, edge = q, set(), 0, None
                h = int(self.h1[p])
                if h in seen or count >= self.best and s != edge:
                    continue
                seen.add(h)
                for v in self.ids[p]:
                    out["query"].append(q)
                    out["vec_id"].append(v)
                    out["score"].append(s)
                    out["h"].append(h)
                count, edge = count + len(self.ids[p]), s
            at = np.array(out["query"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part.column("h1").to_numpy()[at]), pa.array(part.column("h2").to_numpy()[at]), pa.array(out["vec_id"], pa.int64()), pa.array(out["h"], pa.int64()), pa.array(out["score"], pa.float64())], ["h1", "h2", "vec_id", "h", "score"])


def _answers(best: int):
    """From rows in order of (part, is_query) to results: a part's list rows come first and are kept, its queries stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, bucket = None, [], None
        for batch in batches:
            keys = batch.column("part").to_numpy()
            asks = batch.column("is_query").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]) if len(keys) else []:
                if keys[a] != now:
                    now, held, bucket = keys[a], [], None
                piece = pa.Table.from_batches([batch.slice(a, b - a)])
                if not asks[a]:
                    held.append(piece)
                elif held:
                    bucket = bucket or _Bucket(pa.concat_tables(held), best)
                    yield from bucket.results(piece)

    return run


def searched(points: DataFrame, index: Index, best: int, ratio: float = OPEN, bucket_rows: int = BUCKET_ROWS, bucket_queries: int = BUCKET_QUERIES) -> DataFrame:
    """(h1, h2, found) of every query among points: found is an array of (score, vec_id, h) of the best rows."""
    spark = points.sparkSession
    held = spark.sparkContext.broadcast(index)

    def place(asked: bool, size: np.ndarray | None = None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for i in range(0, whole.num_rows, _BLOCK):
                    batch = whole.slice(i, _BLOCK)
                    x = _matrix(batch.column("vec"))
                    rows, lists = held.value.open_to(x, ratio, size, FULL * COPIES * best) if asked else held.value.lists_of(x)
                    if asked:  # one row of all the lists that it opens
                        order = np.argsort(rows, kind="stable")
                        at = np.searchsorted(rows[order], np.arange(len(x) + 1))
                        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(lists[order], pa.int32()))
                        yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), batch.column("vec"), lists], ["h1", "h2", "vec", "lists"])
                    else:
                        batch = batch.take(pa.array(rows))
                        yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), batch.column("vec"), batch.column("ids"), pa.array(lists, pa.int32())], ["h1", "h2", "vec", "ids", "list"])

        return run

    lists = stored(points.select("h1", "h2", "vec", "ids").mapInArrow(place(False), "h1 long, h2 long, vec array<double>, ids array<long>, list int"), "lists")
    n = len(index.graph.centroids) + 1
    held_rows, asked = [0] * n, [0] * n
    for r in lists.groupBy("list").count().collect():
        held_rows[r["list"]] = r["count"]
    asks = stored(points.filter("is_query").select("h1", "h2", "vec").mapInArrow(place(True, np.array(held_rows[:-1])), "h1 long, h2 long, vec array<double>, lists array<int>"), "asks")
    for r in asks.select(F.explode("lists").alias("list")).groupBy("list").count().collect():
        asked[r["list"]] = r["count"]
    layout = _layout(held_rows, asked, bucket_rows, bucket_queries)
    plan = spark.createDataFrame([(i, *map(int, x)) for i, x in enumerate(layout)], "list int, bucket long, cuts long, turns long")  # n rows
    plan = F.broadcast(plan)
    which = lambda n: F.pmod(F.xxhash64("h1", F.lit("cut")), n)
    part = F.col("bucket") + F.col("cut") * F.col("turns") + F.col("turn")
    rows = lists.join(plan, "list").withColumn("cut", which(F.col("cuts"))).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)))
    rows = rows.select(part.alias("part"), F.lit(False).alias("is_query"), "h1", "h2", "vec", "ids", "list", F.lit(None).cast("array<int>").alias("lists"))
    one = asks.withColumn("list", F.explode("lists")).drop("lists").join(plan, "list").withColumn("turn", which(F.col("turns"))).withColumn("cut", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    one = one.groupBy(part.alias("part"), "h1", "h2").agg(F.collect_set("list").alias("lists"))  # lists of one bucket
    one = one.join(asks.select("h1", "h2", "vec"), ["h1", "h2"])
    one = one.select("part", F.lit(True).alias("is_query"), "h1", "h2", "vec", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("int").alias("list"), "lists")
    both = rows.unionByName(one).repartition("part").sortWithinPartitions("part", "is_query")
    found = both.mapInArrow(_answers(best), "h1 long, h2 long, vec_id long, h long, score double")
    found = found.groupBy("h1", "h2", "vec_id", "h").agg(F.max("score").alias("score"))  # an entry may lie in two lists
    nth = F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id", "h"))
    top = found.withColumn("nth", nth).filter(F.col("nth") <= best)
    return top.groupBy("h1", "h2").agg(F.array_sort(F.collect_list(F.struct("nth", "score", "vec_id", "h"))).alias("found"))


def _valid(vectors: DataFrame) -> DataFrame:
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite(F.col("vec")) & F.exists("vec", lambda x: x != 0))
    return rows.withColumns({f"h{i}": F.xxhash64(F.lit(i), "vec") for i in (1, 2)})


def nearest_neighbours(vectors: DataFrame, k: int = NEAREST, queries: int = QUERY_STEP, ratio: float = OPEN, **options) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row of vectors (vec_id, embedding) whose id is
    divisible by queries. Options: sample_rows, list_rows, most_lists."""
    spark, rows, out = vectors.sparkSession, _valid(vectors), None
    best = k + 1  # one of them may be the query's own row
    for length in sorted(r[0] for r in rows.select(F.size("vec")).distinct().collect()):
        own = rows.filter(F.size("vec") == length)
        points = stored(entries(own, best, queries), "vectors")
        found = searched(points, build(points, **options), best, ratio)
        asks = own.filter(F.col("vec_id") % queries == 0).select("vec_id", "h1", "h2").distinct()
        found = stored(found.join(asks.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("weight")), ["h1", "h2"]), "found")
        others = F.filter("found", lambda x: ~((x["vec_id"] == F.col("query_id")) & (x["h"] == F.col("h1"))))
        one = joined(asks.withColumnRenamed("vec_id", "query_id"), found, ["h1", "h2"], "weight").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "x"))
        one = one.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double") if out is None else out


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
