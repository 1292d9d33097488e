"""Centroid clustering over distinct vectors with multiplicities.

Vectors are turned into integers; equal ones are grouped and counted, so that a vector that a third of all rows share is one
row with a weight from then on. Lloyd's rounds run over the distinct vectors alone: each partition sums weight times
vector per centroid, and the sums of the partitions are added in two steps, so that the driver sees k rows a round. The last
assignment is joined back to the ids: the few vectors that more than one row in HOT share (at most HOT of them, by
counting) by a broadcast, the others by a shuffle of their hashes.

All arithmetic is exact. Vectors whose integers are at most 2**22 in size are worked with in blocks of doubles, in which every sum
stays below 2**53; larger ones in Python's integers.

Defined results: vectors that are null, have another number of components than asked for, or hold a null or non-finite component
(also after the multiplication) are left out. Rows without an id are clustered like others and come back without one, but are
never first centroids. Repeated rows each count and come back. Fewer vectors than centroids give as many centroids as
vectors; an empty table gives no rows. A distance, or a sum of them, that 64 bits can't hold is null. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import finite, joined, stored, table

COMPONENTS, CLUSTERS, ROUNDS, SCALE = 64, 40, 5, 256
EXACT = float(1 << 22)
SUM_PARTS = 32
_INT64 = 1 << 63


def quantised(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, q, h1, h2): vectors (vec_id, embedding) that count, as whole numbers kept in doubles, and two hashes of them."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    whole = lambda y: F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)  # noqa: E731  larger doubles are whole
    rows = rows.filter(F.size("e") == components).withColumn("y", F.transform("e", lambda x: x * float(scale))).filter(finite(F.col("y")))
    return rows.select("vec_id", F.transform("y", whole).alias("q")).select("vec_id", "q", *_keys(F.col("q")))


def _keys(q: Column) -> list[Column]:
    return [F.xxhash64(F.lit(i), q).alias(f"h{i}") for i in (1, 2)]


def nearest(x: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, list[int]]:
    """(number, squared distance) of the centroid nearest to each row of whole numbers; of equally near ones the first."""
    number, distance = np.zeros(len(x), np.int64), np.empty(len(x), object)
    small = np.abs(x).max(1) <= EXACT if len(x) else np.empty(0, bool)
    if max(abs(v) for c in centroids for v in c) > EXACT:
        small[:] = False
    if small.any():
        c, own = np.array(centroids, float), x[small]
        far = (own * own).sum(1)[:, None] - 2 * (own @ c.T) + (c * c).sum(1)
        number[small] = far.argmin(1)
        distance[small] = far.min(1).astype(np.int64).tolist()
    for i in np.flatnonzero(~small):
        row = [int(v) for v in x[i]]
        far = [sum((a - b) ** 2 for a, b in zip(row, c)) for c in centroids]
        distance[i] = min(far)
        number[i] = far.index(distance[i])
    return number, distance.tolist()


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _round(points: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Weight and weighted sum of the vectors nearest to each centroid that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, part = [0] * len(centroids), [[0] * len(centroids[0]) for _ in centroids], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x, weight = _matrix(batch.column("q")), batch.column("weight").to_numpy()
            part = (part + int(batch.column("h1")[0].as_py())) % SUM_PARTS
            number, _ = nearest(x, centroids)
            for c in np.unique(number):
                own = number == c
                w, v = weight[own], x[own]
                count[c] += int(w.sum())
                if float(w.sum()) * float(np.abs(v).max()) < float(1 << 52):
                    total = [int(t) for t in w.astype(float) @ v]
                else:
                    total = [sum(int(a) * int(b) for a, b in zip(w, column)) for column in v.T]
                sums[c] = [a + b for a, b in zip(sums[c], total)]
        some = [c for c, n in enumerate(count) if n]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([part] * len(some), pa.int32()), pa.array([str(count[c]) for c in some], pa.string()), pa.array([[str(v) for v in sums[c]] for c in some], pa.list_(pa.string()))], ["cluster", "part", "n", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        total = [sum(map(int, column)) for column in zip(*rows.column("sums").to_pylist())]
        return pa.table({"cluster": rows.column("cluster")[:1], "part": rows.column("part")[:1], "n": [str(sum(map(int, rows.column("n").to_pylist())))], "sums": pa.array([[str(v) for v in total]], pa.list_(pa.string()))})

    schema = "cluster int, part int, n string, sums array<string>"
    found = points.mapInArrow(run, schema).groupBy("cluster", "part").applyInArrow(add, schema).groupBy("cluster").applyInArrow(add, schema)
    return {r.cluster: (int(r.n), [int(v) for v in r.sums]) for r in found.collect()}


def first_centroids(rows: DataFrame, clusters: int) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes, in order of these."""
    by = rows.filter("vec_id is not null").select(F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256).alias("h"), "q")
    return [[int(v) for v in r.q] for r in by.orderBy("h", "q").limit(clusters).collect()]


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that counts."""
    spark = vectors.sparkSession
    rows = quantised(vectors, components, scale)
    points = stored(rows.groupBy("h1", "h2", "q").agg(F.count(F.lit(1)).alias("weight")), "distinct-vectors")
    centroids = first_centroids(rows, clusters)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        found = _round(points, centroids)
        centroids = [[v // found[c][0] for v in found[c][1]] if c in found else old for c, old in enumerate(centroids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = nearest(_matrix(batch.column("q")), centroids) if batch.num_rows else (np.empty(0, np.int64), [])
            yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), batch.column("weight"), pa.array(number, pa.int32()), pa.array([d if d < _INT64 else None for d in distance], pa.int64())], ["h1", "h2", "weight", "cluster", "distance"])

    assigned = stored(points.mapInArrow(run, "h1 long, h2 long, weight long, cluster int, distance long"), "assigned-vectors")
    part = F.col("distance").cast("decimal(19,0)") * F.col("weight").cast("decimal(18,0)")
    sums = assigned.groupBy("cluster").agg(F.sum(part).alias("s"), F.count_if(F.col("distance").isNull()).alias("lost")).collect()
    inertia = {r.cluster: None if r.lost else int(r.s) for r in sums}
    fits = lambda v: v if v is not None and v < _INT64 else None
    total = fits(None if None in inertia.values() else sum(inertia.values()))
    each = [(c, fits(v), total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, v in inertia.items()]
    facts = spark.createDataFrame(each, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows at most
    back = joined(rows.select("vec_id", "h1", "h2"), assigned, ["h1", "h2"], "weight").drop("h1", "h2", "weight")
    return back.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    steps = f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}
), v AS MATERIALIZED (
  SELECT r, i, CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, unnest(embedding) AS x, unnest(range(1, {COMPONENTS + 1})) AS i FROM e)
), seeds AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM e WHERE vec_id IS NOT NULL
), c0 AS MATERIALIZED (SELECT c, i, x FROM seeds JOIN v USING (r) WHERE c < {CLUSTERS})"""
    for k in range(ROUNDS + 1):
        steps += f""", d{k} AS (
  SELECT r, c, sum((v.x - c{k}.x) * (v.x - c{k}.x)) AS d FROM v JOIN c{k} USING (i) GROUP BY r, c
), a{k} AS MATERIALIZED (SELECT r, arg_min(c, d * {CLUSTERS} + c) AS c, min(d) AS d FROM d{k} GROUP BY r)"""
        if k < ROUNDS:
            steps += f""", s{k} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{k} JOIN v USING (r) GROUP BY c, i
), c{k + 1} AS MATERIALIZED (
  SELECT c, i, CAST((s - (s % n + n) % n) // n AS BIGINT) AS x FROM s{k}
  UNION ALL SELECT c, i, x FROM c{k} WHERE c NOT IN (SELECT c FROM a{k}))"""
    return (
        steps
        + f"""
SELECT e.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256
FROM a{ROUNDS} a JOIN e USING (r) JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{ROUNDS} GROUP BY c) h USING (c)
"""
    )


OP11_SQL = _sql()
