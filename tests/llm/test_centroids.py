import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from docflow.llm.centroids import clustered, op11_centroid_clustering

SCHEMA = "vec_id long, embedding array<double>, cluster string, weight int"


def brute(rows, k, rounds, size, scale=256):
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e in rows if e is not None and len(e) == size and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    c = [q for _, q in order[:k]]
    if not c:
        return []

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, v)), n) for n, v in enumerate(c)) for _, q in kept]

    for _ in range(rounds):
        near = assign()
        for n in range(len(c)):
            own = [q for (_, q), (_, m) in zip(kept, near) if m == n]
            if own:
                c[n] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    total = sum(d for d, _ in near)
    fits = lambda v: v if v < 1 << 63 else None
    by = {n: sum(d for d, m in near if m == n) for n in range(len(c))}
    bad = {m for d, m in near if d >= 1 << 63}
    return sorted(((i, n, fits(d), None if n in bad else fits(by[n]), None if bad else fits(total), hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, near)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def cases(n=120, size=4, seed=3):
    rng = random.Random(seed)
    spot = [0.5, -0.25, 0.125, -0.0]
    rows = [(i, [rng.gauss(0, 1) for _ in range(size)]) for i in range(n)]
    rows += [(1000 + i, spot) for i in range(n // 2)]  # a third of all
    rows += [(2000, None), (2001, []), (2002, [1.0] * (size + 1)), (2003, [1.0, None, 0.0, 0.0]), (2004, [math.nan, 0.0, 0.0, 0.0]), (2005, [math.inf, 0.0, 0.0, 0.0]), (None, spot), (7, [0.0] * size), (7, spot)]
    return rows


@pytest.mark.parametrize("k", [1, 5, 40, 500])
def test_against_brute_force(spark, k):
    rows = cases()
    got = clustered(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(7), k, 5, 4)
    assert rows_of(got) == brute(rows, k, 5, 4)


def test_large_numbers_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1e6, 3e9, -1e12, 0.3, 1e30]) * rng.random() for _ in range(4)]) for i in range(40)]
    got = clustered(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), 6, 3, 4)
    assert rows_of(got) == brute(rows, 6, 3, 4)
    middle = [(i, [rng.uniform(-30000, 30000) for _ in range(4)]) for i in range(40)]
    got = clustered(spark.createDataFrame([(*r, "x", 1) for r in middle], SCHEMA), 6, 3, 4)
    assert rows_of(got) == brute(middle, 6, 3, 4)


def test_empty_and_all_left_out(spark):
    assert clustered(spark.createDataFrame([], SCHEMA)).collect() == []
    assert clustered(spark.createDataFrame([(1, [1.0], "x", 1), (2, None, "x", 1)], SCHEMA)).collect() == []


def test_hot_vector_is_one_row_of_the_rounds(spark, tmp_path):
    rows = spark.range(6000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 > 0, F.array(F.lit(0.5), F.lit(0.5))).otherwise(F.array(F.sin("id"), F.cos("id"))).alias("embedding"))
    got = clustered(rows, 4, 2, 2)
    assert got.count() == 6000
    assert got.filter("vec_id % 3 > 0").select("cluster", "distance").distinct().count() == 1


def test_query_keeps_every_row(spark):
    got = op11_centroid_clustering(spark, "/root/testdata/sf0.001")
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
    assert got.select("inertia").distinct().count() == 1
