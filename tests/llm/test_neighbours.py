import math
import random

import numpy as np
import pytest

from docflow.llm.neighbours import LEAST_OPEN, Graph, entries, fitted, nearest_neighbours, op13_nearest_neighbours, _layout, _valid

SCHEMA = "vec_id long, embedding array<double>, query_id string, score int"


def brute(rows, k, step):
    """Lists of (vec_id, score) by query row, of distinct rows that take part."""
    ok = {(i, tuple(e)) for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)}
    out = []
    for i, e in ok:
        if i % step == 0:
            scores = []
            for j, v in ok:
                if len(v) == len(e) and (j, v) != (i, e):
                    s = 0.0
                    for a, b in zip(e, v):
                        s += a * b
                    scores.append((-s, j))
            out += [(i, n, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "x", 1) for i, e in rows], SCHEMA)


def cases(n=150, size=4, seed=3):
    rng = random.Random(seed)
    spot = [0.5, -0.25, 0.125, 0.0]
    rows = [(i, [rng.gauss(0, 1) for _ in range(size)]) for i in range(n)]
    rows += [(1000 + i, spot) for i in range(n // 2)]
    rows += [(2000, None), (2020, []), (2040, [1.0] * 2), (2060, [2.0] * 2), (2080, [1.0, None, 0.0, 0.0]), (2100, [math.nan, 0.0, 0.0, 0.0]), (2120, [math.inf, 0.0, 0.0, 0.0]), (None, spot), (2140, [0.0] * size), (20, spot), (40, spot), (40, spot), (2160, [50.0, 0.0, 0.0, 0.0])]
    return rows


def test_every_list_open_is_exact(spark):
    rows = cases()
    got = nearest_neighbours(frame(spark, rows).repartition(5), 20, 20, ratio=1e9, list_rows=10)
    assert found(got) == brute(rows, 20, 20)


def test_fewer_candidates_give_all(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(5)]
    assert found(nearest_neighbours(frame(spark, rows), 20, 2)) == brute(rows, 20, 2)
    assert nearest_neighbours(spark.createDataFrame([], SCHEMA)).collect() == []
    assert found(nearest_neighbours(frame(spark, [(20, [1.0])]))) == []


def test_a_tight_group_still_gets_enough(spark):
    rng = random.Random(1)
    near = [(20 + i, [1.0 + 1e-9 * i, 0.0, 0.0, 0.0]) for i in range(5)]
    rows = near + [(100 + i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    got = nearest_neighbours(frame(spark, rows), 20, 20, list_rows=5)
    count = {q: 0 for q, *_ in found(got)}
    for q, *_ in found(got):
        count[q] += 1
    assert set(count.values()) == {20}


def test_copies_keep_the_smallest_ids(spark):
    rows = [(i, [1.0, 2.0]) for i in range(500)] + [(1000 + i, [0.5, float(i)]) for i in range(3)]
    got = found(nearest_neighbours(frame(spark, rows), 20, 20))
    assert got == brute(rows, 20, 20)
    held = entries(_valid(frame(spark, rows)), 21).collect()
    assert max(len(r.ids) for r in held) == 21 and len(held) == 4


def test_graph_reaches_the_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 12))
    graph = Graph(fitted(x, 120))
    far = ((x[:200, None] - graph.centroids) ** 2).sum(2)
    got = graph.search(x[:200], 1.2, LEAST_OPEN)
    inside = far <= far.min(1, keepdims=True) * 1.2**2
    assert np.isfinite(got[inside]).mean() > 0.97
    assert np.allclose(got[np.isfinite(got)], far[np.isfinite(got)])
    assert (got.argmin(1) == far.argmin(1)).mean() > 0.99


def test_lists_are_balanced():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(2000, 6)) * 0.01, rng.normal(size=(500, 6)) * 5])
    c = fitted(x, 50)
    size = np.bincount(((x[:, None] - c) ** 2).sum(2).argmin(1), minlength=50)
    assert size.max() < 2500 / 4


def test_layout_bounds_rows_and_queries():
    points, asked = [10, 90, 30, 250, 0, 40], [5, 5, 100, 3, 0, 1]
    plan = _layout(points, asked, 100, 50)
    used = [set(range(b, b + c * t)) for b, c, t in plan.tolist()]
    for i, a in enumerate(used):
        for j, b in enumerate(used):
            if i < j and a & b:
                assert points[i] + points[j] <= 100 and asked[i] + asked[j] <= 50
    assert plan[3, 1] == 3 and plan[2, 2] == 2


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_recall(spark, sf):
    d = f"/root/testdata/{sf}"
    table = spark.read.parquet(f"{d}/embeddings.parquet").toPandas()
    x, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    got = op13_nearest_neighbours(spark, d).toPandas()
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        best = set(ids[np.lexsort([ids, -score])[:20]])
        own = got[got["query_id"] == ids[i]]
        assert sorted(own["rank"]) == list(range(1, 21))
        assert np.allclose(own["score"], [x[np.flatnonzero(ids == v)[0]] @ x[i] for v in own["vec_id"]])
        hits, total = hits + len(best & set(own["vec_id"])), total + 20
    assert hits / total >= 0.9
