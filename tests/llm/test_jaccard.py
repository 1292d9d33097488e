import random

import pytest

from docflow.llm import jaccard
from docflow.llm.components import components
from docflow.llm.jaccard import classes, deduplicated


def shingles(text, k):
    import re

    w = re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]) or rows[i][0] is not None and rows[i][0] == rows[j][0]:
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    low = {r: min((d for d in v if d is not None), default=None) for r, v in ids.items()}
    return sorted(((d, len(sets[i]), low[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, n_base=12, copies=14):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(30)]
    rows, i = [], 0
    for b in range(n_base):
        base = [word() for _ in range(rng.choice([3, 8, 12, 25, 60, 150]))]
        if b % 3 == 0:
            base += passage
        for _ in range(rng.choice([1, 2, copies])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(w))
                rng.choice([lambda: w.__setitem__(at, word()), lambda: w.insert(at, word()), lambda: w.pop(at)])()
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(i, ""), (i + 1, None), (i + 2, "one"), (i + 3, "ONE"), (i + 4, " \n"), (i + 5, "é  Two"), (None, rows[0][1]), (None, "no id at all here"), (i + 6, "a " * 5000), (i + 7, "A " * 400)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k, percent, seed", [(3, 90, 1), (3, 90, 2), (5, 80, 3), (2, 60, 4)])
def test_against_brute_force(spark, monkeypatch, k, percent, seed):
    if seed % 2:
        for name in ("CHUNK_ROWS", "SALT_ROWS"):
            monkeypatch.setattr(jaccard, name, 3)
        monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    rows = corpus(seed)
    got = classes(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int"), k, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, k, percent)


def test_batches_of_a_few_rows(spark):
    rows = corpus(8, 6, 10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 3, 90)


def test_repeated_ids_and_dedup(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, "x y z q r s"), (4, None), (5, None), (None, "a b c d e f")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, _once int")
    got = deduplicated(df)
    assert got.columns == ["doc_id", "text", "_once"] and sorted(r.doc_id for r in got.collect()) == [1, 3, 4, 5]
    for name in ("own", "none", "ROW", "nth", "keep_id", "id", "a.b"):
        got = deduplicated(df.withColumnRenamed("_once", name))
        assert got.columns == ["doc_id", "text", name] and sorted(r.doc_id for r in got.collect()) == [1, 3, 4, 5]


def test_ids_of_any_size(spark):
    """Ids of 64-bit hashes, above and below 2**62 and negative, beside rows without an id."""
    big, w = 1 << 62, [f"w{i}" for i in range(60)]
    rows = [(big + 5, " ".join(w[:20])), (big + 6, " ".join(w[:20]) + " x"), ((1 << 63) - 1, " ".join(w[20:40])), (-(1 << 63), ""), (-7, " ".join(w[40:])), (big + 9, " ".join(w[40:]))]
    for more in ([], [(None, " ".join(w[:20])), (None, " ".join(w[20:40])), (None, "no id at all"), (None, "no id at all")]):
        df = spark.createDataFrame(rows + more, "doc_id long, text string")
        assert sorted((tuple(r) for r in classes(df, 3, 90).collect()), key=str) == brute(rows + more, 3, 90)
        kept = sorted(r.doc_id for r in deduplicated(df, 3, 90).collect() if r.doc_id is not None)
        assert kept == [-(1 << 63), -7, big + 5, (1 << 63) - 1]
        assert deduplicated(df, 3, 90).filter("doc_id is null").count() == (1 if more else 0)


def test_empty_table(spark):
    assert classes(spark.createDataFrame([], "doc_id long, text string"), 3, 90).count() == 0


@pytest.mark.parametrize("bound", [0, 1000])
def test_components(spark, bound):
    rng = random.Random(6)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), bound).collect()}
    low = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert got == {x: r for x, r in low.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_rows_without_an_id_are_judged_by_their_own_text(spark):
    w = [f"w{i}" for i in range(60)]
    linked, near, alone = " ".join(w[:30]), " ".join(w[30:]), "on its own here"
    rows = [(1, linked), (None, linked + " x"), (None, near), (None, near), (None, near + " y"), (None, alone), (None, ""), (2, None)]
    for d, left in ((rows, [1, 2]), (rows[2:], [2])):
        got = deduplicated(spark.createDataFrame(d, "doc_id long, text string")).collect()
        assert sorted(r.doc_id for r in got if r.doc_id) == left
        none = [r.text for r in got if r.doc_id is None]
        assert len(none) == 3 and {alone, ""} < set(none) and len({near, near + " y"} & set(none)) == 1


def test_several_texts_of_one_id(spark):
    w = [f"w{i}" for i in range(3000)]
    short, long = " ".join(w[:22]), " ".join(w[100:1102])
    rows = [(5, short), (5, long), (7, " ".join(w[:23])), (1, " ".join(w[98:1102])), (3, "only here once"), (9, "only here once"), (9, " ".join(w[2000:2030])), (11, " ".join(w[2000:2031]))]
    got = classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 3, 90)
