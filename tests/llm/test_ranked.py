import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docflow.llm.ranked import Lists, candidates, ranked

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, score string, term int"
ITEMS = "item_id string, text string, doc int"


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items, k=10):
    held = [(i, w) for i, t in docs if (w := words(t))]
    n, length = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in wanted.items():
        scores = []
        for i, w in held:
            m = 100 - 90 + 90 * len(w) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * tf // (1000 * tf + 8 * m)) for t in terms if (tf := w.count(t)))
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def cases(seed, n=200):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Éa", "ñ", "X9", "the"]
    weights = [1 / (i + 1) for i in range(63)] + [4]
    say = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(i, say(rng.choice([1, 3, 20, 200]))) for i in range(n)]
    docs += [(i + n, "the same text w1 w2") for i in range(n // 2)] + [(5, "w50 w51"), (None, "w50 w51 w52"), (None, "w50 w51 w52"), (900, None), (901, ""), (902, "-- !!"), (903, "w3 " * 70000)]
    items = [(f"i{k}", say(rng.choice([1, 2, 10, 60]))) for k in range(12)]
    items += [("none", "unheard"), ("empty", ""), ("null", None), (None, "w50 w51"), ("i1", "W59 w58"), ("same", "the same text"), ("rep", "w50 w50 W50")]
    return docs, items


@pytest.mark.parametrize("seed, known", [(1, 1_000_000), (2, 1_000_000), (3, 10)])
def test_against_brute_force(spark, seed, known):
    docs, items = cases(seed)
    a = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS).repartition(6)
    b = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    got = sorted((tuple(r) for r in ranked(a, b, known_terms=known).collect()), key=str)
    assert got == brute(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "w1 w2", "x", 1)], DOCS)
    one = spark.createDataFrame([("a", "w1", 1)], ITEMS)
    assert ranked(docs, one).collect() == []
    assert ranked(some, items).collect() == []
    assert [tuple(r) for r in ranked(some, one).collect()] == brute([(1, "w1 w2")], [("a", "w1")])


def test_items_in_blocks(spark):
    docs, items = cases(4)
    a = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS).repartition(6)
    b = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    got = sorted((tuple(r) for r in ranked(a, b, k=3, block_rows=60).collect()), key=str)
    assert got == brute(docs, items, 3)


def test_thresholds_leave_most_documents_out(spark):
    """A frequent term lies below the threshold of an item with a rare one: its postings are not fetched."""
    held = spark.range(20000).select(F.lit(1).cast("long").alias("term"), F.col("id").alias("doc"), (F.lit(100) + F.col("id") % 7).cast("int").alias("u"))
    held = held.unionByName(spark.range(15).select(F.lit(2).cast("long").alias("term"), F.col("id").alias("doc"), F.lit(500).cast("int").alias("u")))
    lists = Lists(pa.table({"item": [9, 9], "term": [1, 2], "w": [1, 9000], "top": [106, 500]}))
    got = candidates(held, lists, np.array([9000 * 500 + 100]), 10)
    assert sorted(r.doc for r in got.collect()) == list(range(15))


def test_sums_beyond_exact_doubles():
    lists = Lists(pa.table({"item": [1, 1], "term": [5, 6], "w": [1 << 30, 1 << 30], "top": [1 << 30, 1 << 30]}))
    assert not lists.exact
    place, own = lists.spread(np.array([5, 6, 7]))
    assert lists.sums(1, np.zeros(len(place), np.int64), own, lists.w[own] * np.array([(1 << 30) - 1, 1, 5])[place])[0, 0] == 1 << 60
