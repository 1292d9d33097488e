import hashlib
import random
import re

import pytest

from docflow.llm.decontaminate import decontaminated, digests, hits

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, bench):
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for item, t in bench:
            v = words(t)
            n = min(10, len(v))
            grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    items.add("" if item is None else str(item))
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(30)] + ["Éa", "ñ", "x9"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bench = [(1, say(40)), (2, say(12)), (3, say(10)), (10, say(9)), (4, "only three words"), (5, "alone"), (6, ""), (7, None), (None, say(15)), (1, say(11)), (8, "a a a a a a a a a a a a")]
    docs = [(0, ""), (1, None), (2, say(500))]
    for k, (_, t) in enumerate(bench):
        v = words(t)
        docs += [(10 + k, f"{say(20)}, {(t or '').upper()}! {say(5)}"), (30 + k, f"{say(3)} {' '.join(v[:-1])} {say(3)}"), (50 + k, " ".join(v[2:13])), (70 + k, t)]
    docs += [(90, "a " * 40), (91, "ALONE again"), (92, "a " * 9), (10, "only three words twice only three words"), (None, "alone")]
    return docs, bench


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_against_brute_force(spark, block_bytes):
    docs, bench = cases()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, items int")
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = digests(hits(d, b, block_bytes=block_bytes)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, bench)


def test_filter_keeps_clean_rows_and_columns(spark):
    docs, bench = cases()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, items int")
    kept = decontaminated(d, spark.createDataFrame(bench, "item_id long, text string"))
    bad = {r[0] for r in brute(docs, bench) if r[-1]}
    assert kept.columns == d.columns and sorted((tuple(r[:2]) for r in kept.collect()), key=str) == sorted((r for r in docs if r[0] not in bad), key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert hits(none, bench).count() == 0
    assert digests(hits(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), bench)).first().n_words == 2


def test_rows_without_an_id_are_judged_by_their_own_text(spark):
    _, bench = cases()
    d = spark.createDataFrame([(None, "alone"), (None, "clean words"), (None, None), (3, "alone"), (3, "clean words")], "doc_id long, text string")
    kept = decontaminated(d, spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted(map(str, (r.text for r in kept if r.doc_id is None))) == ["None", "clean words"] and len(kept) == 2
