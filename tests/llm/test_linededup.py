import random
import re

import pytest
from pyspark.sql import functions as F

from docflow.llm import linededup
from docflow.llm.linededup import deduplicated, op7_line_dedup


def tokens(line, k=5):
    w = re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows):
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = SparkSession.getActiveSession()
    th = {t: h for t, h in spark.createDataFrame([(t,) for _, t in rows], "t string").select("t", F.xxhash64("t")).collect()}
    all_lines = sorted({((1 << 63) - 1 if d is None else d, th[t], i): tokens(s) for d, t in rows if t is not None for i, s in enumerate(t.split("\n"))}.items())
    gone = set()
    for x, (place, own) in enumerate(all_lines):
        if own and any(o and 100 * len(own & o) >= 80 * len(own | o) for _, o in all_lines[:x]):
            gone.add(place)
    return sorted(((d, 0 if t is None else len(t.split("\n")), [i for i in range(0 if t is None else len(t.split("\n"))) if ((1 << 63) - 1 if d is None else d, th[t], i) in gone]) for d, t in rows), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    bases = [[word() for _ in range(n)] for n in (1, 3, 5, 9, 30, 55, 60, 90, 120)]
    passage = [word() for _ in range(40)]
    rows = []
    for i in range(40):
        text = []
        for _ in range(rng.randrange(1, 6)):
            w = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                w[rng.randrange(len(w))] = word()
            if rng.random() < 0.2:
                w += passage
            text.append(rng.choice([" ", "\t", ""]) + rng.choice([" ", "  "]).join(w).upper() if rng.random() < 0.2 else " ".join(w))
        rows.append((i, "\n".join(text)))
    return rows + [(100, ""), (101, None), (102, "\n\n \n"), (None, rows[0][1]), (5, "other text of five"), (5, "other text of five"), (103, "a " * 3000 + "\n" + "A " * 3000), (104, "}\n}")]


@pytest.mark.parametrize("seed, broadcast", [(1, 10**6), (2, 0)])
def test_against_brute_force(spark, tmp_path, monkeypatch, seed, broadcast):
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", broadcast)
    rows = corpus(seed)
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, h1 string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.doc_id, r.n_lines, r.n_removed, [int(i) for i in r.removed_lines.split(",") if i]) for r in op7_line_dedup(spark, str(tmp_path)).collect()]
    assert sorted(((i, n, gone) for i, n, _, gone in got), key=str) == brute(rows)
    assert all(n == len(gone) for _, _, n, gone in got)


def test_texts(spark):
    df = spark.createDataFrame([(2, "one two three\nkeep me", 1), (1, "head\nOne  two three", 2), (3, "keep me", 3), (4, None, 4), (5, "\n", 5), (6, "head\n\nlast", 6)], "doc_id long, text string, line int")
    got = {r.doc_id: (r.text, r.line) for r in deduplicated(df).collect()}
    assert got == {1: ("head\nOne  two three", 2), 2: ("keep me", 1), 4: (None, 4), 5: ("\n", 5), 6: ("\nlast", 6)}


@pytest.mark.parametrize("longest", [64, 10**6])
def test_hot_token_of_unlike_lines(spark, tmp_path, monkeypatch, longest):
    """A passage that many unlike lines share, in short lines so that it lies in their prefixes, beside near copies among them; hot
    tokens salted or not, long lists joined by pairs of tokens or by one."""
    monkeypatch.setattr(linededup, "LONG_LIST", 8 if longest == 64 else 10**6)
    monkeypatch.setattr(linededup, "HOT_LEVEL", 0 if longest == 64 else 10**6)
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(14)]
    lines = []
    for i in range(600):
        own = [f"u{rng.randrange(10**6)}" for _ in range(rng.choice([1, 2, 6, 9]))]
        lines.append(" ".join((own + passage) if i % 2 else (passage + own)))
    lines += ["a a a a a", "a a a a a a", "a a a a a a a", "b b b b b b", "B  b b b b"]
    rows = [(i, "\n".join(lines[i::40])) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.doc_id, r.n_lines, [int(i) for i in r.removed_lines.split(",") if i]) for r in op7_line_dedup(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert sum(len(g) for _, _, g in got) > 100


def test_clashing_columns_and_null_ids(spark):
    top = (1 << 63) - 1
    rows = [(None, "same words here\nmine", 1), (top, "same words here\nlast", 2), (5, "x\nsame  words HERE", 3), (None, "same words here\nmine", 4)]
    for name in ("_own", "_lines", "row", "Parts", "kept", "gone", "no_id", "h1", "a.b"):
        got = deduplicated(spark.createDataFrame(rows, ["doc_id", "text", name]).withColumn("doc_id", F.col("doc_id").cast("long")))
        assert got.columns == ["doc_id", "text", name]
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([(None, "mine", 1), (top, "last", 2), (5, "x\nsame  words HERE", 3), (None, "mine", 4)], key=str)


def test_empty_table(spark):
    assert deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shuffle_files_go_with_their_step(spark, monkeypatch):
    """Once a large step is stored, Spark keeps no shuffle files of it: disk holds those of one step, whatever the table's size."""
    import time

    from docflow.llm import common

    files = lambda: spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().size()

    def settled(most):
        end = time.monotonic() + 15
        while files() > most and time.monotonic() < end:
            time.sleep(0.2)
        return files()

    common.released(spark)
    before = settled(0)
    monkeypatch.setattr(common, "LARGE_STEP", 0)
    lines = linededup.identities(spark.createDataFrame(corpus(4), "doc_id long, text string"))
    assert settled(before) <= before
    linededup.meetings(lines, 5, 80)
    assert settled(before) <= before


def test_texts_are_hashed_once_not_by_line(spark):
    """A text's hash belongs below its cut into lines; above it, each line would hash the whole text."""
    plan = linededup._lines(spark.createDataFrame([(1, "a\nb")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate", 1)
    assert "xxhash64" in below and "xxhash64" not in above


def test_shingles_of_rows_are_those_of_arrays(spark):
    """Rarity is counted over rows of shingles and looked up for arrays of them: both are the same hashes, of short lines too."""
    lines = spark.createDataFrame([("one",), ("a b",), ("a b c d",), ("a b c d e",), ("a b c d e f g",), ("x " * 40 + "y",), ("",)], "s string")
    arrays = lines.select(F.explode(linededup._shingles(F.col("s"), 5)).alias("t"))
    rows = linededup._shingle_rows(lines, 5)
    assert sorted(r.t for r in arrays.collect()) == sorted(r.t for r in rows.collect())
    assert arrays.count() == 1 + 1 + 1 + 1 + 3 + 37 + 1


def test_only_lines_of_frequent_tokens_are_ordered_by_rarity(spark, tmp_path, monkeypatch):
    """Rarity is counted for lines that have a token of a long list, not for all; what both orders find together is whole."""
    monkeypatch.setattr(linededup, "LONG_LIST", 8)
    seen, levels = [], linededup.levels
    monkeypatch.setattr(linededup, "levels", lambda lines, k: seen.append(lines.count()) or levels(lines, k))
    rng = random.Random(5)
    words = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    passage, bases = words(20), [words(40) for _ in range(6)]
    lines = [" ".join(passage + words(rng.choice([1, 2, 9]))) for _ in range(30)]
    for i in range(60):
        own = list(bases[i % 6]) if i < 18 else words(40)
        own[rng.randrange(40)] = "x"
        lines.append(" ".join(own))
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i::9])) for i in range(9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.doc_id, r.n_lines, [int(i) for i in r.removed_lines.split(",") if i]) for r in op7_line_dedup(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert len(seen) == 1 and 0 < seen[0] <= 30
