import pytest
from pyspark.sql import functions as F

from docflow.functions.fixed import BOILERPLATE
from docflow.operators import pages, report, summarize


def column(spark, f, *values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r.o for r in df.select("i", f(F.col("s")).alias("o")).orderBy("i").collect()]


def test_cleaner(spark):
    md = "# Head\n***bold italic*** line\n(1999).\n1. item **x** [text](u) ![i](p)\n<!-- a\nb -->\n```\ncode\n```\n| a |\n--- x\nsee https://x.y/z now <b>t</b>\nFrom JSTOR\n\n\n\n> quote co­op"
    assert column(spark, summarize.strip_markdown, md, "", None) == ["Head\nitem x text\n\nsee   now  t\n\nquote coop", "", None]


def test_sentences(spark):
    text = "One. Two! three? Four\nfive. \"Six\"\n\nSeven. שלום. 8. nine"
    assert column(spark, summarize.split_sentences, text) == [["One.", "Two! three?", "Four five.", '"Six"', "Seven.", "שלום. 8. nine"]]


@pytest.mark.parametrize("script, letter", [("latin", "a"), ("hebrew", "ש")])
def test_candidate_borders(spark, script, letter):
    values = [letter * n for n in (39, 40, 600, 601)] + [letter * 14 + "-" * 26, letter * 15 + "-" * 25, letter * 24 + "-" * 76, letter * 25 + "-" * 75, letter * 65 + "1" * 35, letter * 64 + "1" * 36, letter * 50 + " all RIGHTS reserved", None]
    assert column(spark, lambda c: F.coalesce(summarize.is_candidate(c, script), F.lit(False)), *values) == [False, True, True, False, False, True, False, True, True, False, False, False]
    assert len(BOILERPLATE) == 21


def test_lsa_is_stable_and_in_order():
    s = ["cats purr at night softly", "dogs bark at cats", "stocks fell sharply today", "cats and dogs sleep at night", "rain"]
    found = summarize.lsa_rank(s)
    assert len(found) == 3 and found == sorted(found) and found == summarize.lsa_rank(s)
    assert summarize.lsa_rank(s[:2]) == [0, 1] and summarize.lsa_rank(["", "", "", ""]) == [0, 1, 2]
    same = ["A sentence that is long enough to count here."] * 4
    assert summarize.pick(same) == same[0] and summarize.pick([]) == ""


def test_freshness(spark):
    rows = [("r", "k", 1, 2, "t"), ("r", "k", 9, 2, "t"), ("r", "k", 1, 9, "t"), ("q", "k", 1, 2, "t"), ("r", "k", 1, 2, " "), None]
    schema = "i int, s struct<source_relpath: string, source_kind: string, source_fingerprint: struct<size: bigint, mtime: bigint>, text: string>"
    df = spark.createDataFrame([(i, r and (r[0], r[1], (r[2], r[3]), r[4])) for i, r in enumerate(rows)], schema)
    src, fp = F.struct(F.lit("r").alias("relpath"), F.lit("k").alias("kind")), F.struct(F.lit(1).alias("size"), F.lit(2).alias("mtime"))
    assert [r.f for r in df.select("i", summarize.is_fresh(F.col("s"), src, fp).alias("f")).orderBy("i").collect()] == [True, False, False, False, False, False]


def test_pages(spark):
    df = spark.createDataFrame([("a", i, "x" * n, k) for i, (n, k) in enumerate([(3000, 0), (1500, 1), (10, 0)], 1)], "sha256 string, page_no int, text string, n_images int")
    assert pages.page_stats(df).first()[1:] == (3, 4510, True)
    one = pages.langid_sample(df).first()
    assert one.n_pages == 2 and len(one.sample) == 4501
    rows = [(1, "eng", 0, "123", None), (1, "heb", 1, "456", None), (2, "eng", 0, None, "e"), (2, "heb", 1, None, "e"), (3, "eng", 0, "ab", None), (3, "heb", 1, "אבג", None), (4, "eng", 0, " \n", None)]
    best = pages.best_reading(spark.createDataFrame([("a", *r) for r in rows], "sha256 string, page_no int, lang string, lang_ord int, text string, error string"), ["sha256", "page_no"])
    assert {r.page_no: (r.lang, r.text) for r in best.collect()} == {1: ("eng", "123"), 2: (None, ""), 3: ("heb", "אבג"), 4: ("eng", "")}
    assert pages.document_markdown(best).first().md == "<!-- page 1 (lang=eng) -->\n\n123\n\n<!-- page 2 (no text) -->\n\n<!-- page 3 (lang=heb) -->\n\nאבג\n\n<!-- page 4 (no text) -->"
    assert [(r.lang, r.pages) for r in pages.language_usage(best).collect()] == [("eng", 2), ("heb", 1)]


def test_cells(spark):
    df = spark.createDataFrame([("done", None), ("already_hebrew", None), ("error", "<x>"), ("odd", None), ("odd", "bad")], "status string, error string").withColumn("s", F.struct("status", "error"))
    got = [r[0] for r in df.select(report.status_pill(F.col("s"), ("done",))).collect()]
    assert [g.split('"')[1] for g in got] == ["pill ok", "pill skip", "pill err", "pill warn", "pill err"] and 'title="&lt;x&gt;"' in got[2]
    assert [r[0] for r in df.select(report.status_pill(F.col("s"), ("done", "already_hebrew"))).limit(2).collect()][1].split('"')[1] == "pill ok"
    assert df.select(report.yes_no(F.lit(None).cast("boolean"))).first()[0] == "—"
    assert df.select(report.file_link(F.lit("a b/é.md"), F.lit("<l>"), F.lit(True))).first()[0] == '<a href="a%20b/%C3%A9.md">&lt;l&gt;</a>'


def test_ranks_are_those_of_a_plain_decomposition(spark):
    """Every text of the small table, against one dense matrix and the decomposition as it is defined; ties by place."""
    import re

    import numpy as np

    def plain(sentences, top=3):
        words = [re.findall(r"\w+", s.lower()) for s in sentences]
        terms = sorted({w for ws in words for w in ws})
        a = np.array([[ws.count(t) for ws in words] for t in terms], float)
        a = a / np.maximum(a.max(0), 1) * np.log(1 + len(sentences) / (a > 0).sum(1))[:, None]
        _, s, v = np.linalg.svd(a, full_matrices=False)
        score = np.sqrt(((s[:3, None] * v[:3]) ** 2).sum(0))
        return score, sorted(sorted(range(len(score)), key=lambda i: (-round(score[i], 9), i))[:top])

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(summarize.candidates(F.col("text"), "latin").alias("found"))
    texts = [list(r.found)[:60] for r in df.collect() if r.found and len(r.found) > 3]
    assert len(texts) > 20
    for found in texts:
        score, want = plain(found)
        got = summarize.lsa_rank(found)
        if got != want:  # only where scores are as good as equal
            assert np.allclose(sorted(score[got]), sorted(score[want]), atol=1e-6), found[:2]
    tied = ["the same words are here"] * 3 + ["other things that differ"] * 3
    assert summarize.lsa_rank(tied) == plain(tied)[1] == [0, 1, 2]
