import random
import re

import pytest
from pyspark.sql import functions as F

from docflow.operators import blocks, chunks


def parsed(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, md string")
    return blocks.parse_blocks(df)


def test_pieces_round_trip_and_count_gaps(spark):
    rng = random.Random(2)
    texts = ["a\n\nb\n \nc", "", "\n\n", "x", "\n\nx\n\n\n", *("".join(rng.choice(["a", "\n", " ", "\t", "# ", "- ", "> "]) for _ in range(30)) for _ in range(25))]
    got = parsed(spark, *texts).collect()
    for i, t in enumerate(texts):
        own = sorted((r.block_idx, r.text) for r in got if r.id == i)
        want = [p for p in re.split(r"(\n\s*\n)", t) if p]
        assert [x for _, x in own] == want and [n for n, _ in own] == list(range(1, len(want) + 1))


@pytest.mark.parametrize(
    "text, kind",
    [("# h\ncontinuation", "heading"), ("- x\n  wrapped", "list"), ("**bold** text", "prose"), ("1. item", "list"), ("> q", "blockquote"), ("---", "passthrough"), ("long text <!-- End of picture text -->", "passthrough"), ("![a](b)\n| a | b |", "passthrough"), ("text\n| a | b |", "prose"), ("#no", "prose"), ("```", "passthrough")],
)
def test_kinds(spark, text, kind):
    assert parsed(spark, text).first().kind == kind


def test_any_and_all_structure_differ(spark):
    df = spark.createDataFrame([("text\n| a | b |",)], "t string")
    assert df.select(blocks.any_structure(F.col("t")), blocks.is_passthrough(F.col("t"))).first()[:] == (True, False)


def test_segments_and_assembly(spark):
    text = "## Head ##\nplain\n\n- one\n  wrapped\n  2. two  \n\n> q\n>> r\n\n  prose here\nmore \n\n| a | b |"
    segs = blocks.segments(parsed(spark, text))
    done = blocks.assemble_blocks(segs.withColumn("translated", F.upper("text")), ["id"])
    assert blocks.assemble_documents(done, ["id"]).first().md == "## HEAD\nplain\n\n- ONE\n  wrapped\n  2. TWO\n\n> Q\n>> R\n\nPROSE HERE\nMORE\n\n| a | b |"


def test_foreign_paragraphs(spark):
    en = "the cat and the dog of that house " * 6
    de = "der Hund und die Katze ist nicht mit von den " * 6
    df = spark.createDataFrame([("en", f"{en}\n\n{de}\n\n![x](y)\n{de}\n\nkurz und der"), (None, f"{en}\n\n{de}")], "lang string, md string")
    from docflow.functions.langid import detect

    got = {r.lang: (r.dropped, r.md) for r in blocks.filter_foreign(df, "lang", lambda c: detect(c, 0)).collect()}
    assert got["en"] == (1, f"{en}\n\n![x](y)\n{de}\n\nkurz und der") and got[None] == (0, f"{en}\n\n{de}")


def test_image_rewrite():
    p = "../../step1_md/doc (1)/"
    one = lambda s: blocks.rewrite_images(s, p)
    assert one("![](images/a b.png)") == "![](../../step1_md/doc%20%281%29/images/a%20b.png)"
    assert one("![x](./x.png)") == "![x](../../step1_md/doc%20%281%29/x.png)"
    assert one("![](/abs é.png)") == "![](/abs%20%C3%A9.png)" and one("![](https://h/x y.png)") == "![](https://h/x y.png)"
    assert one(one("![](images/a b.png)")) == one("![](images/a b.png)")


def test_chunks():
    assert chunks.chunk_paragraphs("aaaa\nbbbb\ncccc", 10) == ["aaaa\nbbbb", "cccc"]
    assert chunks.chunk_paragraphs("abcdefghijkl", 5) == ["abcde", "fghij", "kl"]
    assert "|" in "".join(chunks.chunk_paragraphs("ab|cd ef. gh", 8)) and "|" not in "".join(chunks.chunk_paragraphs("ab|cd ef. gh", 8, keep_pipes=False))
    assert chunks.split_halves("aaa bbb ccc ddd") == ["aaa bbb", "ccc ddd"]
    rng = random.Random(3)
    for _ in range(60):
        t = "".join(rng.choice(["ab", "c", " ", ". ", "? ", "\n", "|", "é"]) for _ in range(120))
        for limit in (5, 17, 60):
            for fold in (chunks.chunk_paragraphs, chunks.chunk_sentences):
                out = fold(t, limit)
                assert all(0 < len(c) <= limit for c in out) and re.sub(r"\s", "", "".join(out)) == re.sub(r"\s", "", t)


def test_chunks_column(spark):
    df = spark.createDataFrame([("x " * 30,), ("short",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(chunks.chunks(F.col("t"), 20)).collect()] == [chunks.chunk_paragraphs("x " * 30, 20), ["short"], [], None]
    got = spark.createDataFrame([("One. Two!  three",), ("  ",)], "t string").select(chunks.sentences(F.col("t"))).collect()
    assert [r[0] for r in got] == [["One.", "Two!", "three"], ["  "]]
