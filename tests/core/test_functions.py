import html
import random
import re
import urllib.parse

from pyspark.sql import functions as F

from docflow.functions import text
from docflow.functions.langid import detect


def apply(spark, f, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r.o for r in df.select("i", f(F.col("s")).alias("o")).orderBy("i").collect()]


ODD = ["", " ", "a", "\x1c a\x85", " x y z\n", "a\r\nb\rc\n", "\n", "a\n\n", "😀 b­", "x\x0by\x0cz\x1d", "é\tñ  "]


def test_white_space_and_lines_are_pythons(spark):
    assert apply(spark, text.strip, ODD) == [s.strip() for s in ODD]
    assert apply(spark, text.flat, ODD) == [re.sub(r"\s+", " ", s).strip() for s in ODD]
    assert apply(spark, text.lines, ODD) == [s.splitlines() for s in ODD]
    assert apply(spark, text.is_blank, ODD) == [not s.strip() for s in ODD]


def test_urls_and_html_are_pythons(spark):
    rng = random.Random(1)
    values = ["", "a b(1)/x,é~*", "100%", "a+b&c=d?#", "%zz%41", *("".join(rng.choice("aZ0 +%&é/~*'\"<>😀") for _ in range(12)) for _ in range(20))]
    assert apply(spark, text.url_quote, values) == [urllib.parse.quote(v) for v in values]
    assert apply(spark, lambda c: text.url_quote(c, "/:#?&="), values) == [urllib.parse.quote(v, safe="/:#?&=") for v in values]
    assert apply(spark, text.html_escape, values) == [html.escape(v) for v in values]
    good = [urllib.parse.quote(v) for v in values] + ["a+b", "50%"]
    assert apply(spark, text.url_unquote, good) == [urllib.parse.unquote(v) for v in good]


def test_names_and_paths(spark):
    assert apply(spark, text.safe_name, ["a:b?.pdf", " .pdf", "x. .pdf", ".pdf", "a.b.pdf", "dir/é <1>.PDF", "plain", ""]) == ["a_b_", "document", "x", "pdf", "a.b", "é _1_", "plain", "document"]
    assert apply(spark, lambda c: text.relative_to(c, "/r/"), ["/r/a/b", "/q/a", "\\r\\a"]) == ["a/b", "/q/a", "a"]
    assert apply(spark, text.last_segment, ["https://h/f/ID_1?x=1", "h/f/ID/", "one"]) == ["ID_1", "ID", "one"]
    names = ["b.PDF", "a1.pdf", "src_x.pdf", "srcYx.pdf"]
    assert apply(spark, lambda c: text.glob(c, "*[!0-9].pdf"), names) == [False, False, True, True]
    assert apply(spark, lambda c: text.glob(c, "src?x.*"), names) == [False, False, True, True]


def test_counts_and_scores(spark):
    assert apply(spark, lambda c: text.expected_chars(c, F.lit("eng+heb")), ["ab שלום 1", "", None]) == [6, 0, 0]
    assert apply(spark, lambda c: text.expected_chars(c, F.lit("xxx")), ["ab"]) == [0]
    assert apply(spark, text.letter_count, ["aЖαش1 é"]) == [4]
    assert apply(spark, text.letters_only, ["a-b_ 1é!"]) == ["ab1é"]
    assert apply(spark, text.without_soft_hyphens, ["co­op"]) == ["coop"]
    assert apply(spark, text.for_langid, ["## **A** `b`\n- c\n  2. d"]) == ["A b c d"]


def test_error_pages_and_rate_limits(spark):
    pages = ["Error 500 (Server", "That's an error", "Thats an error", "That’s an error", "Please try again later", "x" * 400 + "<html", None, ""]
    assert apply(spark, text.is_error_page, pages) == [True, False, True, True, True, False, False, False]
    assert apply(spark, text.is_rate_limit, ["429 too many REQUESTS", "bad", None]) == [True, False, False]


def test_language(spark):
    long = " and the cat sat on the mat of the house that was by the sea"
    assert apply(spark, detect, [long, "the", None, "zzz " * 20, "el gato y los perros que viven con la casa de una mujer por las noches"]) == ["en", None, None, None, "es"]


def test_pages_are_escaped_whole(spark):
    import duckdb

    from docflow.plans.catalog import ORACLE_SQL, QUERIES

    d = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = {r.page_id: r.escaped for r in QUERIES["names_and_escapes"](spark, d).collect()}
    assert max(map(len, pages.values())) > 300 and got == {i: html.escape(h) for i, h in pages.items()}
    sql = ORACLE_SQL["names_and_escapes"].replace("FROM pages", f"FROM '{d}/pages.parquet'")
    assert got == {r[0]: r[3] for r in duckdb.sql(sql).select("page_id, n, href, escaped, segment").fetchall()}
