import duckdb
import pytest

from docflow.functions import fixed, langid, text
from docflow.plans.catalog import ORACLE_SQL
from pyspark.sql import functions as F

HEBREW = "המאמר הזה עוסק בתולדות היישוב בארץ ישראל והוא מבוסס על מקורות רבים של החוקרים"
ROWS = {
    HEBREW: "he",
    "שלום רב ולהתראות " * 4: "he",
    HEBREW + " and a few words of it": "he",
    "איך בין געגאנגען אין שטאט און דער טאטע איז געווען מיט די קינדער פון דעם הויז": "yi",
    "هذا النص مكتوب باللغة العربية وهو طويل بما يكفي لكي يتم التعرف عليه": "ar",
    "The history of the town and the people that lived in it is as old as this": "en",
    "Il libro che non ho letto della storia di questo paese è nel cassetto con gli altri": "it",
    "Gallia est omnis divisa in partes tres quarum unam incolunt Belgae et aliam qui non sunt sed cum": "la",
    "Der Mann ist nicht mit dem Zug von der Stadt auf das Land gefahren": "de",
    "La maison est dans une rue qui est pour les enfants et pas pour elle": "fr",
    "El hombre que vino del pueblo con su familia por la tarde como los otros": "es",
    "The name of the site is " + "תל אביב" + " and it is in the north of the land": "en",
    "xyzzy qwrtz " * 6: None,
    "too short": None,
    "": None,
    " \n" * 9000 + "The end of the text is here and it is of the same kind": "en",
    "12345 67890 " * 10: None,
}


def test_scripts_and_words(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*ROWS, None])], "doc_id long, text string")
    got = {r.doc_id: r.lang for r in df.select("doc_id", langid.detect(F.col("text")).alias("lang")).collect()}
    for i, (t, lang) in enumerate(ROWS.items()):
        assert got[i] == lang, t[:60]
    assert got[len(ROWS)] is None


def test_the_query_s_sql_says_the_same(spark):
    """The tables hold no Hebrew or Arabic text; here the SQL is held against the functions on texts that do."""
    rows = [(i, t) for i, t in enumerate(ROWS)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = sorted(con.sql(ORACLE_SQL["detect_language"]).fetchall())
    assert sorted((r.doc_id, r.lang) for r in df.select("doc_id", langid.detect(F.col("text")).alias("lang")).collect()) == want


@pytest.mark.parametrize("mark", [m for m in fixed.BOILERPLATE if not m.isascii()])
def test_hebrew_marks_of_boilerplate(spark, mark):
    rows = [(f"line one\nלפני {mark} אחרי\n{mark.upper()}\nend", 2), ("line one\nשורה רגילה", 0)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    n = F.size(F.filter(F.split("text", "\n"), lambda s: text.contains_any(s, fixed.BOILERPLATE)))
    assert [r.n for r in df.orderBy("doc_id").select(n.alias("n")).collect()] == [n for _, n in rows]
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert [n for _, n in sorted(con.sql(ORACLE_SQL["boilerplate_hits"]).fetchall())] == [n for _, n in rows]
