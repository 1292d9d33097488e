import uuid

import pytest
from pyspark.sql import functions as F

from docflow.operators import langmodel

SAMPLES = {
    "en": "The history of the town and of the people that lived in it is as old as the river which runs through the valley and down to the sea",
    "de": "Die Geschichte der Stadt und der Menschen die in ihr wohnten ist so alt wie der Fluss der durch das Tal und hinunter zum Meer fließt",
    "fr": "L'histoire de la ville et des gens qui y habitaient est aussi vieille que la rivière qui coule dans la vallée jusqu'à la mer",
    "es": "La historia de la ciudad y de la gente que vivía en ella es tan antigua como el río que corre por el valle hasta el mar",
    "it": "La storia della città e della gente che vi abitava è antica come il fiume che scorre nella valle fino al mare",
    "la": "Historia urbis et hominum qui in ea habitabant tam vetus est quam flumen quod per vallem usque ad mare currit",
    "he": "המאמר הזה עוסק בתולדות היישוב בארץ ישראל והוא מבוסס על מקורות רבים של החוקרים שלא הכירו זה את זה",
    "yi": "איך בין געגאנגען אין שטאט און דער טאטע איז געווען מיט די קינדער פון דעם הויז אויף דער גאס",
    "ar": "هذا النص مكتوب باللغة العربية وهو طويل بما يكفي لكي يتم التعرف عليه في كل مكان",
}


@pytest.fixture
def store(spark, tmp_path):
    def run(df):
        path = f"{tmp_path}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return run


def test_grams(spark):
    row, gram = langmodel.gram_numbers(["ab c", "é😀", ""])
    text = lambda g: "".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0) if g >> s)
    cut = lambda t: sorted(t[i : i + k] for k in (1, 2, 3) for i in range(len(t) - k + 1))
    assert [sorted(text(int(g)) for r, g in zip(row, gram) if r == i) for i in range(3)] == [cut("ab c"), cut("é😀"), []]


def test_nine_languages_and_odd_texts(spark, store):
    rows = [(i, lang, t) for i, (lang, t) in enumerate(SAMPLES.items())] + [(90, None, "no label"), (91, "en", None), (92, "en", "")]
    model = langmodel.trained(spark.createDataFrame(rows, "id long, lang string, text string"), store)
    tests = {"the old people of the river": "en", "der alte Mensch und die Stadt": "de", "la vieille rivière de la ville": "fr", "la gente antigua del río": "es", "la gente della città antica": "it", "vetus flumen urbis et hominum": "la", "על מקורות רבים של הארץ": "he", "די קינדער פון דער שטאט": "yi", "النص العربية مكان": "ar", "": "-", "  ": "-"}
    texts = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(tests)] + [(99, None, "clash")], "id long, text string, gram string")
    got = {r.id: r for r in model.scores(texts, ["id"]).groupBy("id").agg(F.min_by("lang", F.struct(-F.col("score"), "lang")).alias("lang")).collect()}
    assert {i: got[i].lang for i in got} == {i: lang for i, lang in enumerate(tests.values()) if lang != "-"}
    assert {r.id for r in model.classified(texts, ["id"]).collect()} == set(got)


def test_text_of_no_language_is_rejected(spark, store):
    rows = [(i * 10 + k, lang, " ".join(t.split()[k : k + 12])) for i, (lang, t) in enumerate(SAMPLES.items()) for k in range(8)]
    model = langmodel.trained(spark.createDataFrame(rows, "id long, lang string, text string"), store)
    texts = spark.createDataFrame([(1, "zzqx 8841 xkcd //// 77 wvw qqq zx" * 3), (2, " ".join(SAMPLES["fr"].split()[2:17]))], "id long, text string")
    assert {r.id: r.lang for r in model.classified(texts, ["id"]).collect()} == {1: None, 2: "fr"}


def test_no_training_rows(spark, store):
    model = langmodel.trained(spark.createDataFrame([], "id long, lang string, text string"), store)
    assert model.classified(spark.createDataFrame([(1, "text")], "id long, text string"), ["id"]).count() == 0


def test_held_out_lines(spark, store):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langmodel.trained(docs.filter("doc_id % 4 <> 2").select(F.col("doc_id").alias("id"), "lang", "text"), store)
    lines = docs.filter("doc_id % 4 = 2").select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("line", "text")).filter(F.length("text").between(80, 400))
    got = model.classified(lines.select("doc_id", "line", "text"), ["doc_id", "line"]).withColumnRenamed("lang", "told").join(lines.select("doc_id", "line", "lang"), ["doc_id", "line"])
    n, right = got.agg(F.count(F.lit(1)), F.count_if(F.col("told") == F.col("lang"))).first()
    print(n, right)
    assert n > 50 and right / n > 0.9
