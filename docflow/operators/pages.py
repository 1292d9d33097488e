"""Pages and OCR candidates: roll-ups, the sample for language identification, the best reading of each page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import is_blank, ocr_score, strip


def page_stats(pages: DataFrame, key: str = "sha256") -> DataFrame:
    return pages.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("page_count"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("text_layer_chars"), F.coalesce(F.bool_or(F.col("n_images") > 0), F.lit(False)).alias("has_pictures"))


def langid_sample(pages: DataFrame, key: str = "sha256", most: int = fixed.LANGID_MOST) -> DataFrame:
    """(key, n_pages, sample): the first pages, up to and with the one that reaches most characters, joined by line breaks."""
    before = F.sum(F.length("text")).over(Window.partitionBy(key).orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1))
    first = pages.withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < most)
    return first.groupBy(key).agg(F.count(F.lit(1)).alias("n_pages"), ordered_concat("page_no", "text", "\n").alias("sample"))


def ordered_concat(order: str, text: str, glue: str):
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return F.array_join(F.transform(rows, lambda x: x["t"]), glue)


def per_language(pages: DataFrame, languages: list[str]) -> DataFrame:
    """A row per page and language, in the order of languages (which isn't made distinct)."""
    langs = F.array(*(F.struct(F.lit(lang).alias("lang"), F.lit(i).alias("lang_ord")) for i, lang in enumerate(languages)))
    return pages.withColumn("_l", F.explode(langs)).select(*pages.columns, "_l.lang", "_l.lang_ord")


def best_reading(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Of each page's candidates (lang, lang_ord, text, error) the one with the most characters of its scripts, then the
    longest, then the first language. Failed candidates don't count; a page without any has lang null."""
    good = F.col("error").isNull()
    score = ocr_score(F.col("text"), F.col("lang"))
    rank = F.struct(score["script_chars"].alias("s"), score["total_chars"].alias("t"), (-F.col("lang_ord")).alias("o"))
    best = F.max_by(F.when(good, F.struct("lang", "text")), F.when(good, rank))
    return candidates.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.lang").alias("lang"), strip(F.coalesce("b.text", F.lit(""))).alias("text"))


def language_usage(best: DataFrame) -> DataFrame:
    return best.filter("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("pages")).orderBy("lang")


def page_markdown(best: DataFrame) -> DataFrame:
    """best with md: the page's marker, and below it the text if there is one."""
    no = F.col("page_no").cast("string")
    some = F.col("lang").isNotNull() & ~is_blank(F.col("text"))
    marked = F.concat(F.lit("<!-- page "), no, F.lit(" (lang="), F.col("lang"), F.lit(") -->\n\n"), F.col("text"))
    return best.withColumn("md", F.when(some, marked).otherwise(F.concat(F.lit("<!-- page "), no, F.lit(" (no text) -->"))))


def document_markdown(best: DataFrame, key: str = "sha256") -> DataFrame:
    return page_markdown(best).groupBy(key).agg(ordered_concat("page_no", "md", "\n\n").alias("md"))


def docx_paragraphs(pages: DataFrame, key: str = "sha256") -> DataFrame:
    """(key, page_no, par_no, text): the paragraphs of each page, its lines without blank ones; a blank page has one null."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda s: strip(s)), lambda s: s != "")
    some = F.when(F.size(lines) > 0, lines).otherwise(F.array(F.lit(None).cast("string")))
    return pages.select(key, "page_no", F.posexplode(some).alias("_i", "text")).select(key, "page_no", (F.col("_i") + 1).alias("par_no"), "text")
