"""Extractive summaries: cleaning of Markdown, sentences, candidates, latent semantic ranking, freshness and outcomes."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.text import SPACE, contains_any, digit_share, flat, lines, script_count, strip, without_soft_hyphens

_QUOTES = "\"'"


def strip_markdown(md: Column) -> Column:
    """Plain text of Markdown: no comments, code, images, link targets, tags, URLs, tables, rules, marks or boilerplate lines."""
    c = without_soft_hyphens(md)
    for pattern, by in (
        ("(?s)<!--.*?-->", " "),
        ("(?s)```.*?```", " "),
        (r"!\[[^\]]*\]\([^)]*\)", " "),
        (r"\[([^\]]+)\]\([^)]*\)", "$1"),
        ("<[^>]+>", " "),
        (r"(?U)https?://[^\s\x1c-\x1f]+", " "),
    ):
        c = F.regexp_replace(c, pattern, by)
    raw = F.transform(lines(c), lambda s: strip(s))
    dropped = rf"(?Ud)^{SPACE}*\|.*\|{SPACE}*$|^\||^---|^===|^\*\*\*|^___"
    kept = F.filter(raw, lambda s: ~s.rlike(dropped))

    def bare(s: Column) -> Column:
        for pattern in (rf"^{SPACE}*#{{1,6}}{SPACE}+", rf"^[*\-+>]{SPACE}+", rf"^\d+\.{SPACE}+", "[`*_]+"):
            s = F.regexp_replace(s, "(?U)" + pattern, "")
        return strip(s)

    kept = F.transform(kept, bare)
    year = rf"(?U)^{SPACE}*\(?\d{{4}}\)?[\s\x1c-\x1f.,;:]*$"
    kept = F.filter(kept, lambda s: (s == "") | ~(s.rlike(year) | contains_any(s, fixed.BOILERPLATE)))
    return strip(F.regexp_replace(F.array_join(kept, "\n"), "\n{3,}", "\n\n"))


def split_sentences(text: Column, starts: str = fixed.SCRIPTS["hebrew"]) -> Column:
    """Sentences of each paragraph, flattened: cut after . ! ? where a letter of the script, a quote or A-Z follows."""
    paragraphs = F.filter(F.transform(F.split(text, "\n\n"), lambda p: flat(p)), lambda p: p != "")
    border = f"(?U)(?<=[.!?]){SPACE}+(?=[{starts.strip('[]')}{_QUOTES}A-Z])"
    parts = F.flatten(F.transform(paragraphs, lambda p: F.split(p, border, -1)))
    return F.filter(F.transform(parts, lambda s: strip(s)), lambda s: s != "")


def is_candidate(s: Column, script: str = "hebrew") -> Column:
    n = F.length(s)
    own = script_count(s, script)
    return (n >= fixed.SENTENCE_LEAST) & (n <= fixed.SENTENCE_MOST) & (own >= fixed.SCRIPT_LEAST) & (own / n >= fixed.SCRIPT_SHARE) & (digit_share(s) <= fixed.DIGIT_SHARE) & ~contains_any(s, fixed.BOILERPLATE)


def candidates(md: Column, script: str = "hebrew") -> Column:
    return F.filter(split_sentences(strip_markdown(md), fixed.SCRIPTS[script]), lambda s: is_candidate(s, script))


_CUT = re.compile(r"(?<=[.!?])\s+")


def lsa_rank(sentences: list[str], top: int = fixed.SUMMARY_SENTENCES) -> list[int]:
    """Places of the top sentences by sqrt(sum of squared singular values times squared components), in text order.
    Terms are weighted by frequency and rarity; ties go to the earlier sentence."""
    if len(sentences) <= top:
        return list(range(len(sentences)))
    words = [re.findall(r"\w+", s.lower()) for s in sentences]
    terms = {t: i for i, t in enumerate(sorted({w for ws in words for w in ws}))}
    if not terms:
        return list(range(top))
    a = np.zeros((len(terms), len(sentences)))
    for j, ws in enumerate(words):
        for w in ws:
            a[terms[w], j] += 1
    a = a / np.maximum(a.max(0), 1) * np.log(1 + len(sentences) / (a > 0).sum(1))[:, None]
    gram = a.T @ a if len(terms) > len(sentences) else None
    if gram is not None:
        values, vectors = np.linalg.eigh(gram)
        squares, v = np.maximum(values[::-1], 0), vectors[:, ::-1].T
    else:
        _, s, v = np.linalg.svd(a, full_matrices=False)
        squares = s**2
    rank = min(len(squares), max(top, 3))
    score = np.round(np.sqrt((squares[:rank, None] * v[:rank] ** 2).sum(0)), 9)
    return sorted(np.lexsort((np.arange(len(score)), -score))[:top].tolist())


def pick(found: list[str], top: int = fixed.SUMMARY_SENTENCES) -> str:
    """The summary of candidate sentences: the ranked ones without repeats; the first ones if that is too short."""
    if not found:
        return ""
    text = " ".join(found)[: fixed.SUMMARY_INPUT_CHARS]
    parts = [p for p in _CUT.split(text) if p.strip()]
    chosen = [parts[i] for i in lsa_rank(parts, top)]
    ordered = list(dict.fromkeys(re.sub(r"\s+", " ", s).strip() for s in chosen))
    summary = " ".join(s for s in ordered if s)
    return summary if len(summary) >= fixed.SUMMARY_LEAST_CHARS else " ".join(found[:top]).strip()


@F.pandas_udf(T.StringType())
def lsa_summary(found: pd.Series) -> pd.Series:
    return pd.Series([None if f is None else pick(list(f)) for f in found])


def lead_summary(found: Column, top: int = fixed.SUMMARY_SENTENCES) -> Column:
    """The first candidates, without repeats, joined by blanks."""
    return F.array_join(F.array_distinct(F.slice(found, 1, top)), " ")


def source_of(step1: Column, translation: Column) -> Column:
    """Where a summary is read from: the translation, or the original that is in the target language already."""
    return F.when((translation["status"] == "done") & translation["translated_md_relpath"].isNotNull(), F.struct(translation["translated_md_relpath"].alias("relpath"), F.lit("translated_md").alias("kind"))).when(
        (translation["status"] == "already_hebrew") & step1["md_relpath"].isNotNull(), F.struct(step1["md_relpath"].alias("relpath"), F.lit("step1_md_hebrew").alias("kind"))
    )


def is_fresh(cached: Column, source: Column, fingerprint: Column) -> Column:
    """Whether a cached summary is of this source as it is now."""
    same = cached["source_relpath"].eqNullSafe(source["relpath"]) & cached["source_kind"].eqNullSafe(source["kind"])
    as_is = cached["source_fingerprint"]["size"].eqNullSafe(fingerprint["size"]) & cached["source_fingerprint"]["mtime"].eqNullSafe(fingerprint["mtime"])
    return cached.isNotNull() & same & as_is & (F.length(F.coalesce(strip(cached["text"]), F.lit(""))) > 0)


def outcome(source: Column, fingerprint: Column, fresh: Column, text: Column) -> Column:
    """skipped without a source or its file, cached if fresh, empty if nothing is left, else summarized."""
    return F.when(source.isNull() | fingerprint.isNull(), "skipped").when(fresh, "cached").when(F.length(F.coalesce(text, F.lit(""))) == 0, "empty").otherwise("summarized")


def stale(registry: DataFrame, files: DataFrame, force: bool = False) -> DataFrame:
    """(sha256, path) of the sources that have to be read: by the listing alone, files (path, size, mtime)."""
    f = files.select("path", F.struct(F.col("size").cast("long").alias("size"), F.col("mtime").cast("long").alias("mtime")).alias("_print"))
    df = registry.withColumn("_src", source_of(F.col("step1"), F.col("translation_md"))).join(f, F.col("_src.relpath") == F.col("path"))
    return (df if force else df.filter(~is_fresh(F.col("summary"), F.col("_src"), F.col("_print")))).select("sha256", "path")


def summarize(registry: DataFrame, files: DataFrame, at: Column, script: str = "hebrew", force: bool = False) -> DataFrame:
    """registry with summary brought up to date and outcome. files has (path, text, size, mtime) of the sources; only
    documents that aren't fresh are read further."""
    src = source_of(F.col("step1"), F.col("translation_md"))
    print_of = F.when(F.col("_path").isNotNull(), F.struct(F.col("_size").alias("size"), F.col("_mtime").alias("mtime")))
    f = files.select(F.col("path").alias("_path"), F.col("text").alias("_text"), F.col("size").cast("long").alias("_size"), F.col("mtime").cast("long").alias("_mtime"))
    df = registry.withColumn("_src", src).join(f, F.col("_src.relpath") == F.col("_path"), "left").withColumn("_print", print_of)
    df = df.withColumn("_fresh", F.lit(not force) & is_fresh(F.col("summary"), F.col("_src"), F.col("_print")))
    df = df.withColumn("_new", lsa_summary(F.when(~F.col("_fresh") & F.col("_path").isNotNull(), candidates(F.col("_text"), script))))
    df = df.withColumn("outcome", outcome(F.col("_src"), F.col("_print"), F.col("_fresh"), F.col("_new")))
    entry = F.struct(F.col("_new").alias("text"), F.col("_src.relpath").alias("source_relpath"), F.col("_src.kind").alias("source_kind"), F.col("_print").alias("source_fingerprint"), F.lit("lsa").alias("method"), F.lit(fixed.SUMMARY_SENTENCES).alias("sentences"), at.alias("at"))
    return df.withColumn("summary", F.when(F.col("outcome") == "summarized", entry).otherwise(F.col("summary"))).select(*registry.columns, "outcome")


def outcome_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
