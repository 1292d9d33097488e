"""Markdown as blocks: parsing, kinds, segments of lines, structural tests, image references."""

from __future__ import annotations

import re
import urllib.parse

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.text import SPACE, for_langid, is_blank, letter_count, lines, strip

_GAP = f"\\n{SPACE}*\\n"
#: Lines of structure, which are never translated or classified.
STRUCTURE = (
    rf"^{SPACE}*!\[.*\]\(.*\){SPACE}*$",
    rf"^{SPACE}*<!--.*$",
    rf"^.*-->{SPACE}*$",
    rf"^{SPACE}*[`~]{{3,}}.*$",
    rf"^{SPACE}*\|.*\|{SPACE}*$",
    rf"^{SPACE}*[-*_]{{3,}}{SPACE}*$",
)
_HEADING = rf"^(#{{1,6}}){SPACE}+(.*?){SPACE}*#*{SPACE}*$"
_LIST = rf"^({SPACE}*)([-*+]|\d+\.){SPACE}+(.+?){SPACE}*$"
_QUOTE = rf"^({SPACE}*>+{SPACE}*)(.*)$"
_HEADING_START, _LIST_START, _QUOTE_START = rf"^#{{1,6}}{SPACE}+", rf"^{SPACE}*([-*+]|\d+\.){SPACE}+.+", rf"^{SPACE}*>+{SPACE}*"


def _like(c: Column, pattern: str) -> Column:
    return c.rlike("(?Ud)" + pattern)


def is_structure(line: Column) -> Column:
    return _like(line, "|".join(f"(?:{p})" for p in STRUCTURE))


def any_structure(block: Column) -> Column:
    """Whether any line is structure: such blocks are kept whatever their language."""
    return F.exists(lines(block), is_structure)


def is_passthrough(block: Column) -> Column:
    """Whether every line that isn't blank is structure; so is a block without such lines."""
    return F.forall(F.filter(lines(block), lambda x: ~is_blank(x)), is_structure)


def block_kind(block: Column) -> Column:
    first = F.get(F.filter(lines(block), lambda x: ~is_blank(x)), 0)
    return (
        F.when(is_blank(block) | is_passthrough(block), "passthrough")
        .when(_like(first, _HEADING_START), "heading")
        .when(_like(first, _LIST_START), "list")
        .when(_like(first, _QUOTE_START), "blockquote")
        .otherwise("prose")
    )


def pieces(md: Column) -> Column:
    """The text cut at blank lines, gaps kept in place; joined they are the text."""
    gap = f"(?U)({_GAP})"
    bodies, gaps = F.split(md, f"(?U){_GAP}", -1), F.regexp_extract_all(md, F.lit(gap), F.lit(1))
    return F.filter(F.flatten(F.transform(bodies, lambda b, i: F.array(b, F.coalesce(F.get(gaps, i), F.lit(""))))), lambda p: p != "")


def parse_blocks(df: DataFrame, md: str = "md") -> DataFrame:
    """One row per piece: the other columns, block_idx from 1 (gaps count), kind and text."""
    others = [c for c in df.columns if c not in (md, "block_idx", "kind", "text")]
    out = df.select(*others, F.posexplode(pieces(F.col(md))).alias("_i", "text"))
    return out.select(*others, (F.col("_i") + 1).alias("block_idx"), block_kind(F.col("text")).alias("kind"), "text")


def segments(blocks: DataFrame) -> DataFrame:
    """One row per translatable unit: prefix, text and whether it is translated. Prose is one unit; headings, lists and
    quotes go line by line, and lines that don't match their kind stay as they are."""
    others = [c for c in blocks.columns if c not in ("kind", "text", "line_no", "prefix", "translatable")]
    by_line = F.col("kind").isin("heading", "list", "blockquote")
    line = F.explode(F.transform(F.when(by_line, lines(F.col("text"))).otherwise(F.array("text")), lambda x, i: F.struct(i.alias("n"), x.alias("s"))))
    df = blocks.withColumn("_l", line).select(*others, "kind", (F.col("_l.n") + 1).alias("line_no"), F.col("_l.s").alias("s"))
    part = lambda p, i: F.regexp_extract("s", "(?Ud)" + p, i)
    prefix, text, hit = F.lit(""), F.col("s"), F.col("kind") == "prose"
    for kind, pattern, pre, body in (
        ("heading", _HEADING, F.concat(part(_HEADING, 1), F.lit(" ")), part(_HEADING, 2)),
        ("list", _LIST, F.concat(part(_LIST, 1), part(_LIST, 2), F.lit(" ")), part(_LIST, 3)),
        ("blockquote", _QUOTE, part(_QUOTE, 1), part(_QUOTE, 2)),
    ):
        own = (F.col("kind") == kind) & _like(F.col("s"), pattern)
        prefix, text, hit = F.when(own, pre).otherwise(prefix), F.when(own, body).otherwise(text), hit | own
    return df.select(*others, "kind", "line_no", prefix.alias("prefix"), text.alias("text"), hit.alias("translatable"))


def assemble_blocks(segs: DataFrame, keys: list[str], translated: str = "translated") -> DataFrame:
    """Blocks from segments: prefix and translation by line, lines joined by breaks. Prose keeps no outer white space."""
    body = F.when(F.col("translatable"), F.concat("prefix", strip(F.col(translated)))).otherwise(F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", body.alias("s"))))
    return segs.groupBy(*keys, "block_idx").agg(F.array_join(F.transform(ordered, lambda x: x["s"]), "\n").alias("text"))


def assemble_documents(blocks: DataFrame, keys: list[str]) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("block_idx", "text")))
    return blocks.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("md"))


def filter_foreign(df: DataFrame, doc_lang: str, detect, md: str = "md") -> DataFrame:
    """Drops paragraphs of another language than the document's; adds the number dropped. A paragraph stays if it
    is blank, has a line of structure, has few letters, or its language is the document's or unknown. detect is a
    function of a Column."""
    blocks = F.split(F.col(md), f"(?U){_GAP}", -1)

    def keep(b: Column) -> Column:
        plain = for_langid(b)
        lang = detect(plain)
        return is_blank(b) | any_structure(b) | (letter_count(plain) <= fixed.FOREIGN_LETTERS) | lang.isNull() | (lang == F.col(doc_lang))

    kept = F.when(F.col(doc_lang).isNull(), blocks).otherwise(F.filter(blocks, keep))
    out = df.withColumn("_kept", kept).withColumn("dropped", (F.size(blocks) - F.size("_kept")).cast("long"))
    return out.withColumn(md, F.when(F.col("dropped") > 0, F.array_join("_kept", "\n\n")).otherwise(F.col(md))).drop("_kept")


_IMAGE = re.compile(r"!\[([^\]]*)\]\(([^)]+)\)")
_URL_SAFE = "/:#?&="


def rewrite_images(md: str, prefix: str) -> str:
    """Image targets as seen from a sibling folder: relative ones get the prefix, all but remote ones are encoded."""
    encoded = urllib.parse.quote(prefix, safe=_URL_SAFE)

    def one(m: re.Match) -> str:
        target = m[2].strip()
        if target.startswith(("http://", "https://", "mailto:", "data:")):
            return m[0]
        if target.startswith((prefix, encoded)):
            target = urllib.parse.unquote(target)
        elif not target.startswith("/"):
            target = prefix + target.removeprefix("./")
        return f"![{m[1]}]({urllib.parse.quote(target, safe=_URL_SAFE)})"

    return _IMAGE.sub(one, md)


@F.pandas_udf(T.StringType())
def _rewrite_udf(md: pd.Series, prefix: pd.Series) -> pd.Series:
    return pd.Series([None if a is None else rewrite_images(a, b) for a, b in zip(md, prefix)])


def with_images_rewritten(df: DataFrame, base: str, md: str = "md", source_dir: str = "step1_md") -> DataFrame:
    """md with image references pointing back to the source folder; changed says whether any did. Only rows that
    hold an image reach Python."""
    prefix = F.concat(F.lit(f"../../{source_dir}/"), F.col(base), F.lit("/"))
    has = F.col(md).contains("](")
    new = F.when(has, _rewrite_udf(F.when(has, F.col(md)), prefix)).otherwise(F.col(md))
    return df.withColumn("_new", new).withColumn("changed", ~F.col("_new").eqNullSafe(F.col(md))).withColumn(md, F.col("_new")).drop("_new")
