"""Translation of blocks through an engine: cache, engine stage, checkpoints, assembly, document outcomes.

The engine runs once per distinct text that the cache lacks: its results are written before anything reads them twice.
The cache is keyed by the hash of the text (not of the document), so copies and re-runs cost nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..engines import TRANSLATORS, Paced, Retrying, find, translate_or_split
from ..functions import fixed
from ..functions.text import sha256, timestamp_text
from .blocks import assemble_blocks, assemble_documents, parse_blocks, segments, with_images_rewritten
from .lookup import narrowed

RESULTS = "src_sha string, text string, error string"
SLICE_TEXTS, MOST_SLICES = 5000, 64


def run_engine(texts: DataFrame, engine: str | Callable, slots: int = 8, limit: int = fixed.CHUNK_CHARS, tries: int = fixed.LEAST_TRIES, backoff: float = 2.0, sleep: Callable[[float], None] | None = None, rate: float | None = None, pause: str = "") -> DataFrame:
    """(src_sha, text, error) of texts (src_sha, source). slots bounds how many engines run at a time, rate (calls a second) how often
    they are called by all slots together; a rate limit that one of them meets is noted in the shared folder pause, and all wait."""
    make = find(TRANSLATORS, engine) if isinstance(engine, str) else engine

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine_ = make()
        if rate:
            engine_ = Paced(engine_, rate, slots, TaskContext.get().partitionId() % slots, pause)
        translate = Retrying(engine_, tries, backoff, **({"sleep": sleep} if sleep else {}))
        for batch in batches:
            out, errors = [], []
            for text in batch["source"]:
                try:
                    out.append(translate_or_split(text or "", translate, limit))
                    errors.append(None)
                except Exception as e:
                    out.append(None)
                    errors.append(str(e)[:500])
            yield pd.DataFrame({"src_sha": batch["src_sha"], "text": out, "error": errors})

    return texts.select("src_sha", "source").repartition(slots, "src_sha").mapInPandas(run, RESULTS)


def missing(segs: DataFrame, cache: DataFrame) -> DataFrame:
    """(src_sha, source): the distinct translatable texts that the cache lacks."""
    due = segs.filter("translatable").select(sha256(F.col("text")).alias("src_sha"), F.col("text").alias("source"))
    return due.groupBy("src_sha").agg(F.first("source").alias("source")).join(cache.select("src_sha"), "src_sha", "left_anti")


def with_cache(segs: DataFrame, cache: DataFrame) -> DataFrame:
    """segs with translated and error from the cache (src_sha, text, error)."""
    found = cache.select("src_sha", F.col("text").alias("translated"), "error")
    return segs.withColumn("src_sha", F.when(F.col("translatable"), sha256(F.col("text")))).join(found, "src_sha", "left").drop("src_sha")


def checkpoint_numbers(blocks: DataFrame, key: str, every: int = fixed.CHECKPOINT_BLOCKS) -> DataFrame:
    """blocks with nth, the running number of translated blocks, and checkpoint, true after each every-th."""
    w = Window.partitionBy(key).orderBy("block_idx").rowsBetween(Window.unboundedPreceding, 0)
    due = F.col("kind") != "passthrough"
    nth = F.sum(due.cast("int")).over(w)
    return blocks.withColumn("nth", nth).withColumn("checkpoint", due & (F.col("nth") % every == 0))


def block_totals(blocks: DataFrame, key: str) -> DataFrame:
    return blocks.groupBy(key).agg(F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("kind") != "passthrough").alias("translated_blocks"))


def header(name: Column, engine: str, at: Column, source: Column) -> Column:
    stamp = timestamp_text(at) if not isinstance(at, str) else F.lit(at)
    return F.concat(F.lit("<!-- Translated automatically from "), name, F.lit(f" via {engine} on "), stamp, F.lit(". Source: "), source, F.lit(" -->\n\n"))


def in_slices(texts: DataFrame, engine: str | Callable, store: Callable[[DataFrame], DataFrame], flush: Callable[[DataFrame], None] | None, slice_texts: int = SLICE_TEXTS, **options) -> DataFrame:
    """run_engine over slices of the texts, by their hash; each slice's good results go to flush as soon as it has ended, so that
    a run that is lost pays again for one slice at most. Slices hold about slice_texts texts, or a MOST_SLICES-th of them."""
    texts = store(texts)
    n = texts.count()
    slices = max(1, min(MOST_SLICES, -(-n // slice_texts))) if flush else 1
    out = None
    for i in range(slices):
        part = store(run_engine(texts.filter(F.pmod(F.xxhash64("src_sha"), F.lit(slices)) == i) if slices > 1 else texts, engine, **options))
        if flush:
            flush(part.filter("error is null").select("src_sha", "text"))
        out = part if out is None else out.unionByName(part)
    return out


def translate_markdown(docs: DataFrame, cache: DataFrame, engine: str | Callable, store: Callable[[DataFrame], DataFrame], key: str = "sha256", base: str | None = None, flush: Callable[[DataFrame], None] | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Documents (key, md) through the engine. store writes a table and reads it again (a lasting folder makes the run resumable);
    flush takes new cache rows while the run goes on.

    Returns (documents, new cache rows): documents have md, the translation, null where a text failed; error, the first failure;
    blocks_done, the number of blocks that succeeded; and translated_ratio, the share of characters that were sent."""
    blocks = parse_blocks(docs.select(key, "md"))
    segs = store(segments(blocks))
    due = store(segs.filter("translatable").select(sha256(F.col("text")).alias("src_sha")).distinct())
    cache = store(narrowed(cache, due, "src_sha").dropDuplicates(["src_sha"]))  # what is left is about as large as what is due
    new = in_slices(missing(segs, cache), engine, store, flush, **options)
    known = cache.select("src_sha", "text", F.lit(None).cast("string").alias("error")).unionByName(new)
    done = with_cache(segs, known)
    failed = done.filter("error is not null").groupBy(key).agg(F.min_by("error", F.struct("block_idx", "line_no")).alias("error"), F.count_distinct("block_idx").alias("_bad"))
    built = assemble_documents(assemble_blocks(done.withColumn("translated", F.coalesce("translated", F.lit(""))), [key]), [key])
    sent = F.sum(F.when(F.col("translatable"), F.length("text")).otherwise(0))
    counts = done.groupBy(key).agg(F.count_distinct(F.when(F.col("kind") != "passthrough", F.col("block_idx"))).alias("_n"), F.round(sent / F.greatest(F.sum(F.length("text")), F.lit(1)), 4).alias("translated_ratio"))
    out = docs.select(key, *([base] if base else [])).join(built, key, "left").join(failed, key, "left").join(counts, key, "left")
    out = out.withColumn("md", F.when(F.col("error").isNull(), F.coalesce("md", F.lit(""))))
    if base:
        out = with_images_rewritten(out, base).drop("changed")
    return out.withColumn("blocks_done", (F.coalesce("_n", F.lit(0)) - F.coalesce("_bad", F.lit(0))).cast("int")).drop("_n", "_bad"), new.filter("error is null").select("src_sha", "text")


def partial_cache(spark: SparkSession, path: str) -> DataFrame:
    """(key, block_idx, translated) of block caches kept as JSON objects of a document's hash (src_sha) and its blocks by number."""
    text = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    raw = text.select(F.from_json("value", "src_sha string, blocks map<string, string>").alias("c")).filter("c.src_sha is not null and c.blocks is not null")
    numbered = F.map_filter("c.blocks", lambda k, v: k.rlike("^[0-9]{1,9}$"))
    return raw.select(F.col("c.src_sha").alias("key"), F.explode(F.transform_keys(numbered, lambda k, v: k.cast("int"))).alias("block_idx", "translated"))


def from_partial(partial: DataFrame, docs: DataFrame, key: str = "sha256") -> DataFrame:
    """New cache rows (src_sha, text) of translated blocks (key, block_idx, translated) of documents (key, md): the units of each
    block by those of its source, in order. A block whose lines don't match its source's, or of a document that isn't there, gives none."""
    source = parse_blocks(docs.select(key, "md")).join(partial.select(F.col("key").alias(key), "block_idx", "translated"), [key, "block_idx"])
    units = lambda blocks, name: segments(blocks).filter("translatable").select(key, "block_idx", "line_no", F.col("text").alias(name))
    own = units(source.select(key, "block_idx", "kind", "text"), "source")
    made = units(source.select(key, "block_idx", "kind", F.col("translated").alias("text")), "text")
    count = lambda rows, name: rows.groupBy(key, "block_idx").agg(F.count(F.lit(1)).alias(name))
    whole = count(own, "a").join(count(made, "b"), [key, "block_idx"]).filter("a = b").select(key, "block_idx")
    rows = own.join(whole, [key, "block_idx"], "left_semi").join(made, [key, "block_idx", "line_no"])
    return rows.groupBy(sha256(F.col("source")).alias("src_sha")).agg(F.min("text").alias("text"))


def outcome(eligible: Column, translated: Column, in_target: Column, error: Column) -> Column:
    """What a document comes to: skipped, cached, already_hebrew, error or done, in this order."""
    return F.when(~eligible, "skipped").when(translated, "cached").when(in_target, "already_hebrew").when(error.isNotNull(), "error").otherwise("done")


def translate_pages(pages: DataFrame, engine: str | Callable, store: Callable[[DataFrame], DataFrame], key: str = "sha256", limit: int = fixed.CHUNK_CHARS, **options) -> DataFrame:
    """(key, page_no, text): pages in chunks through the engine, the chunks' results joined by line breaks; a blank page is empty."""
    from .chunks import chunks

    parts = store(pages.select(key, "page_no", F.posexplode_outer(chunks(F.col("text"), limit)).alias("_i", "text")).withColumn("translatable", F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s", "")) > 0))
    empty = parts.sparkSession.createDataFrame([], RESULTS)
    found = store(run_engine(missing(parts, empty), engine, limit=limit, **options))
    done = with_cache(parts, found).filter("translatable")
    rows = F.array_sort(F.collect_list(F.struct("_i", F.coalesce("translated", F.lit("")).alias("t"))))
    text = done.groupBy(key, "page_no").agg(F.array_join(F.transform(rows, lambda x: x["t"]), "\n").alias("text"), F.max("error").alias("error"))
    return pages.select(key, "page_no").join(text, [key, "page_no"], "left").select(key, "page_no", F.coalesce("text", F.lit("")).alias("text"), "error")
