"""The document jobs end to end: files to Markdown, Markdown to translations, summaries, index. Each reads the registry,
does what is pending, and commits a new version of it at the end; a run that is lost leaves the version before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..engines import find_program
from ..functions import fixed
from ..functions.langid import detect
from ..functions.text import safe_name, stem, timestamp_text, without_comments
from ..operators import registry, report, summarize
from ..operators.blocks import filter_foreign, with_images_rewritten
from ..operators.lookup import narrowed
from ..operators.pages import best_reading, document_markdown, docx_paragraphs, langid_sample, ordered_concat, page_stats
from ..operators.translate import translate_markdown, translate_pages
from ..schema import BLOCK_CACHE, DOCX, STEP1, TRANSLATION
from ..sources import files as sources
from ..sources import ledger
from ..sources.sinks import docx_files, forget, quarantine, recover, remove_files, write_errors, write_files, write_with_outcome

TEXT_BYTES = 64 << 10  # what a Markdown file is taken to have where work is dealt out

Store = Callable[[DataFrame], DataFrame]


def _step(ddl: str, **values):
    """A struct of a step's fields; those not named are null."""
    out = []
    for part in ddl.split(", "):
        name, kind = part.split(" ", 1)
        out.append(values.get(name, F.lit(None)).cast(kind).alias(name))
    return F.struct(*out)


def extract(spark: SparkSession, config: Config, registry_path: str, store: Store, engine: str = "pdf", ocr: str = "blank", force: bool = False, only: str | None = None, limit: int | None = None) -> DataFrame:
    """Files of the source folder to Markdown files and their registry entries: text layer, or OCR where that is nearly empty."""
    log = _log(spark, registry_path)
    found, first = _found(spark, config, registry_path, store, only, (lambda fresh: sources.read_files(fresh, engine, store=store)) if limit is None else sources.hashed)
    known = store(registry.upsert(registry.load(spark, registry_path), found))
    work = registry.work_list(known.join(found.select("sha256").distinct(), "sha256", "left_semi"), registry.is_pending(F.col("step1.status"), force), limit)
    work = store(work.select("sha256", "original_name"))
    content = store(_one_each(found).join(work, "sha256", "left_semi"))  # (sha256, path, length): no content yet
    if limit is None:  # what is new has been read once, hashed and cut into pages
        now_read = first.join(content.select("path"), "path", "left_semi").select("sha256", "page_no", "text", "n_images", "error").filter("page_no is not null or error is not null")
        later = sources.readings(_contents(content.join(first.select("path").distinct(), "path", "left_anti")), engine)
        read = store(now_read.unionByName(later))
    else:
        read = store(sources.readings(_contents(content), engine))
    unread = store(read.filter("error is not null").groupBy("sha256").agg(F.min("error").alias("read_error")))
    pages = read.filter("error is null").drop("error").join(unread.select("sha256"), "sha256", "left_anti")  # of whole files
    stats = page_stats(pages)
    lang = langid_sample(pages).select("sha256", detect(F.col("sample")).alias("lang"))
    facts = store(work.join(stats, "sha256", "left").join(lang, "sha256", "left").withColumn("by_ocr", registry.needs_ocr(F.col("text_layer_chars"), config.ocr_min_chars, config.ocr_when_empty, config.force_ocr)))
    text = pages.join(facts.filter("not by_ocr").select("sha256"), "sha256", "left_semi").groupBy("sha256").agg(ordered_concat("page_no", "text", "\n\n").alias("md"))
    command, data = find_program("tesseract", config.tesseract_cmd, config.tessdata_prefix)
    seen = sources.ocr_candidates(_contents(content.join(facts.filter("by_ocr").select("sha256"), "sha256", "left_semi")), pages, config.ocr_languages(), ocr, dpi=config.ocr_dpi, command=command, data=data)
    scanned = document_markdown(best_reading(store(seen), ["sha256", "page_no"]))
    md = text.withColumn("mode", F.lit("text")).unionByName(scanned.withColumn("mode", F.lit("ocr")))
    md = facts.join(md, "sha256", "left")
    if config.drop_foreign_paragraphs:
        md = filter_foreign(md.withColumn("_lang", F.when(F.col("mode") == "text", F.col("lang"))), "_lang", lambda c: detect(c, 0)).drop("_lang")
    else:
        md = md.withColumn("dropped", F.lit(0).cast("long"))
    name = safe_name(F.col("original_name"))
    md = md.withColumns({"lang": F.when(F.col("mode") == "ocr", F.coalesce(detect(without_comments(F.col("md"))), "lang")).otherwise(F.col("lang")), "rel": F.concat(name, F.lit("/"), name, F.lit(".md"))})
    md = store(md)
    unwritten = write_errors(write_with_outcome(md.filter("md is not null"), config.step1_md_dir, log, path="rel", content="md"), "write_error")
    folder = config.settings["paths"]["step1_md_dir"]
    images_dir = F.concat(name, F.lit(f"/{config.images_subdir}"))
    if config.extract_images:  # of documents whose text layer is taken; those that are read by OCR get no pictures
        wanted = md.filter("mode = 'text' and md is not null").select("sha256", images_dir.alias("dir"))
        pictures = sources.images(_contents(content.join(wanted, "sha256", "left_semi")), engine).join(wanted, "sha256")
        written = write_with_outcome(pictures.withColumn("rel", F.concat("dir", F.lit("/"), "name")), config.step1_md_dir, log, path="rel")
        counted = written.filter("error is null").groupBy(F.col("key").alias("sha256")).agg(F.count(F.lit(1)).cast("int").alias("images"))
        md = md.join(counted, "sha256", "left").join(write_errors(written, "image_error"), "sha256", "left")
    else:
        md = md.withColumns({"images": F.lit(None).cast("int"), "image_error": F.lit(None).cast("string")})
    md = md.join(unread, "sha256", "left").join(unwritten, "sha256", "left")
    now = timestamp_text(F.current_timestamp())
    md = md.withColumn("error", F.coalesce("read_error", F.when(F.col("md").isNull(), "no page could be read"), "write_error", "image_error"))
    failed = F.col("error").isNotNull()
    images = F.coalesce("images", F.lit(0))
    step1 = _step(
        STEP1, status=F.when(failed, "error").otherwise("done"), md_relpath=F.when(~failed, F.concat(F.lit(folder + "/"), "rel")), images_dir_relpath=F.when(images > 0, F.concat(F.lit(folder + "/"), images_dir)), image_count=images, dropped_foreign_paragraphs=F.when(~failed, F.col("dropped")), mode=F.col("mode"), at=now, error=F.col("error")
    )
    done = md.select(F.col("sha256").alias("_sha"), step1.alias("_step1"), F.col("page_count").alias("_pages"), F.col("has_pictures").alias("_pics"), F.col("lang").alias("_lang"), F.col("text_layer_chars").alias("_chars"))
    values = {"step1": F.coalesce("_step1", "step1"), "page_count": F.coalesce("_pages", "page_count"), "has_pictures": F.coalesce("_pics", "has_pictures"), "source_lang": F.coalesce("_lang", "source_lang"), "text_layer_chars": F.coalesce("_chars", "text_layer_chars")}
    _commit(spark, registry_path, found, store(done), values)
    forget(spark, log)
    return registry.load(spark, registry_path)


def _found(spark: SparkSession, config: Config, registry_path: str, store: Store, only: str | None, read: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(found, first): the source folder's files (path, name, length, mtime, sha256), and what read gave of those that the ledger
    didn't have as they are, which are the only ones that are opened."""
    at = f"{registry_path}-files"
    known, fresh = ledger.split(store(sources.listed(spark, config.source_dir, only=only)), store(ledger.load(spark, at)))
    fresh = store(fresh)
    first = store(read(fresh))
    seen = store(fresh.join(first.filter("sha256 is not null").select("path", "sha256").distinct(), "path"))
    ledger.add(spark, at, seen)
    return store(known.unionByName(seen)), first


def _one_each(found: DataFrame) -> DataFrame:
    """(sha256, path, name, length): the first file of each content."""
    return found.groupBy("sha256").agg(F.min(F.struct("path", "name", "length")).alias("f")).select("sha256", "f.*")


def _contents(files: DataFrame) -> DataFrame:
    """files (sha256, path, length, ...) with their content; one that is gone meanwhile has none and is passed over."""
    return sources.with_content(files).filter("error is null").drop("error")


def _commit(spark: SparkSession, registry_path: str, found: DataFrame, results: DataFrame, values: dict[str, Column]) -> None:
    """Commits the entries of found that are new or change by results (_sha, ...), as values say, upon the registry as it is then."""

    def change(state: DataFrame) -> DataFrame:
        own = state.join(found.select("sha256").distinct(), "sha256", "left_semi").select(*state.columns)
        out = registry.upsert(own, found).join(results, F.col("sha256") == F.col("_sha"), "left").withColumns(values)
        return out.select(*state.columns).subtract(own)

    registry.update(spark, registry_path, change)


def _merge(spark: SparkSession, registry_path: str, results: DataFrame, step: str) -> None:
    """Commits a step's results (sha256, step) upon the registry as it is then."""
    own = lambda state: state.join(results.select("sha256"), "sha256", "left_semi").select(*state.columns)
    registry.update(spark, registry_path, lambda state: registry.merge_step(own(state), results, step))


def _log(spark: SparkSession, registry_path: str) -> str:
    """Where a registry's jobs keep the manifests of their writes; writes that a lost run left half done are completed first."""
    log = f"{registry_path}-writes"
    recover(spark, log)
    return log


def translate(spark: SparkSession, config: Config, registry_path: str, cache_path: str, store: Store, engine: str, force: bool = False, only: str | None = None, limit: int | None = None, **options) -> DataFrame:
    """Markdown of step 1 to translated Markdown. The block cache is appended to slice by slice, so that a later run goes on where
    this one ends or is lost."""
    log = _log(spark, registry_path)
    reg = registry.load(spark, registry_path)
    entries = registry.only(reg, only) if only else reg
    step = F.col("translation_md.status")
    due = store(registry.work_list(entries, registry.is_eligible(F.col("step1")) & ~registry.is_translated(step, force), limit).select("sha256", "original_name", "source_lang", F.col("step1.md_relpath").alias("rel")))
    here = registry.in_target_language(F.col("source_lang"), skip=config.skip_already_hebrew)
    tail = F.regexp_replace("rel", r"^.*/(?=[^/]+/[^/]+$)", "")
    docs = due.filter(~here).withColumns({"tail": tail, "path": F.concat(F.lit(f"{config.step1_md_dir}/"), tail), "length": F.lit(TEXT_BYTES)})
    docs = store(sources.with_content(docs, text=True).withColumnRenamed("content", "md").withColumn("base", F.split("tail", "/")[0]))
    gone, docs = docs.filter("error is not null"), docs.filter("error is null").drop("error", "path", "length")
    jvm = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    has = jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm)
    cache = spark.read.schema(BLOCK_CACHE).parquet(cache_path) if has else spark.createDataFrame([], BLOCK_CACHE)
    out, _ = translate_markdown(docs, cache, engine, store, base="base", flush=lambda new: new.write.mode("append").parquet(cache_path), **options)
    now = timestamp_text(F.current_timestamp())
    from ..operators.translate import header

    made = store(out.join(docs.select("sha256", "original_name", "rel", "base", "md").withColumnRenamed("md", "source").withColumnRenamed("base", "name"), "sha256").withColumn("at", now))
    good = made.filter("error is null").select("sha256", F.concat("name", F.lit("/"), "name", F.lit(".he.md")).alias("path"), F.concat(header(F.col("original_name"), engine, F.current_timestamp(), F.col("rel")), F.col("md")).alias("content"))
    unwritten = write_errors(write_with_outcome(good, config.translated_md_dir, log), "write_error")
    made = made.join(unwritten, "sha256", "left").withColumn("error", F.coalesce("error", "write_error"))
    folder = config.settings["paths"]["translated_md_dir"]
    ok = F.col("error").isNull()
    result = made.select("sha256", _step(TRANSLATION, status=F.when(ok, "done").otherwise("error"), translated_md_relpath=F.when(ok, F.concat(F.lit(folder + "/"), "name", F.lit("/"), "name", F.lit(".he.md"))), source_md_relpath=F.col("rel"), engine=F.lit(engine), target_language=F.lit(config.target_language), at=F.col("at"), error=F.col("error"), partial_blocks_done=F.when(~ok, F.col("blocks_done"))).alias("translation_md"))
    lost = gone.filter("error <> 'missing'").select("sha256", _step(TRANSLATION, status=F.lit("error"), source_md_relpath=F.col("rel"), engine=F.lit(engine), target_language=F.lit(config.target_language), at=now, error=F.concat(F.lit("not read: "), "rel", F.lit(": "), "error")).alias("translation_md"))
    skipped = due.filter(here).select("sha256", _step(TRANSLATION, status=F.lit("already_hebrew"), source_md_relpath=F.col("rel"), at=now).alias("translation_md"))
    _merge(spark, registry_path, store(result.unionByName(skipped).unionByName(lost)), "translation_md")
    forget(spark, log)
    return registry.load(spark, registry_path)


def summaries(spark: SparkSession, config: Config, registry_path: str, store: Store, script: str = "hebrew", force: bool = False, only: str | None = None, limit: int | None = None, sha: str | None = None) -> DataFrame:
    """Brings the registry's summaries up to date, of all entries or of those chosen; returns the numbers of outcomes."""
    reg = registry.load(spark, registry_path)
    chosen = registry.only(reg, only) if only else reg
    chosen = registry.with_sha_prefix(chosen, sha) if sha else chosen
    chosen = registry.work_list(chosen, F.lit(True), limit)
    chosen = store(chosen)
    files = None
    for folder in ("step1_md_dir", "translated_md_dir"):
        if _exists(spark, getattr(config, folder)):
            rel = F.concat(F.lit(config.settings["paths"][folder] + "/"), F.regexp_replace("path", r"^.*/(?=[^/]+/[^/]+$)", ""))
            part = sources.listing(spark, getattr(config, folder)).select(rel.alias("rel"), "path", F.col("size").alias("length"), "mtime")
            files = part if files is None else files.unionByName(part)
    files = store(files if files is not None else spark.createDataFrame([], "rel string, path string, length long, mtime long"))
    listed = files.select(F.col("rel").alias("path"), F.col("length").alias("size"), "mtime")
    stale = summarize.stale(chosen, listed, force).select(F.col("path").alias("rel")).distinct()
    texts = sources.with_content(files.join(stale, "rel", "left_semi"), text=True).filter("error is null").select(F.col("rel").alias("path"), F.col("content").alias("text"))
    files = listed.join(store(texts), "path", "left")
    out = store(summarize.summarize(chosen, files, timestamp_text(F.current_timestamp()), script, force))
    _merge(spark, registry_path, store(out.filter("outcome = 'summarized'").select("sha256", "summary")), "summary")
    return summarize.outcome_counts(out)


def index(spark: SparkSession, config: Config, registry_path: str) -> str:
    """The HTML index of the registry."""
    rows = report.index_rows(*_indexed(spark, config, registry_path))
    return report.page(rows, report.counters(registry.load(spark, registry_path)), _now(spark))


def _indexed(spark: SparkSession, config: Config, registry_path: str) -> tuple[DataFrame, DataFrame, str]:
    """The registry, the listing of what is there, and the source folder, as index_rows() takes them."""
    reg = registry.load(spark, registry_path)
    root = f"{config.root}/"
    parts = [sources.listing(spark, getattr(config, f)) for f in ("source_dir", "step1_md_dir", "translated_md_dir") if _exists(spark, getattr(config, f))]
    listed = parts[0]
    for p in parts[1:]:
        listed = listed.unionByName(p)
    listed = listed.select(F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), f"^{root}", "").alias("path"))
    return reg, listed, config.settings["paths"]["source_dir"]


def index_pages(spark: SparkSession, config: Config, registry_path: str, store: Store, per_page: int = report.PAGE_ROWS) -> DataFrame:
    """The HTML index in files of per_page entries, written by the tasks beside the index file; (path, bytes, sha256, error) of each. No
    row of the registry passes the driver."""
    log = _log(spark, registry_path)
    folder, _, name = config.index_file.rpartition("/")
    made = report.pages(report.index_rows(*_indexed(spark, config, registry_path)), report.counters(registry.load(spark, registry_path)), _now(spark), store, name, per_page)
    return write_with_outcome(made, folder, log, "path").drop("key")


def plain_index(spark: SparkSession, registry_path: str) -> str:
    """The smaller HTML index, of documents kept as DOCX."""
    reg = registry.load(spark, registry_path).filter("translation_docx is not null")
    return report.page(report.plain_rows(reg), None, _now(spark), report.PLAIN_COLUMNS)


def _now(spark: SparkSession) -> str:
    return spark.range(1).select(timestamp_text(F.current_timestamp())).first()[0]


def translate_docx(spark: SparkSession, config: Config, registry_path: str, store: Store, engine: str, extractor: str = "pdf", only: str | None = None, limit: int | None = None, reset_errors: bool = False, **options) -> DataFrame:
    """Files of the source folder to DOCX files of their translated pages, with the original beside them. Contents that have
    an outcome are passed over, but for errors if they are reset. A document in the target language is only copied; one
    whose pages can't be read or translated moves to the error folder."""
    log = _log(spark, registry_path)
    found, first = _found(spark, config, registry_path, store, only, lambda fresh: _hashed_contents(fresh) if limit is None else sources.hashed(fresh))
    known = store(registry.upsert(registry.load(spark, registry_path), found))
    status = F.col("translation_docx.status")
    pending = status.isNull() | (F.lit(reset_errors) & (status == "error"))
    due = registry.work_list(known.join(found.select("sha256").distinct(), "sha256", "left_semi"), pending, limit).select("sha256", "original_name")
    due = store(due)
    content = _one_each(found).join(due, "sha256", "left_semi")
    if limit is None:
        now_read = first.select("path", "content")
        content = content.join(now_read, "path").unionByName(_contents(content.join(now_read.select("path"), "path", "left_anti")), allowMissingColumns=True)
    else:
        content = _contents(content)
    content = store(content.select("sha256", "path", "name", "content"))
    read = store(sources.readings(content, extractor))
    pages = read.filter("error is null").drop("error")
    full = pages.groupBy("sha256").agg(ordered_concat("page_no", "text", "\n").alias("full")).select("sha256", detect(F.col("full")).alias("lang"))
    facts = due.join(page_stats(pages), "sha256", "left").join(full, "sha256", "left").join(read.filter("error is not null").select("sha256", F.col("error").alias("read_error")), "sha256", "left")
    facts = store(facts.withColumn("here", registry.in_target_language(F.col("lang"), skip=config.skip_already_hebrew)))
    translated = store(translate_pages(pages.join(facts.filter("not here").select("sha256"), "sha256", "left_semi"), engine, store, **options))
    failed = translated.groupBy("sha256").agg(F.max("error").alias("engine_error"))
    name, folder = safe_name(F.col("original_name")), config.settings["paths"]["translated_dir"]
    now = timestamp_text(F.current_timestamp())
    done = facts.join(failed, "sha256", "left").withColumns({"error": F.coalesce("read_error", "engine_error"), "docx": F.concat(name, F.lit("/"), stem(F.col("original_name")), F.lit(".he.docx")), "copy": F.concat(name, F.lit("/"), "original_name"), "at": now})
    done = store(done.withColumn("status", F.when(F.col("error").isNotNull(), "error").when(F.col("here"), "already_hebrew").otherwise("translated")))
    good = done.filter("status = 'translated'")
    label = lambda text, c: F.concat(F.lit(f"{text}: "), F.coalesce(c.cast("string"), F.lit("")))
    meta = F.array(label("original", F.col("original_name")), label("language", F.col("lang")), label("pages", F.col("page_count")), label("pictures", F.col("has_pictures")), label("at", F.col("at")))
    made = docx_files(good.select("sha256", stem(F.col("original_name")).alias("title"), meta.alias("meta"), F.col("docx").alias("path")), docx_paragraphs(translated))
    wrote = write_errors(write_with_outcome(made, config.translated_dir, log), "docx_error")
    copied = write_errors(write_with_outcome(content.join(done.filter("status <> 'error'").select("sha256", "copy"), "sha256"), config.translated_dir, log, path="copy"), "copy_error")
    done = done.join(wrote, "sha256", "left").join(copied, "sha256", "left").withColumn("error", F.coalesce("error", "docx_error", "copy_error"))
    done = store(done.withColumn("status", F.when(F.col("error").isNotNull(), "error").otherwise(F.col("status"))).drop("docx_error", "copy_error"))
    moved = store(quarantine(content, done, config.error_dir))
    store(remove_files(moved, config.source_dir))
    ok = F.col("status") != "error"
    copied = F.when(ok, F.concat(F.lit(folder + "/"), "copy")).otherwise(F.concat(F.lit(config.settings["paths"]["error_dir"] + "/"), "original_name"))
    step = _step(DOCX, status=F.col("status"), translated_relpath=F.when(F.col("status") == "translated", F.concat(F.lit(folder + "/"), "docx")), original_relpath=copied, error=F.col("error"), translated_at=F.col("at"))
    result = done.select(F.col("sha256").alias("_sha"), step.alias("_docx"), F.col("page_count").alias("_pages"), F.col("has_pictures").alias("_pics"), F.col("lang").alias("_lang"))
    values = {"translation_docx": F.coalesce("_docx", "translation_docx"), "page_count": F.coalesce("_pages", "page_count"), "has_pictures": F.coalesce("_pics", "has_pictures"), "source_lang": F.coalesce("_lang", "source_lang")}
    _commit(spark, registry_path, found, store(result), values)
    forget(spark, log)
    return registry.load(spark, registry_path)


def _hashed_contents(files: DataFrame) -> DataFrame:
    return sources.with_content(files).withColumn("sha256", F.when(F.col("error").isNull(), F.sha2("content", 256))).drop("error")


def fix_images(spark: SparkSession, config: Config, registry_path: str, store: Store, only: str | None = None) -> DataFrame:
    """Rewrites the image references of translated files that are there; one row: files, changed, failed. Files that don't change aren't written."""
    reg = registry.load(spark, registry_path)
    entries = (registry.only(reg, only) if only else reg).filter("translation_md.translated_md_relpath is not null")
    tails = entries.select(F.regexp_replace("translation_md.translated_md_relpath", r"^.*/(?=[^/]+/[^/]+$)", "").alias("tail")).distinct()
    texts = sources.whole_texts(spark, config.translated_md_dir).select(_tail(F.col("path")).alias("tail"), F.col("text").alias("md"))
    docs = texts.join(tails, "tail").withColumn("base", F.split("tail", "/")[0])
    made = store(with_images_rewritten(docs, "base", source_dir=config.settings["paths"]["step1_md_dir"]))
    written = store(write_files(made.filter("changed"), config.translated_md_dir, "tail", "md"))
    return made.agg(F.count(F.lit(1)).alias("files"), F.count_if("changed").alias("changed")).withColumn("failed", F.lit(written.filter("error is not null").count()))


def download(spark: SparkSession, config: Config, store: Store, remote: DataFrame, fetch_one: Callable[[str], bytes]) -> DataFrame:
    """Files of a remote listing (id, name, mime) that the source folder lacks; (name, error) of each target that was due. A
    failure is a row, and what failed is due again."""
    wanted, _ = sources.targets(remote, config.pdfs_only)
    none = spark.createDataFrame([], "name string, size long")
    present = sources.listing(spark, config.source_dir).select(F.url_decode(F.replace(F.substring_index("path", "/", -1), F.lit("+"), F.lit("%2B"))).alias("name"), "size") if _exists(spark, config.source_dir) and not _is_empty(spark, config.source_dir) else none
    named = wanted.withColumn("name", F.translate("name", fixed.UNSAFE_NAME_CHARS, "_" * len(fixed.UNSAFE_NAME_CHARS)))
    got = store(sources.fetch(named, present, fetch_one))
    written = store(write_files(got.filter("error is null"), config.source_dir, "name"))
    return got.filter("error is not null").select("name", "error").unionByName(written.select(F.col("path").alias("name"), "error"))


def import_cache(spark: SparkSession, config: Config, registry_path: str, cache_path: str, store: Store, folder: str) -> int:
    """Takes up translated blocks of documents whose run was broken off, kept as JSON files in a folder; returns how many texts the block
    cache has gained. Only the Markdown of documents that the files name is read."""
    from ..operators.translate import from_partial, partial_cache

    partial = store(partial_cache(spark, folder))
    reg = registry.load(spark, registry_path).filter("step1.md_relpath is not null").select("sha256", F.col("step1.md_relpath").alias("rel"))
    tail = F.regexp_replace("rel", r"^.*/(?=[^/]+/[^/]+$)", "")
    docs = reg.join(partial.select(F.col("key").alias("sha256")).distinct(), "sha256", "left_semi").select("sha256", F.concat(F.lit(f"{config.step1_md_dir}/"), tail).alias("path"), F.lit(TEXT_BYTES).alias("length"))
    docs = store(sources.with_content(docs, text=True).filter("error is null").select("sha256", F.col("content").alias("md")))
    found = store(from_partial(partial, docs))
    if _exists(spark, cache_path):
        held = narrowed(spark.read.schema(BLOCK_CACHE).parquet(cache_path), found.select("src_sha"), "src_sha")
        found = store(found.join(held.select("src_sha"), "src_sha", "left_anti"))
    new = found.count()
    if new:
        found.select("src_sha", "text").write.mode("append").parquet(cache_path)
    return new


def _tail(path) -> Column:
    """The last folder and name of a file's URL."""
    return F.url_decode(F.replace(F.regexp_replace(path, r"^.*/(?=[^/]+/[^/]+$)", ""), F.lit("+"), F.lit("%2B")))


def _is_empty(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return not p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
