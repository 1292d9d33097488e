"""Queries over the driver's tables, each with its SQL where SQL can express it, by name.

Tables stand in for files: a row of documents is a file named after its source and id, a conversation is a document and
its turns are pages, labels are the state of a step. Every query runs over whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..functions.langid import BY_WORDS, LETTERS, STOP_WORDS, detect
from ..operators import blocks, chunks, langmodel, lookup, pages, registry, report, summarize, translate
from ..schema import LEDGER
from ..sources import ledger, sinks
from ..storage import shared_path, stored

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
_PAGE_LANGS = ["eng", "heb", "eng+heb"]


#: BOILERPLATE_PARTS in a query's SQL stands for all marks of boilerplate, in lower case, as alternatives.
_PARTS = "|".join(re.escape(p.lower()) for p in fixed.BOILERPLATE)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql.replace("BOILERPLATE_PARTS", _PARTS)
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _files(spark: SparkSession, d: str) -> DataFrame:
    """documents as files: sha256, name, path (their id), lang, text."""
    docs = _t(spark, d, "documents")
    name = F.concat("source", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    return docs.select(text.sha256(F.col("text")).alias("sha256"), name.alias("name"), F.col("doc_id").alias("path"), "doc_id", "lang", "text")


_FILES = "f AS (SELECT sha256(text) AS sha256, source || '-' || doc_id || '.pdf' AS name, doc_id, lang, text FROM documents)"


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("sha256"), F.col("turn").cast("int").alias("page_no"), "text", F.when(F.col("role") == "assistant", 1).otherwise(0).alias("n_images"))


def _joined(c: str):
    return F.array_join(c, "|").alias(c)


# ---------------------------------------------------------------- registry


@query(f"WITH {_FILES} SELECT sha256, first(name ORDER BY doc_id) AS original_name, coalesce(array_to_string(list(name ORDER BY doc_id)[2:], '|'), '') AS duplicates FROM f GROUP BY sha256")
def dedup_sha256(spark: SparkSession, d: str) -> DataFrame:
    return registry.deduplicated(_files(spark, d)).select("sha256", "original_name", _joined("duplicates"))


@query(f"WITH {_FILES} SELECT sha256, count(*) - 1 AS n_duplicates FROM f GROUP BY sha256 HAVING count(*) > 1")
def duplicate_names(spark: SparkSession, d: str) -> DataFrame:
    return registry.deduplicated(_files(spark, d)).filter(F.size("duplicates") > 0).select("sha256", F.size("duplicates").cast("long").alias("n_duplicates"))


@query(
    f"WITH {_FILES}, o AS (SELECT sha256, list(name ORDER BY doc_id) AS n FROM f WHERE doc_id % 2 = 0 GROUP BY 1), i AS (SELECT sha256, list(name ORDER BY doc_id) AS n FROM f WHERE doc_id % 2 = 1 GROUP BY 1)"
    " SELECT coalesce(o.sha256, i.sha256) AS sha256, coalesce(o.n, i.n)[1] AS original_name, coalesce(array_to_string(list_concat(coalesce(o.n, []), coalesce(i.n, []))[2:], '|'), '') AS duplicates, 0 AS page_count, false AS has_pictures FROM o FULL JOIN i ON o.sha256 = i.sha256"
)
def registry_upsert(spark: SparkSession, d: str) -> DataFrame:
    files = _files(spark, d)
    old = registry.upsert(registry.empty(spark), files.filter("doc_id % 2 = 0"))
    return registry.upsert(old, files.filter("doc_id % 2 = 1")).select("sha256", "original_name", _joined("duplicates"), "page_count", "has_pictures")


_ARRIVAL = "CASE WHEN doc_id % 2 = 0 THEN 0 WHEN doc_id % 4 = 1 THEN 1 ELSE 2 END, doc_id"


@query(f"WITH {_FILES}, g AS (SELECT sha256, list(name ORDER BY {_ARRIVAL}) AS n FROM f GROUP BY 1) SELECT sha256, n[1] AS original_name, coalesce(array_to_string(n[2:], '|'), '') AS duplicates, 0 AS page_count, false AS has_pictures FROM g")
def registry_by_deltas(spark: SparkSession, d: str) -> DataFrame:
    """Upserts by commits: a base, two deltas over it that share contents with it, and a merge on read."""
    files, path = _files(spark, d).select("sha256", "name", "path", "doc_id"), shared_path(spark, "registry")
    registry.save(registry.upsert(registry.empty(spark), files.filter("doc_id % 2 = 0")), path)
    for rest in (1, 3):
        part = files.filter(F.col("doc_id") % 4 == rest)
        registry.update(spark, path, lambda known, part=part: registry.upserted(known, part))
    return registry.load(spark, path).select("sha256", "original_name", _joined("duplicates"), "page_count", "has_pictures")


@query(f"WITH {_FILES} SELECT doc_id, name, CASE WHEN doc_id % 3 = 0 THEN 'fresh' WHEN doc_id % 3 = 1 AND doc_id % 2 = 0 THEN 'fresh' ELSE 'known' END AS state, CASE WHEN doc_id % 3 = 0 OR (doc_id % 3 = 1 AND doc_id % 2 = 0) THEN NULL ELSE sha256 END AS sha256 FROM f")
def ledger_states(spark: SparkSession, d: str) -> DataFrame:
    """Which files have to be read: the ledger lacks a third of them and has some of the others as they were before a change."""
    files = _files(spark, d)
    listed = files.select(F.col("doc_id").cast("string").alias("path"), "name", F.length("text").cast("long").alias("length"), F.timestamp_seconds(F.col("doc_id")).alias("mtime"), "doc_id", "sha256")
    old = (F.col("doc_id") % 2 == 0) & (F.col("doc_id") % 3 == 1)
    held = stored(listed.filter("doc_id % 3 > 0").select("path", F.when(old, F.col("length") + 1).otherwise(F.col("length")).alias("length"), "mtime", "sha256"), "read-files")
    at = shared_path(spark, "ledger")
    for part in (0, 1):
        ledger.add(spark, at, held.filter(F.col("path").cast("long") % 2 == part))
    known, fresh = ledger.split(listed.drop("sha256"), registry.load(spark, at, LEDGER, "path"))
    return known.select("doc_id", "name", F.lit("known").alias("state"), "sha256").unionByName(fresh.select("doc_id", "name", F.lit("fresh").alias("state"), F.lit(None).cast("string").alias("sha256")))


@query("SELECT doc_id, octet_length(encode(text)) AS bytes, sha256(text) AS sha256, false AS failed FROM documents UNION ALL SELECT -doc_id - 1, -1, NULL, true FROM documents WHERE doc_id % 10 = 0")
def files_with_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Every document as a file of its own, in two steps with a manifest; for every tenth, a second one whose path can't be written."""
    docs = _t(spark, d, "documents").select("doc_id", "text")
    good = docs.select("doc_id", F.concat((F.col("doc_id") % 100).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), "text")
    bad = docs.filter("doc_id % 10 = 0").select((-F.col("doc_id") - 1).alias("doc_id"), F.concat(F.lit("../"), F.col("doc_id").cast("string")).alias("path"), "text")
    wrote = sinks.write_with_outcome(good.unionByName(bad), shared_path(spark, "files"), shared_path(spark, "writes"), "doc_id", content="text")
    return wrote.select(F.col("key").cast("long").alias("doc_id"), F.coalesce("bytes", F.lit(-1)).alias("bytes"), "sha256", F.col("error").isNotNull().alias("failed"))


@query(f"WITH {_FILES}, r AS (SELECT name, (row_number() OVER (ORDER BY lower(name), sha256 || doc_id) - 1) // 100 + 1 AS page FROM f) SELECT CASE WHEN page = 1 THEN 'index.html' ELSE 'index-' || page || '.html' END AS path, count(*) AS n_rows, min(lower(name)) AS first_name, max(lower(name)) AS last_name FROM r GROUP BY page")
def index_pages(spark: SparkSession, d: str) -> DataFrame:
    """The index of all documents in files of 100 rows; of each file its rows and the first and last name in it."""
    files = _files(spark, d).select(F.col("name").alias("original_name"), F.concat("sha256", F.col("doc_id").cast("string")).alias("sha256"))
    rows = files.withColumn("row", F.concat(F.lit("<tr><td>"), text.html_escape(F.col("original_name")), F.lit("</td></tr>")))
    made = report.pages(rows, None, "now", lambda df: stored(df, "index"), per_page=100)
    names = F.regexp_extract_all("content", F.lit("<tr><td>(.*?)</td></tr>"), 1)
    return made.select("path", names.alias("n")).select("path", F.size("n").cast("long").alias("n_rows"), F.lower(F.get("n", F.lit(0))).alias("first_name"), F.lower(F.element_at("n", -1)).alias("last_name"))


@query("SELECT p.page_id, p.url, d.n FROM pages p JOIN (SELECT DISTINCT page_id // 7 * 7 AS page_id, page_id // 7 AS n FROM pages WHERE page_id % 7 = 3) d USING (page_id)")
def cache_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A large table by key, narrowed to the keys that are due before it is joined with them."""
    pages_ = _t(spark, d, "pages")
    n = F.floor(F.col("page_id") / 7).cast("long")
    due = stored(pages_.filter("page_id % 7 = 3").select((n * 7).alias("page_id"), n.alias("n")).distinct(), "due-keys")
    return lookup.narrowed(pages_.select("page_id", "url"), due, "page_id").join(due, "page_id").select("page_id", "url", "n")


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """documents left joined with labels, as registry entries in different states."""
    labels = _t(spark, d, "labels").select(F.col("doc_id").alias("_id"), "quality", "toxic")
    df = _files(spark, d).join(labels, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    status = F.when(F.col("quality") == 1, "done").when(F.col("quality") == 0, "error")
    n = F.col("doc_id")
    rel = F.concat(F.lit("step1_md/"), n.cast("string"), F.lit("/a b.md"))
    he = F.concat(F.lit("translated_md/"), n.cast("string"), F.lit(".he.md"))
    error = F.when(F.col("quality") == 0, F.concat(F.lit("bad <"), F.col("lang"), F.lit(">")))
    step1 = F.when(F.col("quality").isNotNull(), F.struct(status.alias("status"), F.when(status == "done", rel).alias("md_relpath"), (n % 3).cast("int").alias("image_count"), F.when(n % 4 == 0, "ocr").otherwise("text").alias("mode"), F.lit("2026-01-01 00:00:00").alias("at"), error.alias("error")))
    state = F.when(F.col("lang") == "de", "already_hebrew").when(F.col("toxic") == 1, "error").when(n % 2 == 0, "done")
    tr = F.when(F.col("quality").isNotNull() & state.isNotNull(), F.struct(state.alias("status"), F.when(state == "done", he).alias("translated_md_relpath"), F.lit("2026-01-02 00:00:00").alias("at"), F.when(state == "error", "No & no").alias("error")))
    summary = F.when(n % 5 == 0, F.struct(F.when(n % 10 == 0, F.concat(F.lit("About "), "name")).otherwise("").alias("text"), F.when(n % 3 == 0, he).otherwise(rel).alias("source_relpath"), F.when(n % 3 == 0, "translated_md").otherwise("step1_md_hebrew").alias("source_kind"), F.struct((n % 7).alias("size"), F.lit(5).cast("long").alias("mtime")).alias("source_fingerprint"), F.lit("2026-01-03 00:00:00").alias("at")))
    return df.select(F.concat("sha256", n.cast("string")).alias("sha256"), F.col("name").alias("original_name"), (n % 9).cast("int").alias("page_count"), (n % 2 == 1).alias("has_pictures"), F.col("lang").alias("source_lang"), F.length("text").cast("long").alias("text_layer_chars"), step1.alias("step1"), tr.alias("translation_md"), summary.alias("summary"), "doc_id", "lang")


_ENTRIES = f"""{_FILES},
e AS (SELECT f.*, quality, toxic, CASE quality WHEN 1 THEN 'done' WHEN 0 THEN 'error' END AS s1,
  CASE WHEN quality IS NULL THEN NULL WHEN lang = 'de' THEN 'already_hebrew' WHEN toxic = 1 THEN 'error' WHEN doc_id % 2 = 0 THEN 'done' END AS tr FROM f LEFT JOIN labels USING (doc_id))"""


@query(f"WITH {_ENTRIES} SELECT doc_id, name AS original_name FROM e WHERE s1 IS DISTINCT FROM 'done' ORDER BY lower(name), sha256 || doc_id LIMIT 25")
def pending_worklist(spark: SparkSession, d: str) -> DataFrame:
    return registry.work_list(_entries(spark, d), registry.is_pending(F.col("step1.status")), 25).select("doc_id", "original_name")


@query(f"WITH {_FILES} SELECT doc_id, name FROM f WHERE regexp_full_match(name, 'src1[0-3]-.*[^05].pdf')")
def only_glob(spark: SparkSession, d: str) -> DataFrame:
    return registry.only(_files(spark, d), "src1[0-3]-*[!05]?pdf", "name").select("doc_id", "name")


@query(f"WITH {_FILES} SELECT doc_id, sha256[1:8] AS sha FROM f WHERE starts_with(sha256, 'a')")
def sha_prefix(spark: SparkSession, d: str) -> DataFrame:
    return registry.with_sha_prefix(_files(spark, d), "a").select("doc_id", text.sha_prefix(F.col("sha256")).alias("sha"))


@query(f"WITH {_ENTRIES} SELECT doc_id, coalesce(s1 = 'done', false) AS eligible, coalesce(tr IN ('done', 'already_hebrew'), false) AS translated, lang = 'de' AS in_target, length(text) < 200 AS needs_ocr, CASE WHEN NOT coalesce(s1 = 'done', false) THEN 'skipped' WHEN coalesce(tr IN ('done', 'already_hebrew'), false) THEN 'cached' WHEN lang = 'de' THEN 'already_hebrew' WHEN tr = 'error' THEN 'error' ELSE 'done' END AS outcome FROM e")
def lang_gate_status(spark: SparkSession, d: str) -> DataFrame:
    df = _entries(spark, d)
    eligible, done = registry.is_eligible(F.col("step1")), registry.is_translated(F.col("translation_md.status"))
    target = registry.in_target_language(F.col("source_lang"), ("de",))
    return df.select("doc_id", eligible.alias("eligible"), done.alias("translated"), target.alias("in_target"), registry.needs_ocr(F.col("text_layer_chars")).alias("needs_ocr"), translate.outcome(eligible, done, target, F.col("translation_md.error")).alias("outcome"))


@query(
    "WITH u AS (SELECT sha256(text) AS sha256, first(text ORDER BY doc_id) AS text, first(lang ORDER BY doc_id) AS lang FROM documents GROUP BY 1),"
    " l AS (SELECT lang, sha256, unnest(string_split(text, chr(10))) AS s FROM u),"
    " c AS (SELECT lang, sha256, count(*) FILTER (length(s) BETWEEN 40 AND 600 AND len(regexp_extract_all(s, '[A-Za-z]')) >= 15 AND len(regexp_extract_all(s, '[A-Za-z]')) * 4 >= length(s) AND len(regexp_extract_all(s, '[0-9]')) / length(s) <= 0.35 AND NOT regexp_matches(lower(s), 'BOILERPLATE_PARTS')) AS n FROM l GROUP BY 1, 2)"
    " SELECT lang, CASE WHEN lang = 'de' THEN 'already_hebrew' WHEN n = 0 THEN 'empty' ELSE 'summarized' END AS status, count(*) AS documents, CAST(sum(n) AS BIGINT) AS sentences FROM c GROUP BY 1, 2"
)
def status_rollup(spark: SparkSession, d: str) -> DataFrame:
    one = _files(spark, d).groupBy("sha256").agg(F.min_by("text", "doc_id").alias("text"), F.min_by("lang", "doc_id").alias("lang"))
    found = one.withColumn("n", F.size(F.filter(F.split("text", "\n"), lambda s: summarize.is_candidate(s, "latin"))))
    status = F.when(registry.in_target_language(F.col("lang"), ("de",)), "already_hebrew").when(F.col("n") == 0, "empty").otherwise("summarized")
    return found.groupBy("lang", status.alias("status")).agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("sentences"))


# ---------------------------------------------------------------- pages

_PAGES = "p AS (SELECT CAST(conv_id AS VARCHAR) AS sha256, turn AS page_no, text, CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS n_images FROM conversations)"


@query(f"WITH {_PAGES} SELECT sha256, CAST(count(*) AS INTEGER) AS page_count, CAST(sum(length(text)) AS BIGINT) AS text_layer_chars, bool_or(n_images > 0) AS has_pictures FROM p GROUP BY 1")
def page_stats(spark: SparkSession, d: str) -> DataFrame:
    return pages.page_stats(_pages(spark, d))


@query(f"WITH {_PAGES}, r AS (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY sha256 ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM p) SELECT sha256, count(*) AS n_pages, string_agg(text, chr(10) ORDER BY page_no) AS sample FROM r WHERE b < 4000 GROUP BY 1")
def lang_sample_running_sum(spark: SparkSession, d: str) -> DataFrame:
    return pages.langid_sample(_pages(spark, d))


@query("SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z]')) AS BIGINT) AS latin, CAST(len(regexp_extract_all(text, '[\\x{0590}-\\x{05FF}]')) AS BIGINT) AS hebrew, CAST(len(regexp_extract_all(text, '[A-Za-z\\x{0370}-\\x{03FF}\\x{0400}-\\x{04FF}\\x{0530}-\\x{06FF}]')) AS BIGINT) AS letters, round(len(regexp_extract_all(text, '\\p{Nd}')) / length(text), 6) AS digit_share FROM documents")
def script_counts(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    return _t(spark, d, "documents").select("doc_id", text.script_count(c, "latin").alias("latin"), text.script_count(c, "hebrew").alias("hebrew"), text.letter_count(c).alias("letters"), F.round(text.digit_share(c), 6).alias("digit_share"))


def _readings(spark: SparkSession, d: str) -> DataFrame:
    """Stand-in readings: in full for eng, without vowels for heb, in full again for eng+heb; some fail."""
    c = pages.per_language(_pages(spark, d), _PAGE_LANGS)
    bad = (F.col("page_no") + F.col("lang_ord")) % 4 == 3
    out = F.when(F.col("lang") == "heb", F.translate("text", "aeiou", "")).otherwise(F.col("text"))
    return c.withColumn("text", F.when(~bad, out)).withColumn("error", F.when(bad, "failed"))


_READINGS = f"""{_PAGES}, c AS (SELECT sha256, page_no, lang, o, CASE lang WHEN 'heb' THEN translate(text, 'aeiou', '') ELSE text END AS text FROM p, (VALUES ('eng', 0), ('heb', 1), ('eng+heb', 2)) v(lang, o) WHERE (page_no + o) % 4 <> 3),
s AS (SELECT *, len(regexp_extract_all(text, CASE lang WHEN 'eng' THEN '[A-Za-z]' WHEN 'heb' THEN '[\\x{{0590}}-\\x{{05FF}}]' ELSE '[A-Za-z\\x{{0590}}-\\x{{05FF}}]' END)) AS n FROM c),
w AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY sha256, page_no ORDER BY n DESC, length(text) DESC, o) = 1)"""


@query(f"WITH {_READINGS} SELECT sha256, CAST(page_no AS INTEGER) AS page_no, lang, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM w")
def best_engine_per_page(spark: SparkSession, d: str) -> DataFrame:
    return pages.best_reading(_readings(spark, d), ["sha256", "page_no"])


@query(f"WITH {_READINGS} SELECT lang, count(*) AS pages FROM w GROUP BY 1")
def engine_usage(spark: SparkSession, d: str) -> DataFrame:
    return pages.language_usage(pages.best_reading(_readings(spark, d), ["sha256", "page_no"]))


@query(f"WITH {_READINGS} SELECT sha256, string_agg('<!-- page ' || page_no || ' (lang=' || lang || ') -->' || chr(10) || chr(10) || regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10) || chr(10) ORDER BY page_no) AS md FROM w GROUP BY 1")
def ocr_markdown(spark: SparkSession, d: str) -> DataFrame:
    return pages.document_markdown(pages.best_reading(_readings(spark, d), ["sha256", "page_no"]))


@query(f"WITH {_PAGES}, l AS (SELECT sha256, page_no, list_filter(list_transform(string_split(text, chr(10)), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '') AS l FROM p), m AS (SELECT sha256, page_no, CASE WHEN len(l) = 0 THEN [NULL] ELSE l END AS l FROM l) SELECT sha256, CAST(page_no AS INTEGER) AS page_no, CAST(unnest(range(1, len(l) + 1)) AS INTEGER) AS par_no, unnest(l) AS text FROM m")
def docx_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return pages.docx_paragraphs(_pages(spark, d))


# ---------------------------------------------------------------- Markdown


def _markdown(spark: SparkSession, d: str) -> DataFrame:
    """A Markdown document per conversation, of blocks of each kind."""
    c = _t(spark, d, "conversations")
    k = F.pmod(F.col("turn") + F.col("conv_id"), F.lit(6))
    block = F.when(k == 0, F.concat(F.lit("## "), "text", F.lit(" ##"))).when(k == 1, F.concat(F.lit("- "), F.replace("text", F.lit("\n"), F.lit("\n  2. ")))).when(k == 2, F.concat(F.lit(">  "), "text")).when(k == 3, F.concat(F.lit("| a | b |\n|---|---|"))).when(k == 4, F.concat(F.lit("![x](images/a b.png) "), "text")).otherwise(F.col("text"))
    return c.withColumn("b", block).groupBy("conv_id").agg(pages.ordered_concat("turn", "b", "\n \n").alias("md"))


_MARKDOWN = """m AS (SELECT conv_id, string_agg(CASE (turn + conv_id) % 6 WHEN 0 THEN '## ' || text || ' ##' WHEN 1 THEN '- ' || replace(text, chr(10), chr(10) || '  2. ') WHEN 2 THEN '>  ' || text WHEN 3 THEN '| a | b |' || chr(10) || '|---|---|' WHEN 4 THEN '![x](images/a b.png) ' || text ELSE text END, chr(10) || ' ' || chr(10) ORDER BY turn) AS md FROM conversations GROUP BY conv_id)"""
_ST = "'^\\s*!\\[.*\\]\\(.*\\)\\s*$|^\\s*<!--.*$|^.*-->\\s*$|^\\s*[`~]{3,}.*$|^\\s*\\|.*\\|\\s*$|^\\s*[-*_]{3,}\\s*$'"
_BLOCKS = f"""{_MARKDOWN}, z AS (SELECT conv_id, string_split_regex(md, '\\n\\s*\\n') AS b, regexp_extract_all(md, '\\n\\s*\\n') AS g FROM m),
y AS (SELECT conv_id, list_filter(flatten(list_transform(range(1, len(b) + 1), lambda i: [b[i], coalesce(g[i], '')])), lambda x: x <> '') AS x FROM z),
q AS (SELECT conv_id, CAST(unnest(range(1, len(x) + 1)) AS INTEGER) AS block_idx, unnest(x) AS text FROM y),
l AS (SELECT *, list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '\\S')) AS n FROM q),
k AS (SELECT conv_id, block_idx, CASE WHEN len(list_filter(n, lambda s: NOT regexp_matches(s, {_ST}))) = 0 THEN 'passthrough' WHEN regexp_matches(n[1], '^#{{1,6}}\\s+') THEN 'heading' WHEN regexp_matches(n[1], '^\\s*([-*+]|\\d+\\.)\\s+.+') THEN 'list' WHEN regexp_matches(n[1], '^\\s*>+\\s*') THEN 'blockquote' ELSE 'prose' END AS kind, text FROM l)"""


@query(f"WITH {_BLOCKS} SELECT conv_id, block_idx, kind, text FROM k")
def parse_blocks(spark: SparkSession, d: str) -> DataFrame:
    return blocks.parse_blocks(_markdown(spark, d))


@query(f"WITH {_BLOCKS} SELECT kind, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM k GROUP BY 1")
def block_kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return blocks.parse_blocks(_markdown(spark, d)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query(f"WITH {_BLOCKS} SELECT conv_id, count(*) AS blocks, count(*) FILTER (kind <> 'passthrough') AS translated_blocks FROM k GROUP BY 1")
def block_totals(spark: SparkSession, d: str) -> DataFrame:
    return translate.block_totals(blocks.parse_blocks(_markdown(spark, d)), "conv_id")


@query(f"WITH {_BLOCKS}, r AS (SELECT *, sum(CASE WHEN kind <> 'passthrough' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY block_idx) AS nth FROM k) SELECT conv_id, block_idx, CAST(nth AS BIGINT) AS nth, kind <> 'passthrough' AND nth % 3 = 0 AS checkpoint FROM r")
def checkpoint_ordinals(spark: SparkSession, d: str) -> DataFrame:
    return translate.checkpoint_numbers(blocks.parse_blocks(_markdown(spark, d)), "conv_id", 3).select("conv_id", "block_idx", "nth", "checkpoint")


_SEGMENTS = f"""{_BLOCKS}, v AS (SELECT conv_id, block_idx, kind, CASE WHEN kind IN ('heading', 'list', 'blockquote') THEN CASE WHEN ends_with(text, chr(10)) THEN string_split(text, chr(10))[:-2] ELSE string_split(text, chr(10)) END ELSE [text] END AS a FROM k),
u AS (SELECT conv_id, block_idx, kind, CAST(unnest(range(1, len(a) + 1)) AS INTEGER) AS line_no, unnest(a) AS s FROM v),
t AS (SELECT *, CASE kind WHEN 'heading' THEN regexp_matches(s, '^(#{{1,6}})\\s+(.*?)\\s*#*\\s*$') WHEN 'list' THEN regexp_matches(s, '^(\\s*)([-*+]|\\d+\\.)\\s+(.+?)\\s*$') WHEN 'blockquote' THEN regexp_matches(s, '^(\\s*>+\\s*)(.*)$') ELSE kind = 'prose' END AS hit FROM u),
sg AS (SELECT conv_id, block_idx, kind, line_no, CASE WHEN hit AND kind = 'heading' THEN regexp_extract(s, '^(#{{1,6}})\\s+', 1) || ' ' WHEN hit AND kind = 'list' THEN regexp_extract(s, '^(\\s*)([-*+]|\\d+\\.)\\s+', 1) || regexp_extract(s, '^(\\s*)([-*+]|\\d+\\.)\\s+', 2) || ' ' WHEN hit AND kind = 'blockquote' THEN regexp_extract(s, '^\\s*>+\\s*') ELSE '' END AS prefix,
 CASE WHEN hit AND kind = 'heading' THEN regexp_extract(s, '^(#{{1,6}})\\s+(.*?)\\s*#*\\s*$', 2) WHEN hit AND kind = 'list' THEN regexp_extract(s, '^(\\s*)([-*+]|\\d+\\.)\\s+(.+?)\\s*$', 3) WHEN hit AND kind = 'blockquote' THEN regexp_extract(s, '^(\\s*>+\\s*)(.*)$', 2) ELSE s END AS text, hit AS translatable FROM t)"""


@query(f"WITH {_SEGMENTS} SELECT conv_id, block_idx, kind, line_no, prefix, text, translatable FROM sg")
def md_segments(spark: SparkSession, d: str) -> DataFrame:
    return blocks.segments(blocks.parse_blocks(_markdown(spark, d)))


@query(
    f"WITH {_SEGMENTS}, j AS (SELECT conv_id, block_idx, string_agg(CASE WHEN translatable THEN prefix || '<' || regexp_replace(text, '^\\s+|\\s+$', '', 'g') || '>' ELSE text END, chr(10) ORDER BY line_no) AS t FROM sg GROUP BY 1, 2) SELECT conv_id, string_agg(t, '' ORDER BY block_idx) AS md FROM j GROUP BY 1"
)
def md_line_rewrap(spark: SparkSession, d: str) -> DataFrame:
    segs = blocks.segments(blocks.parse_blocks(_markdown(spark, d)))
    done = segs.withColumn("translated", F.concat(F.lit("<"), text.strip(F.col("text")), F.lit(">")))
    return blocks.assemble_documents(blocks.assemble_blocks(done, ["conv_id"]), ["conv_id"])


@query(f"WITH {_SEGMENTS}, w AS (SELECT DISTINCT text FROM sg WHERE translatable), c AS (SELECT DISTINCT text FROM sg WHERE translatable AND conv_id % 2 = 0) SELECT sha256(text) AS src_sha, CAST(length(text) AS BIGINT) AS n_chars FROM w ANTI JOIN c USING (text)")
def translate_cache_resume(spark: SparkSession, d: str) -> DataFrame:
    segs = blocks.segments(blocks.parse_blocks(_markdown(spark, d)))
    cache = segs.filter("translatable and conv_id % 2 = 0").select(text.sha256(F.col("text")).alias("src_sha")).distinct()
    return translate.missing(segs, cache).select("src_sha", F.length("source").cast("long").alias("n_chars"))


@query(
    f"WITH {_SEGMENTS}, e AS (SELECT *, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s FROM sg), j AS (SELECT conv_id, block_idx, string_agg(CASE WHEN translatable THEN prefix || CASE WHEN s = '' THEN '' ELSE '⟦' || s || '⟧' END ELSE text END, chr(10) ORDER BY line_no) AS t FROM e GROUP BY 1, 2) SELECT conv_id, string_agg(t, '' ORDER BY block_idx) AS md FROM j GROUP BY 1"
)
def pseudo_translate_assemble(spark: SparkSession, d: str) -> DataFrame:
    segs = blocks.segments(blocks.parse_blocks(_markdown(spark, d)))
    none = spark.createDataFrame([], translate.RESULTS)
    found = translate.run_engine(translate.missing(segs, none), "pseudo", slots=8, limit=1 << 20)
    done = translate.with_cache(segs, found).withColumn("translated", F.coalesce("translated", F.lit("")))
    return blocks.assemble_documents(blocks.assemble_blocks(done, ["conv_id"]), ["conv_id"])


@query(f"WITH {_MARKDOWN} SELECT conv_id, replace(md, '](images/a b.png)', '](../../step1_md/doc%20' || conv_id || '%20%281%29/images/a%20b.png)') AS md, contains(md, '](images/') AS changed FROM m")
def image_ref_rewrite(spark: SparkSession, d: str) -> DataFrame:
    base = F.concat(F.lit("doc "), F.col("conv_id").cast("string"), F.lit(" (1)"))
    return blocks.with_images_rewritten(_markdown(spark, d).withColumn("base", base), "base").select("conv_id", "md", "changed")


# ---------------------------------------------------------------- chunks


def _chunk_sql(parts: str) -> str:
    """SQL of the fold: parts gives (doc_id, i, s, glue, brk) of long texts, i from 1, with parts longer than the limit cut to it;
    a part joins the chunk that is held, unless it breaks or the limit would be passed."""
    limit = fixed.CHUNK_CHARS
    return f"""
WITH RECURSIVE long_texts AS (SELECT doc_id, text FROM documents WHERE length(text) > {limit}), {parts},
r AS (
  SELECT doc_id, 0 AS i, CAST(0 AS BIGINT) AS held, 0 AS chunk, false AS first FROM long_texts
  UNION ALL
  SELECT r.doc_id, p.i, CASE WHEN r.held = 0 OR p.brk OR r.held + 1 + length(p.s) > {limit} THEN length(p.s) ELSE r.held + 1 + length(p.s) END,
    r.chunk + CASE WHEN r.held > 0 AND (p.brk OR r.held + 1 + length(p.s) > {limit}) THEN 1 ELSE 0 END,
    r.held = 0 OR p.brk OR r.held + 1 + length(p.s) > {limit}
  FROM r JOIN p ON p.doc_id = r.doc_id AND p.i = r.i + 1
), c AS (
  SELECT r.doc_id, r.chunk, string_agg((CASE WHEN r.first THEN '' ELSE p.glue END) || p.s, '' ORDER BY p.i) AS text
  FROM r JOIN p ON p.doc_id = r.doc_id AND p.i = r.i GROUP BY r.doc_id, r.chunk
)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY chunk) - 1 AS INTEGER) AS chunk_no, text FROM c WHERE text <> ''
UNION ALL SELECT doc_id, 0, text FROM documents WHERE length(text) BETWEEN 1 AND {limit}
"""


#: Pieces of at most the limit of a part s, numbered by j; an empty part is one piece.
_PIECES = f"unnest(range(1, greatest(1, CAST(ceil(length(s) / {fixed.CHUNK_CHARS}.0) AS BIGINT)) + 1)) AS j"
_PIECE = f"substring(s, CAST((j - 1) * {fixed.CHUNK_CHARS} + 1 AS BIGINT), {fixed.CHUNK_CHARS})"
_LINES_SQL = f"""
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line FROM long_texts),
cut AS (SELECT doc_id, line, length(s) > {fixed.CHUNK_CHARS} AS over, CASE WHEN length(s) > {fixed.CHUNK_CHARS} THEN string_split(regexp_replace(s, '([?!.]) ', '\\1' || chr(1), 'g'), chr(1)) ELSE [s] END AS parts FROM lines),
parts AS (SELECT doc_id, line, over, unnest(parts) AS s, unnest(range(1, len(parts) + 1)) AS k FROM cut),
pieces AS (SELECT *, {_PIECES} FROM parts),
p AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line, k, j) AS i, {_PIECE} AS s, CASE WHEN over THEN ' ' ELSE chr(10) END AS glue, over AND k = 1 AND j = 1 AS brk FROM pieces)"""
_SENTENCES_SQL = f"""
cut AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: regexp_matches(s, '\\S')) AS found FROM long_texts),
whole AS (SELECT doc_id, CASE WHEN len(found) > 0 THEN found ELSE [text] END AS parts FROM cut),
parts AS (SELECT doc_id, unnest(parts) AS s, unnest(range(1, len(parts) + 1)) AS k FROM whole),
pieces AS (SELECT *, {_PIECES} FROM parts),
p AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k, j) AS i, {_PIECE} AS s, ' ' AS glue, false AS brk FROM pieces)"""


@query(_chunk_sql(_LINES_SQL))
def chunk_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", F.posexplode(chunks.chunks(F.col("text"))).alias("chunk_no", "text"))


@query(_chunk_sql(_SENTENCES_SQL))
def chunk_sentences(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", F.posexplode(chunks.chunks(F.col("text"), by="sentences")).alias("chunk_no", "text"))


@query("SELECT doc_id, true AS within, sha256(regexp_replace(text, '\\s+', '', 'g')) AS content FROM documents")
def chunk_invariants(spark: SparkSession, d: str) -> DataFrame:
    """No chunk is over the limit, and the chunks hold all characters but white space."""
    parts = _t(spark, d, "documents").select("doc_id", chunks.chunks(F.col("text"), 1000).alias("c"))
    return parts.select("doc_id", F.forall("c", lambda x: F.length(x) <= 1000).alias("within"), text.sha256(F.regexp_replace(F.array_join("c", ""), r"\s+", "")).alias("content"))


@query("SELECT doc_id, CAST(len(list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: regexp_matches(s, '\\S'))) AS BIGINT) AS n FROM documents")
def translator_sentences(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", F.size(chunks.sentences(F.col("text"))).cast("long").alias("n"))


# ---------------------------------------------------------------- scalars


@query("SELECT event_id, regexp_matches(left(m, 400), '(?i)Error\\s*\\d{3}\\s*\\(|That\\x{2019}?s an error|That.{0,3}s all we know|Please try again later|<html') AS error_page, regexp_matches(lower(m), 'api connection error|read timed out|connection aborted|remote end closed connection|connectionerror|too many requests|requesterror') AS rate_limit FROM (SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'Error 5' || (event_id % 90 + 10) || ' (Server)' WHEN 1 THEN 'please TRY again later' WHEN 2 THEN '429 Too many requests' WHEN 3 THEN 'That is all we know' WHEN 4 THEN repeat('x', 395) || '<html>' ELSE event_type || props END AS m FROM events)")
def error_classes(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    m = F.when(n % 7 == 0, F.concat(F.lit("Error 5"), (n % 90 + 10).cast("string"), F.lit(" (Server)"))).when(n % 7 == 1, "please TRY again later").when(n % 7 == 2, "429 Too many requests").when(n % 7 == 3, "That is all we know").when(n % 7 == 4, "x" * 395 + "<html>").otherwise(F.concat("event_type", "props"))
    return _t(spark, d, "events").select("event_id", text.is_error_page(m).alias("error_page"), text.is_rate_limit(m).alias("rate_limit"))


@query("SELECT page_id, trim(translate(regexp_extract(url, '[^/]*//(.*)', 1), '<>:\"/\\|?*', '_________')) AS n, replace(replace(url_encode(replace(url, 'http', 'h p~*')), '%2F', '/'), '*', '%2A') AS href, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped, regexp_extract(rtrim(regexp_replace(url, '\\?.*$', ''), '/'), '[^/]*$') AS segment FROM pages")
def names_and_escapes(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "pages")
    rest = F.translate(F.regexp_extract("url", "[^/]*//(.*)", 1), "/", "|")
    return p.select("page_id", text.safe_name(F.concat(rest, F.lit(".pdf"))).alias("n"), report.href(F.replace("url", F.lit("http"), F.lit("h p~*"))).alias("href"), text.html_escape(F.col("html")).alias("escaped"), text.last_segment(F.col("url")).alias("segment"))


def _langid(name: str, source: str, key: str, least: int = fixed.LANGID_LEAST) -> str:
    """SQL of name (key, detected) from a table source (key, text). Words are cut out and looked up in lists here, not matched by
    one pattern a language."""
    cut = ", ".join(f"regexp_split_to_array(h, '[^{LETTERS[s]}]+') AS {s}_words, len(regexp_extract_all(h, '[{LETTERS[s]}]')) AS {s}" for s in BY_WORDS)
    counts = ", ".join(f"len(list_filter({s}_words, lambda x: x IN ({', '.join(repr(w) for w in STOP_WORDS[lang])}))) AS {lang}" for s, langs in BY_WORDS.items() for lang in langs)
    best = {s: f"greatest({', '.join(langs)})" for s, langs in BY_WORDS.items()}
    cases = " ".join(f"WHEN {lang} = {best['latin']} THEN '{lang}'" for lang in BY_WORDS["latin"])
    return f"""{name}_f AS (SELECT {key}, left(trim(regexp_replace(text, '\\s+', ' ', 'g')), 4000) AS t FROM {source}),
{name}_w AS (SELECT {key}, t, {cut}, len(regexp_extract_all(h, '[{LETTERS["arabic"]}]')) AS arabic FROM (SELECT *, lower(t) AS h FROM {name}_f)),
{name}_c AS (SELECT {key}, t, latin, hebrew, arabic, {counts} FROM {name}_w),
{name} AS (SELECT {key}, CASE WHEN length(t) < {least} THEN NULL WHEN hebrew > 0 AND hebrew >= latin AND hebrew >= arabic THEN CASE WHEN yi > he THEN 'yi' ELSE 'he' END WHEN arabic > latin THEN 'ar' WHEN {best["latin"]} = 0 THEN NULL {cases} END AS detected FROM {name}_c)"""


@query(f"WITH {_langid('d', 'documents', 'doc_id')} SELECT doc_id, detected FROM d")
def detect_language(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", detect(F.col("text")).alias("detected"))


_GRAMS = " UNION ALL ".join(f"SELECT *, unnest(list_transform(range(1, greatest(length(t) - {k - 1}, 0) + 1), lambda i: substring(t, CAST(i AS BIGINT), {k}))) AS gram FROM TEXTS" for k in (1, 2, 3))
_PLAIN = "lower(trim(regexp_replace(text, '[\\x20\\x09-\\x0D]+', ' ', 'g')))"
_LOG = "CAST(round(1000 * ln((CAST(NUMBER AS DOUBLE) + 0.5::DOUBLE) / (CAST(total AS DOUBLE) + 0.5::DOUBLE * (number + 1)))) AS BIGINT)"


def _scores_sql(name: str, texts: str, key: str) -> str:
    return f"""{name}_t AS (SELECT * FROM ({texts}) WHERE t <> ''), {name}_g AS MATERIALIZED (SELECT {key}, gram, count(*) AS n FROM ({_GRAMS.replace("TEXTS", f"{name}_t")}) GROUP BY ALL),
{name}_n AS (SELECT {key}, sum(n) AS n FROM {name}_g GROUP BY ALL),
{name}_gain AS (SELECT {key}, m.lang AS of, sum(n * (w - floor)) AS gain FROM {name}_g JOIN m USING (gram) JOIN fl ON fl.lang = m.lang GROUP BY ALL),
{name} AS (SELECT *, gain + n * floor AS score FROM {name}_gain JOIN {name}_n USING ({key}) JOIN fl ON fl.lang = of)"""


@query(
    f"""WITH tr AS (SELECT lang, {_PLAIN} AS t FROM documents WHERE doc_id % 4 <> 2 AND text IS NOT NULL AND lang IS NOT NULL),
cn AS MATERIALIZED (SELECT lang, gram, count(*) AS n FROM ({_GRAMS.replace("TEXTS", "(SELECT * FROM tr WHERE t <> '')")}) GROUP BY ALL),
k AS MATERIALIZED (SELECT DISTINCT gram FROM (SELECT gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, length(gram), encode(gram)) AS r FROM cn) WHERE r <= {langmodel.PROFILE}),
tot AS (SELECT lang, sum(n) AS total FROM cn GROUP BY lang), num AS (SELECT count(*) AS number FROM k),
m AS MATERIALIZED (SELECT k.gram, tot.lang, {_LOG.replace("NUMBER", "coalesce(cn.n, 0)")} AS w FROM k CROSS JOIN tot CROSS JOIN num LEFT JOIN cn ON cn.gram = k.gram AND cn.lang = tot.lang),
fl AS MATERIALIZED (SELECT lang, {_LOG.replace("NUMBER", "0")} AS floor FROM tot, num),
{_scores_sql("own", f"SELECT doc_id, lang AS named, {_PLAIN} AS t FROM documents WHERE doc_id % 4 <> 2 AND text IS NOT NULL AND lang IS NOT NULL", "doc_id, named")},
me AS (SELECT of AS lang, CAST(floor(CAST(score * 1000 AS DOUBLE) / n) AS BIGINT) AS mean, count(*) AS c FROM own WHERE of = named GROUP BY ALL),
cu AS (SELECT lang, mean, sum(c) OVER (PARTITION BY lang ORDER BY mean) AS so_far, sum(c) OVER (PARTITION BY lang) AS every FROM me),
le AS (SELECT lang, min(mean) AS least FROM cu WHERE so_far > floor(every * {langmodel.REJECT_THOUSANDTHS} / 1000.0) GROUP BY lang),
{_scores_sql("held", f"SELECT doc_id, line, {_PLAIN} AS t FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(0, len(string_split(text, chr(10))))) AS line FROM documents WHERE doc_id % 4 = 2)", "doc_id, line")},
b AS (SELECT doc_id, line, of, score, n, row_number() OVER (PARTITION BY doc_id, line ORDER BY score DESC, of) AS r FROM held)
SELECT doc_id, CAST(line AS INTEGER) AS line, CASE WHEN score * 1000 >= least * n THEN of END AS lang, CAST(score AS BIGINT) AS score, CAST(n AS BIGINT) AS n FROM b JOIN le ON le.lang = b.of WHERE r = 1"""
)
def language_model(spark: SparkSession, d: str) -> DataFrame:
    """A language model trained on three of four documents by their language, and the language of every line of the others."""
    docs = _t(spark, d, "documents")
    model = langmodel.trained(docs.filter("doc_id % 4 <> 2").select(F.col("doc_id").alias("id"), "lang", "text"), lambda df: stored(df, "language"))
    lines = docs.filter("doc_id % 4 = 2").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return model.classified(lines, ["doc_id", "line"])


@query(
    f"""WITH md AS (SELECT conv_id, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn, text), '') AS text FROM conversations GROUP BY conv_id),
{_langid("doc", "md", "conv_id")},
bl AS (SELECT conv_id, unnest(b) AS block, unnest(range(1, len(b) + 1)) AS i FROM (SELECT conv_id, string_split_regex(text, '\\n\\s*\\n') AS b FROM md)),
pl AS (SELECT conv_id, i, block, trim(regexp_replace(regexp_replace(regexp_replace(block, '[*_`~]+', ' ', 'g'), '(?m)^\\s*(#{{1,6}}|[-*+]|\\d+\\.)\\s+', '', 'g'), '\\s+', ' ', 'g')) AS text FROM bl),
{_langid("para", "pl", "conv_id, i", 0)},
kp AS (
  SELECT conv_id, i, block, doc.detected AS lang, doc.detected IS NULL OR NOT regexp_matches(block, '\\S') OR len(list_filter(string_split(block, chr(10)), lambda s: regexp_matches(s, {_ST}))) > 0
    OR len(regexp_extract_all(pl.text, '{fixed.LETTERS}')) <= {fixed.FOREIGN_LETTERS} OR para.detected IS NULL OR para.detected = doc.detected AS keep
  FROM pl JOIN para USING (conv_id, i) JOIN doc USING (conv_id))
SELECT conv_id, any_value(lang) AS lang, count(*) FILTER (NOT keep) AS dropped,
  CASE WHEN count(*) FILTER (NOT keep) > 0 THEN coalesce(string_agg(block, chr(10) || chr(10) ORDER BY i) FILTER (keep), '') ELSE any_value(md.text) END AS md
FROM kp JOIN md USING (conv_id) GROUP BY conv_id"""
)
def foreign_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "conversations").groupBy("conv_id").agg(pages.ordered_concat("turn", "text", "\n\n").alias("md"))
    return blocks.filter_foreign(docs.withColumn("lang", detect(F.col("md"))), "lang", lambda c: detect(c, 0)).select("conv_id", "lang", "dropped", "md")


# ---------------------------------------------------------------- summaries

_CLEAN = """c1 AS (SELECT page_id, html || chr(10) || '## Head' || chr(10) || '* item `x`' || chr(10) || '(1999).' || chr(10) || '| a | b |' || chr(10) || 'Downloaded from x' || chr(10) || chr(10) || chr(10) || chr(10) || '1. one [l](u) ![i](p)' AS t FROM pages),
c2 AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(t, chr(173), ''), '(?s)<!--.*?-->', ' ', 'g'), '(?s)```.*?```', ' ', 'g'), '!\\[[^\\]]*\\]\\([^)]*\\)', ' ', 'g'), '\\[([^\\]]+)\\]\\([^)]*\\)', '\\1', 'g'), '<[^>]+>', ' ', 'g'), 'https?://\\S+', ' ', 'g') AS t FROM c1),
c3 AS (SELECT page_id, list_transform(string_split(t, chr(10)), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')) AS l FROM c2),
c4 AS (SELECT page_id, list_filter(l, lambda s: NOT regexp_matches(s, '^\\|.*\\|\\s*$|^\\||^---|^===|^\\*\\*\\*|^___')) AS l FROM c3),
c5 AS (SELECT page_id, list_transform(l, lambda s: regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '^\\s*#{1,6}\\s+', ''), '^[*\\-+>]\\s+', ''), '^\\d+\\.\\s+', ''), '[`*_]+', '', 'g'), '^\\s+|\\s+$', '', 'g')) AS l FROM c4),
c6 AS (SELECT page_id, list_filter(l, lambda s: s = '' OR NOT (regexp_matches(s, '^\\s*\\(?\\d{4}\\)?[\\s.,;:]*$') OR regexp_matches(lower(s), 'BOILERPLATE_PARTS'))) AS l FROM c5),
c7 AS (SELECT page_id, regexp_replace(regexp_replace(array_to_string(l, chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS plain FROM c6)"""


def _page_markdown(spark: SparkSession, d: str) -> DataFrame:
    tail = "\n## Head\n* item `x`\n(1999).\n| a | b |\nDownloaded from x\n\n\n\n1. one [l](u) ![i](p)"
    return _t(spark, d, "pages").select("page_id", F.concat("html", F.lit(tail)).alias("md"))


@query(f"WITH {_CLEAN} SELECT page_id, plain FROM c7")
def strip_markdown(spark: SparkSession, d: str) -> DataFrame:
    return _page_markdown(spark, d).select("page_id", summarize.strip_markdown(F.col("md")).alias("plain"))


_SENTENCES = f"""{_CLEAN}, s1 AS (SELECT page_id, list_filter(list_transform(string_split(plain, chr(10) || chr(10)), lambda p: trim(regexp_replace(p, '\\s+', ' ', 'g'))), lambda p: p <> '') AS p FROM c7),
s2 AS (SELECT page_id, list_filter(list_transform(flatten(list_transform(p, lambda x: string_split(regexp_replace(x, '([.!?]) +([A-Za-z"''])', '\\1' || chr(1) || '\\2', 'g'), chr(1)))), lambda s: trim(s)), lambda s: s <> '') AS s FROM s1),
s3 AS (SELECT page_id, list_filter(s, lambda x: length(x) BETWEEN 40 AND 600 AND len(regexp_extract_all(x, '[A-Za-z]')) >= 15 AND len(regexp_extract_all(x, '[A-Za-z]')) * 4 >= length(x) AND len(regexp_extract_all(x, '[0-9]')) / length(x) <= 0.35 AND NOT regexp_matches(lower(x), 'BOILERPLATE_PARTS')) AS c FROM s2)"""


@query(f"WITH {_SENTENCES} SELECT page_id, CAST(unnest(range(0, len(s))) AS INTEGER) AS sent_no, unnest(s) AS text FROM s2")
def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    s = summarize.split_sentences(summarize.strip_markdown(F.col("md")), fixed.SCRIPTS["latin"])
    return _page_markdown(spark, d).select("page_id", F.posexplode(s).alias("sent_no", "text"))


@query(f"WITH {_SENTENCES} SELECT page_id, CAST(unnest(range(0, len(c))) AS INTEGER) AS sent_no, unnest(c) AS text FROM s3")
def candidate_sentences(spark: SparkSession, d: str) -> DataFrame:
    return _page_markdown(spark, d).select("page_id", F.posexplode(summarize.candidates(F.col("md"), "latin")).alias("sent_no", "text"))


@query("SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda s: regexp_matches(lower(s), 'BOILERPLATE_PARTS'))) AS BIGINT) AS hits FROM documents")
def boilerplate_hits(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", F.size(F.filter(F.split("text", "\n"), lambda s: text.contains_any(s, fixed.BOILERPLATE))).cast("long").alias("hits"))


@query(f"WITH {_SENTENCES} SELECT page_id, array_to_string(list_transform(list_filter(range(1, least(3, len(c)) + 1), lambda i: NOT list_contains(c[1:i - 1], c[i])), lambda i: c[i]), ' ') AS summary FROM s3")
def summary_lead3(spark: SparkSession, d: str) -> DataFrame:
    return _page_markdown(spark, d).select("page_id", summarize.lead_summary(summarize.candidates(F.col("md"), "latin")).alias("summary"))


@query()
def summary_lsa(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", summarize.lsa_summary(summarize.candidates(F.col("text"), "latin")).alias("summary"))


_FRESH = f"""{_ENTRIES}, x AS (SELECT *, CASE WHEN tr = 'done' THEN 'translated_md/' || doc_id || '.he.md' WHEN tr = 'already_hebrew' AND s1 = 'done' THEN 'step1_md/' || doc_id || '/a b.md' END AS src,
 doc_id % 5 = 0 AND doc_id % 10 = 0 AND (CASE WHEN doc_id % 3 = 0 THEN 'translated_md/' || doc_id || '.he.md' ELSE CASE WHEN s1 IS NOT NULL OR true THEN 'step1_md/' || doc_id || '/a b.md' END END) = (CASE WHEN tr = 'done' THEN 'translated_md/' || doc_id || '.he.md' WHEN tr = 'already_hebrew' AND s1 = 'done' THEN 'step1_md/' || doc_id || '/a b.md' END) AND doc_id % 7 = doc_id % 11 AS fresh0 FROM e),
o AS (SELECT doc_id, CASE WHEN src IS NULL OR doc_id % 13 = 0 THEN 'skipped' WHEN coalesce(fresh0, false) THEN 'cached' WHEN doc_id % 17 = 0 THEN 'empty' ELSE 'summarized' END AS outcome FROM x)"""


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    df = _entries(spark, d).withColumn("src", summarize.source_of(F.col("step1"), F.col("translation_md")))
    df = df.withColumn("fp", F.when(n % 13 != 0, F.struct((n % 11).alias("size"), F.lit(5).cast("long").alias("mtime"))))
    fresh = summarize.is_fresh(F.col("summary"), F.col("src"), F.col("fp"))
    return df.select("doc_id", summarize.outcome(F.col("src"), F.col("fp"), fresh, F.when(n % 17 == 0, "").otherwise("text")).alias("outcome"))


@query(f"WITH {_FRESH} SELECT doc_id, outcome FROM o")
def summary_freshness(spark: SparkSession, d: str) -> DataFrame:
    return _outcomes(spark, d)


@query(f"WITH {_FRESH} SELECT outcome, count(*) AS n FROM o GROUP BY 1")
def summary_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return summarize.outcome_counts(_outcomes(spark, d))


# ---------------------------------------------------------------- index


@query(f"WITH {_ENTRIES} SELECT count(*) AS total, count(*) FILTER (tr = 'done') AS translated, count(*) FILTER (tr = 'already_hebrew') AS already, count(*) FILTER (tr = 'error') AS errors, count(*) FILTER (s1 IS NOT NULL AND doc_id % 4 = 0) AS ocr, count(*) FILTER (doc_id % 10 = 0) AS summaries, count(*) - count(*) FILTER (tr IN ('done', 'already_hebrew', 'error')) AS pending FROM e")
def index_counters(spark: SparkSession, d: str) -> DataFrame:
    return report.counters(_entries(spark, d))


_PILLS = """CASE WHEN s1 IS NULL THEN '<span class="pill pending">לא הופעל</span>' WHEN s1 = 'done' THEN '<span class="pill ok">done</span>' ELSE '<span class="pill err" title="bad &lt;' || lang || '&gt;">error</span>' END"""
_PILLT = """CASE WHEN tr IS NULL THEN '<span class="pill pending">לא הופעל</span>' WHEN tr = 'error' THEN '<span class="pill err" title="No &amp; no">error</span>' ELSE '<span class="pill ok">' || tr || '</span>' END"""


@query(f"WITH {_ENTRIES} SELECT doc_id, {_PILLS} AS step1, {_PILLT} AS translation FROM e")
def status_pills(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).select("doc_id", report.status_pill(F.col("step1"), ("done",)).alias("step1"), report.status_pill(F.col("translation_md"), ("done", "already_hebrew")).alias("translation"))


@query(
    f"""WITH {_ENTRIES} SELECT name AS original_name, sha256 || doc_id AS sha256, '<tr><td><a href="to_translate/' || name || '">' || name || '</a><div class="sha">' || sha256[1:8] || '</div></td>'
 || CASE WHEN doc_id % 10 = 0 THEN '<td class="summary-cell"><div class="summary-text" lang="he" dir="rtl">About ' || name || '</div><div class="summary-meta" title="' || CASE WHEN doc_id % 3 = 0 THEN 'מתוך התרגום לעברית' ELSE 'מתוך המקור העברי' END || ' · 2026-01-03 00:00:00">' || CASE WHEN doc_id % 3 = 0 THEN 'מתוך התרגום לעברית' ELSE 'מתוך המקור העברי' END || '</div></td>' ELSE '<td class="summary-cell"><span class="missing">—</span></td>' END
 || '<td>' || CASE WHEN s1 IS DISTINCT FROM 'done' THEN '—' WHEN doc_id % 3 = 1 THEN '<span class="missing" title="missing on disk">Markdown (אנגלית)</span>' ELSE '<a href="step1_md/' || doc_id || '/a%20b.md">Markdown (אנגלית)</a>' END || '</td>'
 || '<td>' || CASE WHEN tr IS DISTINCT FROM 'done' THEN '—' ELSE '<span class="missing" title="missing on disk">Markdown (עברית)</span>' END || '</td>'
 || '<td class="num">' || (doc_id % 9) || '</td><td>' || CASE WHEN doc_id % 2 = 0 THEN 'לא' WHEN s1 IS NOT NULL AND doc_id % 3 > 0 THEN 'כן (' || (doc_id % 3) || ')' ELSE 'כן' END || '</td><td>' || lang || '</td><td>'
 || CASE WHEN s1 IS NOT NULL AND doc_id % 4 = 0 THEN '<span class="pill warn" title="text-layer chars=' || length(text) || '">OCR</span>' ELSE '—' END || '</td><td>' || {_PILLS} || '<div class="when">' || CASE WHEN s1 IS NULL THEN '—' ELSE '2026-01-01 00:00:00' END || '</div></td><td>' || {_PILLT} || '<div class="when">' || CASE WHEN tr IS NULL THEN '—' ELSE '2026-01-02 00:00:00' END || '</div></td></tr>' AS row FROM e"""
)
def index_rows(spark: SparkSession, d: str) -> DataFrame:
    df = _entries(spark, d)
    listed = df.select(F.concat(F.lit("to_translate/"), "original_name").alias("path")).unionByName(df.filter("doc_id % 3 <> 1").select(F.concat(F.lit("step1_md/"), F.col("doc_id").cast("string"), F.lit("/a b.md")).alias("path")))
    return report.index_rows(df, listed)
