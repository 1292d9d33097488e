"""Secret scans by an incremental blob ledger; DataFrame functions only.

Every version of every path is content-addressed (SHA-256 of its text). The ledger, a folder of Parquet tables,
knows which (blob, rule version) pairs were scanned and what was found; a scan takes one representative of
each blob and runs only the rules that its ledger entry lacks. A rule's version is the hash of its
definition, so a changed rule is scanned anew. Findings are joined back to all paths and versions that hold the blob.

What is shuffled: keys, hashes and, by row key, the texts to scan. Where few blobs are due, the join that picks
them comes first (Spark broadcasts them if they are small) and seen texts meet no rule; where most are due, as in a first scan, a
screen for any match at all runs before the join, so that texts without one aren't shuffled. Copies share one scan. The
findings are written before the pairs are marked as scanned, so a run that is lost between the two is repeated, and
readers drop the repeated findings.

Offsets are code points, end exclusive. Base rules keep their own leftmost non-overlapping matches; the further
rules (jwt, pem) add spans and never remove one.

Defined results: a null text is an empty one; empty texts have no spans; repeated rows give a row each; an empty
table gives no rows; a null key is a key like any other; other columns of the table are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_path, stored, table

_WORDS = "(?i:password|passwd|secret|token|api_?key)"
_ASSIGN = _WORDS + r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = "[A-Za-z0-9+/_.=-]+"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, kept where what follows ``lead`` in them has ``least`` characters or more."""

    kind: str
    pattern: str
    lead: str = ""
    least: int = 0

    @property
    def version(self) -> str:
        return hashlib.sha256(repr(self).encode()).hexdigest()[:16]

    def keep(self, match: Column) -> Column:
        return F.length(F.regexp_replace(match, f"^{self.lead}", "")) >= self.least


#: Runs that are too short fall with their whole run in access and hex, so those patterns ask for the length at once.
BASE = (
    Rule("assign", f"(?=[AaPpSsTt]){_ASSIGN}{_VALUE}", _ASSIGN, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
FURTHER = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + FURTHER
_SCANNED, _FINDINGS = "blob string, rule_version string", "blob string, rule_version string, kind string, start int, end int"


def _ledger(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return spark.read.schema(schema).parquet(f"{path}/{name}").dropDuplicates()
    return spark.createDataFrame([], schema)


def address(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and blob hash of every row."""
    return versions.select(*keys, F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("blob"))


def matches(texts: DataFrame, rules: tuple[Rule, ...], early: bool = True) -> DataFrame:
    """(blob, rule_version, kind, start, end) of texts (blob, text, todo): todo has the rule versions to run.
    early: the screen for any match may run below the join that made texts; else it sees joined rows only."""
    found = []
    for r in rules:
        due = F.array_contains("todo", r.version) & F.col("text").rlike(r.pattern)
        pairs = F.arrays_zip(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)).alias("hit"), F.split("text", r.pattern, -1).alias("gap"))
        pairs = F.filter(pairs, lambda p: p["hit"].isNotNull())
        found.append(F.when(due, F.transform(pairs, lambda p: F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version"), F.length(p["gap"]).alias("gap"), F.length(p["hit"]).alias("n"), r.keep(p["hit"]).alias("keep")))))
    any_rule = "|".join(f"(?:{r.pattern})" for r in rules)
    screen = F.col("text").rlike(any_rule)
    parts = texts.filter(screen if early else (F.size("todo") > 0) & F.when(F.size("todo") > 0, screen)).select("blob", F.explode(F.array_compact(F.array(*found))).alias("one"))
    rows = parts.select("blob", F.posexplode("one").alias("i", "m")).select("blob", "i", "m.*")
    upto = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.repartition("blob").dropDuplicates(["blob", "kind", "i"]).withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto).cast("int"))
    return ends.filter("keep").select("blob", "rule_version", "kind", (F.col("end") - F.col("n")).alias("start"), "end")


def scan(versions: DataFrame, keys: list[str], ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Brings the ledger up to date with versions (keys, text) and returns (keys, blob, spans): spans is an array
    of (start, rank, kind, end) in order, null where a blob has none; rank is the rule's place in rules."""
    spark = versions.sparkSession
    versions = versions.select(*keys, F.col("text").cast("string").alias("text"))
    paths = stored(address(versions, keys), "paths")
    all_rules = F.array(*(F.lit(r.version) for r in rules))
    seen = _ledger(spark, ledger, "scanned", _SCANNED).groupBy("blob").agg(F.collect_set("rule_version").alias("seen"))
    blobs = paths.groupBy("blob").agg(F.min(F.struct(*keys)).alias("at")).join(seen, "blob", "left")
    todo = blobs.select("blob", "at", F.array_except(all_rules, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo")).filter(F.size("todo") > 0)
    todo = stored(todo, "todo")
    on = [versions[k].eqNullSafe(todo[f"at.{k}"]) for k in keys]
    texts = versions.join(todo, on).select("blob", F.coalesce("text", F.lit("")).alias("text"), "todo")
    texts = texts.filter(F.sha2("text", 256) == F.col("blob"))  # a key that repeats with other texts
    first = 2 * todo.count() >= blobs.count()  # most is new: rows without any match may go before the join
    matches(texts, rules, first).write.mode("append").parquet(f"{ledger}/findings")
    todo.select("blob", F.explode("todo").alias("rule_version")).write.mode("append").parquet(f"{ledger}/scanned")
    order = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.version), F.lit(i))))
    spans = _ledger(spark, ledger, "findings", _FINDINGS).withColumn("rank", order[F.col("rule_version")]).filter("rank is not null")
    spans = spans.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))
    return paths.join(spans, "blob", "left")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = scan(docs, ["doc_id"], shared_path(spark, "ledger"))
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", spans.alias("spans")).select("doc_id", *(count(r.kind) for r in BASE), F.sha2(_joined(F.filter("spans", lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def _sql() -> str:
    lists = []
    for i, r in enumerate(RULES):
        pattern = r.pattern.replace("(?=[AaPpSsTt])", "").replace("'", "''")
        lead = r.lead.replace("'", "''")
        lists.append(
            f"SELECT doc_id, {i} AS rank, '{r.kind}' AS kind, regexp_extract_all(text, '{pattern}', 0) AS hits, regexp_split_to_array(text, '{pattern}') AS gaps, '^{lead}' AS lead, {r.least} AS least FROM d WHERE regexp_matches(text, '{pattern}')"
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(lists)}),
p AS (SELECT doc_id, rank, kind, hits, gaps, lead, least, unnest(range(1, len(hits) + 1)) AS i FROM m),
q AS (SELECT doc_id, rank, kind, hits[i] AS hit, lead, least,
             CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start FROM p),
s AS (SELECT doc_id, rank, kind, start, start + length(hit) AS stop FROM q
      WHERE CASE kind WHEN 'assign' THEN length(regexp_replace(hit, lead, '')) >= least ELSE true END),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS base,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


OP1_SQL = _sql()
