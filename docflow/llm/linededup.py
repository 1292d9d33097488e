"""Line dedup by an exact set-similarity join; DataFrame functions only.

A line is the part of a text between line breaks; its tokens are its distinct shingles of ``k`` words (the whole line, if
shorter), in lower case. A line goes if an earlier line, in order of (doc_id, text hash, line number), has a Jaccard similarity of
``percent`` or more with it. A line without words never goes.

1. Lines of equal words form an identity; only its first occurrence can stay. Texts are read for this once; the identities are
   stored with their words, and every later step reads those, so that copies of a line cost nothing from here on.
2. Lines that match share two (where a set can match with one token: one) of their first n - ceil(n * percent / 100) + 2 tokens,
   in any order of tokens that all lines keep. Only these are shuffled; where they meet, a token's lines are counted and its earliest
   is told, and tokens that one identity alone has are dropped. The first order is that of the tokens' hashes. Tokens that many lines
   have are given up there; a pair whose first two in common are not both left has such a token on either line, so all lines that
   have one among their first tokens meet once more, in order of rarity, from counts of all their tokens in 2**16 buckets.
3. What meets passes the length filter and the positional filter (the tokens left after the shared one must suffice).
   First every line is held against the earliest line of each of its tokens, which makes no pairs within a
   group; lines that match it are decided. Only the others are joined with the earlier lines of their tokens; where they share
   few tokens, with those of lists of over LONG_LIST lines by pairs of tokens, the shared one and one after it, as lines that match
   share both. Pairs that meet by one token only, where two are shared by all that match, go.
4. Candidates are verified on their whole token sets.
5. Lines of a text that have words and aren't the kept occurrence of an identity go.

In the first order a token's rows are gathered by one task, however many (they are counted there, and make no pairs). In that by
rarity a token whose bucket holds over 16 times the mean is dealt out by salts; its earliest line and its count come from a sum over the salts' rows, and joins on tokens and lines are plain equality joins, which Spark splits where a key is
hot. A shingle's hash runs over its words' hashes, so that no shingle is ever made as a text.

Sizes: the counters are a fixed 65,536; lines that take part in candidates are broadcast only if counted to be few
(BROADCAST_ROWS). Shuffle files of a step are let go once its result is stored, so that disk holds those of one large step at a time. Identities are told apart by 128 bits, tokens by 64 (their order by 56, meetings by 41 and the level).

Defined results: a null text has no lines and stays null; an empty text has one line without words; rows with the same
doc_id and text get the same decision, as one; a null doc_id comes last; an empty table gives no rows; other columns, whatever their
names, are ignored by kept_lines() and kept by deduplicated().
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

WORDS = 5
PERCENT = 80
BROADCAST_ROWS = 250_000
#: Tokens of lists of over LONG_LIST lines are left to the order by rarity; there, lines that share at most FEW_SHARED tokens meet those
#: of such lists by pairs of tokens.
LONG_LIST, FEW_SHARED = 64, 4
#: Level (quarter octaves above the mean) from which a bucket's tokens are dealt out by SALTS.
HOT_LEVEL, SALTS = 17, 64
_BLANKS = " \t\x0b\x0c\r"


def _own() -> list[Column]:
    """A row's place among documents: no_id (null ids come last), doc, th."""
    doc = F.col("doc_id").cast("long")
    return [doc.isNull().alias("no_id"), F.coalesce(doc, F.lit(0)).alias("doc"), F.xxhash64(F.col("text").cast("string")).alias("th")]


def _lines(docs: DataFrame) -> DataFrame:
    """(no_id, doc, th, line, s) of every line, in lower case with one blank between words; s is empty where it has none."""
    whole = docs.select(*_own(), F.lower(F.col("text").cast("string")).alias("text"))  # before the lines, else each would hash its whole text
    raw = whole.select("no_id", "doc", "th", F.posexplode_outer(F.split("text", "\n")).alias("line", "s"))
    s = F.col("s")
    odd = s.contains("  ") | s.startswith(" ") | s.endswith(" ")
    for blank in _BLANKS[1:]:
        odd = odd | s.contains(blank)
    plain = F.when(odd, F.btrim(F.regexp_replace(s, r"[\x20\x09-\x0D]+", " "))).otherwise(s)
    return raw.withColumn("s", plain)


def identities(docs: DataFrame) -> DataFrame:
    """(h1, h2, at, s): the lines of different words, each with the place (no_id, doc, th, line) of its first occurrence."""
    own = _lines(docs).select(F.xxhash64("s").alias("h1"), F.xxhash64(F.lit(1), "s").alias("h2"), F.struct("no_id", "doc", "th", "line", "s").alias("at"))
    first = own.groupBy("h1", "h2").agg(F.min("at").alias("at")).filter("at.s <> ''")  # above, a filter would work s out twice
    return stored(first.select("h1", "h2", F.struct("at.no_id", "at.doc", "at.th", "at.line").alias("at"), F.col("at.s").alias("s")), "identities", compression="zstd")


def _bound(value: Column, of) -> Column:
    """of(value), with value worked out once and held as it is, not packed into a row from which each use would read it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _places(words: Column, k: int) -> Column:
    """Where shingles begin: one at least."""
    return F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0)))


def _shingles(s: Column, k: int) -> Column:
    """The hashes of a line's shingles, in their order: of k words' hashes from each place on, or of all, where there are fewer."""
    hashes = F.transform(F.split(s, " "), lambda w: F.xxhash64(w))
    return _bound(hashes, lambda h: F.transform(_places(h, k), lambda place: F.xxhash64(*(F.get(h, place + i) for i in range(k)))))


def _tokens(lines: DataFrame, k: int) -> DataFrame:
    """lines with tokens, the distinct hashes of a line's shingles, in place of s."""
    return lines.select(*(c for c in lines.columns if c != "s"), F.array_distinct(_shingles(F.col("s"), k)).alias("tokens"))


def _shingle_rows(lines: DataFrame, k: int) -> DataFrame:
    """(t) of every shingle of every line, the same hashes in rows, for which Spark makes code."""
    words = F.col("words")
    cut = lines.select(F.explode_outer(F.array(F.split("s", " "))).alias("words"))  # exploded so that they are cut once, not in each use
    word = lambda place: F.when(place < F.size(words), F.xxhash64(F.get(words, place)))
    return cut.select(words, F.explode_outer(_places(words, k)).alias("place")).select(F.xxhash64(*(word(F.col("place") + i) for i in range(k))).alias("t"))


def levels(lines: DataFrame, k: int) -> list[int]:
    """For each of 65,536 buckets of tokens how frequent it is, in quarter octaves above the mean, below 128."""
    count = _shingle_rows(lines, k).groupBy(F.shiftrightunsigned("t", 48).cast("int").alias("bucket")).count().collect()
    mean = max(1.0, sum(r["count"] for r in count) / (1 << 16))
    out = [0] * (1 << 16)
    for r in count:
        out[r["bucket"]] = min(127, round(4 * math.log2(1 + r["count"] / mean)))
    return out


def _least(n: Column, percent: int) -> Column:
    """What a set of n tokens shares at least with one that it matches."""
    return F.ceil(n * percent / 100).cast("int")


def _met(n: Column, pos: Column, m: Column, other: Column, percent: int) -> tuple[Column, Column, Column]:
    """Of a token at pos among the n of one line and at other among the m of another: whether the lines may match if it is the
    second that they share or an earlier one, whether they may if it is the first, and what it counts for: 2 where one can do."""
    least = F.ceil((n + m) * percent / (100 + percent))
    left = F.least(n - pos, m - other)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (left >= least - 1), left >= least, F.when(least < 2, 2).otherwise(1)


def _posted(lines: DataFrame, keys: Column, percent: int) -> DataFrame:
    """(doc, h1, place, token) of the first tokens of every line in order of keys; a null id counts as the largest."""
    doc = F.when(F.col("at.no_id"), F.lit((1 << 63) - 1)).otherwise(F.col("at.doc"))
    ranked = lines.select("h1", doc.alias("doc"), F.sort_array(F.array_distinct(keys)).alias("sorted"))
    n = F.size("sorted")
    first = ranked.select("h1", "doc", n.alias("n"), F.posexplode_outer(F.slice("sorted", F.lit(1), F.least(n, n - _least(n, percent) + 2))).alias("pos", "token"))
    # what is shuffled is kept short: a token's first 48 bits (two that share them make candidates, no results), n and pos in one
    place = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("pos").cast("long")).alias("place")
    return first.select("doc", "h1", place, F.shiftrightunsigned("token", 16).alias("token"))


def _of_place(place: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(place, 32).cast("int").alias("n"), place.bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos")


def _gathered(posted: DataFrame, key: str, alone: Column) -> DataFrame:
    """(token, h1, doc, n, pos, lines, pivot): with each row how many have its key, and the earliest of them. Rows that have
    theirs alone are dropped, but for those of which alone is true."""
    slot = Window.partitionBy(key)
    # most have theirs alone, and go before any are compared
    met = posted.select("*", F.count("*").over(slot).alias("lines")).filter(alone | (F.col("lines") > 1)).select("*", F.min(F.struct("doc", "h1", "place")).over(slot).alias("pivot"))
    pivot = F.struct("pivot.doc", "pivot.h1", *_of_place(F.col("pivot.place"))).alias("pivot")
    return met.select("token", "h1", "doc", *_of_place(F.col("place")), "lines", pivot)


def meetings(lines: DataFrame, k: int, percent: int) -> DataFrame:
    """(token, h1, doc, n, pos, lines, pivot) of the first tokens that lines share: lines is how many have the token, pivot
    (doc, h1, n, pos) the earliest (by document) of them. Lines with a token that over LONG_LIST have meet by their rarest tokens instead of by those."""
    met = stored(_gathered(_posted(lines, _shingles(F.col("s"), k), percent), "token", F.lit(False)), "met")
    often = F.col("lines") > LONG_LIST
    again = stored(met.filter(often).select("h1").distinct(), "again")
    some = stored(lines.join(_few(again), "h1", "left_semi").select("h1", "at", "s"), "lines-again", compression="zstd")
    return met.filter(~often).unionByName(_rarest(some, k, percent))


def _rarest(lines: DataFrame, k: int, percent: int) -> DataFrame:
    """What meetings() has, of the first tokens by rarity. Bit 48 is set in these tokens, so that they meet none of the other order."""
    by_bucket = F.split(F.lit(",".join(map(str, levels(lines, k)))), ",").cast("array<bigint>")
    level = lambda t: F.get(by_bucket, F.shiftrightunsigned(t, 48).cast("int"))
    # never null, so that keys are sorted as plain numbers
    key = lambda t: F.coalesce(F.shiftleft(level(t), 56).bitwiseOR(F.shiftrightunsigned(t, 8)), F.lit(0).cast("long"))
    # made distinct once they are keys: Spark makes code of what lies around functions over arrays, not of what lies within
    posted = _posted(lines, F.transform(_shingles(F.col("s"), k), key), percent).withColumn("token", F.col("token").bitwiseOR(F.lit(1 << 48)))
    hot = F.shiftrightunsigned("token", 40).bitwiseAND(F.lit(255)) >= HOT_LEVEL
    dealt = posted.withColumn("slot", F.when(hot, F.xxhash64("token", F.pmod("h1", F.lit(SALTS)))).otherwise(F.col("token")))
    met = stored(_gathered(dealt, "slot", hot), "met-again")
    lists = stored(met.filter(hot).groupBy("token").agg(F.count("*").alias("lines"), F.min("pivot").alias("pivot")).filter("lines > 1"), "hot-lists")
    return met.filter(~hot).unionByName(stored(met.filter(hot).drop("lines", "pivot").join(_few(lists), "token"), "met-hot"))


def _few(rows: DataFrame) -> DataFrame:
    """rows, a stored table, for a join: broadcast only if counted to be few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _verified(pairs: DataFrame, lines: DataFrame, k: int, percent: int) -> DataFrame:
    """(h1, h2) of the later identity of every pair (a, b) of h1 that matches. pairs has rows (a, b, first, weight) of tokens that
    they share: those of a pair that matches weigh 2, and one may be the first."""
    together = pairs.groupBy("a", "b").agg(F.sum("weight").alias("weight"), F.max("first").alias("first"))
    pairs = stored(together.filter((F.col("weight") > 1) & F.col("first")).select("a", "b"), "pairs")
    some = stored(pairs.select(F.col("a").alias("h1")).union(pairs.select("b")).distinct(), "lines-of-pairs")
    sets = stored(_tokens(lines.join(_few(some), "h1", "left_semi").select("h1", "h2", "at", "s"), k), "line-sets")
    side = lambda x: sets.select(*(F.col(c).alias(f"{x}_{c}") for c in sets.columns))
    both = pairs.join(side("a"), F.col("a") == F.col("a_h1")).join(side("b"), F.col("b") == F.col("b_h1"))
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    match = both.filter(100 * common >= percent * (F.size("a_tokens") + F.size("b_tokens") - common))
    later = F.when(F.col("a_at") > F.col("b_at"), F.struct(F.col("a_h1").alias("h1"), F.col("a_h2").alias("h2"))).otherwise(F.struct(F.col("b_h1").alias("h1"), F.col("b_h2").alias("h2")))
    return stored(match.select(later.alias("l")).select("l.*").distinct(), "later")


def _others(met: DataFrame, rest: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b, first, weight) of a line of rest, which isn't decided, and one of an earlier or the same document that it shares tokens with."""
    few = rest.groupBy("h1").agg(F.count("*").alias("q"), F.max("lines").alias("most")).filter((F.col("most") > LONG_LIST) & (F.col("q") <= FEW_SHARED))
    few = _few(stored(few.select("h1"), "few-shared"))
    own = rest.join(few, "h1", "left_semi")
    columns = ("token", "h1", "doc", "n", "pos")
    named = lambda rows, x, *more: rows.select(*(F.col(c).alias(f"{x}_{c}") for c in (*columns, *more)))
    may, first, weight = _met(F.col("a_n"), F.col("a_pos"), F.col("b_n"), F.col("b_pos"), percent)
    fits = (F.col("b_doc") <= F.col("a_doc")) & (F.col("a_h1") != F.col("b_h1")) & may
    # a line that meets by pairs of tokens may have the second of those it shares in a long list: its others count for two
    alone = rest.join(few, "h1", "left_anti").withColumn("weight", F.lit(1)).unionByName(own.filter(F.col("lines") <= LONG_LIST).withColumn("weight", F.lit(2)))
    found = named(alone, "a", "weight").join(named(met, "b"), (F.col("a_token") == F.col("b_token")) & fits)
    # tokens of long lists, each with those after it on the same line; with itself where one shared token can do
    after = lambda rows: rows.select(F.col("h1").alias("own"), F.col("pos").alias("next"), F.col("token").alias("second"))
    ordered = (F.struct("next", "second") > F.struct("pos", "token")) | ((F.col("second") == F.col("token")) & (_least(F.col("n"), percent) < 2))
    pairs_of = lambda rows, all_of: rows.join(after(all_of), (F.col("h1") == F.col("own")) & ordered).drop("own", "next")
    mine = stored(pairs_of(own.filter(F.col("lines") > LONG_LIST), rest), "token-pairs")
    tokens = stored(mine.select("token").distinct(), "long-lists")
    seconds = stored(mine.select("second").distinct().withColumnRenamed("second", "token"), "seconds")
    theirs = pairs_of(met.join(_few(tokens), "token", "left_semi"), met.join(_few(seconds), "token", "left_semi"))
    found_too = named(mine, "a", "second").join(named(theirs, "b", "second"), (F.col("a_token") == F.col("b_token")) & (F.col("a_second") == F.col("b_second")) & fits)
    pair = (F.col("a_h1").alias("a"), F.col("b_h1").alias("b"), first.alias("first"))
    return found.select(*pair, F.greatest(F.col("a_weight"), weight).alias("weight")).unionByName(found_too.select(*pair, F.lit(2).alias("weight")))


def kept_lines(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(no_id, doc, th, kept): per document the numbers of the lines with words that stay, in no order; no row where none does."""
    lines = identities(docs)
    met = meetings(lines, k, percent)
    may, first, weight = _met(F.col("n"), F.col("pos"), F.col("pivot.n"), F.col("pivot.pos"), percent)
    star = met.filter((F.col("h1") != F.col("pivot.h1")) & may).select(F.col("h1").alias("a"), F.col("pivot.h1").alias("b"), first.alias("first"), weight.alias("weight"))
    later = _verified(star, lines, k, percent)
    decided = stored(later.select("h1").distinct(), "decided")
    later = stored(later.unionByName(_verified(_others(met, stored(met.drop("pivot").join(_few(decided), "h1", "left_anti"), "undecided"), percent), lines, k, percent)).distinct(), "all-later")
    stays = lines.select("h1", "h2", "at").join(_few(later), ["h1", "h2"], "left_anti").select("at.*")
    return stored(stays.groupBy("no_id", "doc", "th").agg(F.collect_list("line").alias("kept")), "kept-lines")


def _with_kept(rows: DataFrame, docs: DataFrame, **options) -> DataFrame:
    """rows, which have no_id, doc and th, with kept."""
    return rows.join(kept_lines(docs, **options), ["no_id", "doc", "th"], "left")


def _split() -> Column:
    return F.split(F.col("text").cast("string"), "\n")


def _worded() -> Column:
    """Numbers of a text's lines that have words."""
    return F.filter(F.sequence(F.lit(0), F.size("parts") - 1), lambda i: F.btrim(F.get("parts", i), F.lit(_BLANKS + "\n")) != "")


def _gone() -> Column:
    return F.coalesce(F.array_except("worded", F.coalesce("kept", F.array().cast("array<int>"))), F.array().cast("array<int>"))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """docs with the lines taken out of text; every other column stays. A document goes if it loses lines and no line with
    words is left; one that never had words stays as it is."""
    whole = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), *_own(), _split().alias("parts")).select("*", _worded().alias("worded"))
    out = _with_kept(whole, docs, **options).select("row", "parts", "worded", "kept", _gone().alias("gone"))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone"), lambda i: F.get("parts", i))
    text = F.when(F.size("gone") > 0, F.array_join(left, "\n")).otherwise(F.col("row.text").cast("string"))
    stays = (F.size("gone") == 0) | (F.size("gone") < F.size("worded"))
    names = {c.lower(): c for c in docs.columns}
    return out.filter(stays).select(*(text.alias(c) if c == names["text"] else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", *_own(), _split().alias("parts")).select("doc_id", "no_id", "doc", "th", F.coalesce(F.size("parts"), F.lit(0)).cast("long").alias("n_lines"), _worded().alias("worded"))
    out = _with_kept(rows, docs).select("doc_id", "n_lines", _gone().alias("gone"))
    return out.select("doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"), F.array_join("gone", ",").alias("removed_lines"))


OP7_SQL = r"""
WITH t AS (SELECT doc_id, string_split(lower(text), chr(10)) AS p FROM documents),
l AS (SELECT doc_id, unnest(range(0, len(p))) AS line, unnest(p) AS s FROM t),
v AS (SELECT doc_id, line, trim(regexp_replace(s, '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM l),
w AS (SELECT * FROM v WHERE s <> ''),
f AS (SELECT s, min(struct_pack(d := doc_id, l := line)) AS begins FROM w GROUP BY s),
i AS (SELECT s, begins, row_number() OVER (ORDER BY begins) AS id, string_split(s, ' ') AS w FROM f),
p AS (SELECT id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS k FROM i),
g AS (SELECT DISTINCT id, array_to_string(w[k:k + 4], ' ') AS g FROM p),
n AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
o AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.id < b.id GROUP BY 1, 2),
r AS (SELECT DISTINCT b AS id FROM o JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
gone AS (SELECT doc_id, line FROM w JOIN i USING (s) LEFT JOIN r USING (id) WHERE r.id IS NOT NULL OR begins <> struct_pack(d := doc_id, l := line)),
by_doc AS (SELECT doc_id, count(*) AS n_removed, string_agg(line, ',' ORDER BY line) AS removed_lines FROM gone GROUP BY 1)
SELECT doc_id, CAST(len(p) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed_lines, '') AS removed_lines FROM t LEFT JOIN by_doc USING (doc_id)
"""
