"""N-gram Jaccard join by a token-group matrix.

A document's set holds its distinct shingles of ``k`` words. Two documents link when 100 * intersection >=
``percent`` * union. The join is exact:

1. Documents of equal sets form a class; one member stands for it from here on.
2. Shingles are ordered by rarity, from a sketch of 2**SKETCH_BITS counters summed over all documents, then by hash. Of their
   first n - ceil(n * percent / 100) + least(n) shingles, two sets that link share least(smaller n) or more, where least
   is a tenth of the size. Only these are shuffled; those that no other set of a fitting size has are dropped in
   passing, and then sets that are left with too few.
3. Sets that meet are partitioned into groups of similar sets: each goes to the set (its pivot) that comes first in most of
   its shingles. A set that links with its pivot is in the group's core; cores need no further look within.
4. The matrix holds, for each remaining shingle, the groups that have it; groups are split by core and into chunks of
   bounded size. The number of a query's shingles that the matrix finds in a group bounds what it shares with any
   member; where it suffices, so must its overlap with the union of all the group's tokens; only then is the
   group opened and its members compared, with whole sets.
5. Components of the links, by components.py.

Rows of a hot shingle or group are dealt out by salts; no pairs are made within a group, and the rows that are
shuffled grow with the number of sets that meet. Texts that take part are shuffled, not all texts, unless
more than BROADCAST_ROWS sets take part.

Shingles are compared by 64-bit hashes and classes by 128-bit sums of them.

Defined results: a null or empty text, or one without words, has an empty set, links with nothing and is its own
component; a text of fewer than k words is one shingle; rows of one doc_id are one document with several texts;
a null doc_id takes part and gets the smallest id it reaches, null if there is none; an empty table gives no
rows; other columns are ignored by classes() and kept by deduplicated().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, SPACE_WORDS, U64, blocks, doc_shingles, mix, stored, table, word_hashes, words
from .components import components

SKETCH_BITS = 18
CHUNK_ROWS = 128
CHUNK_TOKENS = 1 << 20
SALT_ROWS = 512
BROADCAST_ROWS = 250_000
#: Rows without an id take ids of their text's hash from here up inside the join, and are known by a flag, not by these.
NO_ID = 1 << 62
_SETS = "id long, none boolean, n int, h1 long, h2 long, prefix array<long>"


def _sets(data: np.ndarray, offs: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a block."""
    data = LOWER[data]
    starts, ends, doc = words(data, offs, SPACE_WORDS)
    runs, at = doc_shingles(word_hashes(data, starts, ends), doc, len(offs) - 1, k)
    for a, b in zip(at, at[1:]):
        yield np.unique(runs[a:b])


def _set_of(text: str, k: int) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return next(_sets(data, np.array([0, len(data)]), k))


def least(n: int) -> int:
    """How many of their first shingles two linked sets share, n being the size of the smaller."""
    return max(1, n // 10)


def sketch(docs: DataFrame, k: int) -> np.ndarray:
    """A level of frequency for each of 2**SKETCH_BITS buckets of shingles, over all documents."""
    size, rows = 1 << SKETCH_BITS, 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch, data, offs in blocks(batches):
            data = LOWER[data]
            starts, ends, doc = words(data, offs, SPACE_WORDS)
            runs, _ = doc_shingles(word_hashes(data, starts, ends), doc, batch.num_rows, k)
            count += np.bincount((runs >> U64(64 - SKETCH_BITS)).astype(np.int64), minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int32()), pa.array([c.astype("<u4").tobytes() for c in count.reshape(rows, -1)], pa.binary())], ["part", "counts"])

    def total(group: pa.Table) -> pa.Table:
        count = np.zeros(size // rows, np.int64)
        for c in group.column("counts"):
            count += np.frombuffer(c.as_buffer(), "<u4")
        return pa.table({"part": group.column("part")[:1], "counts": pa.array([count.tobytes()], pa.binary())})

    summed = docs.select("text").mapInArrow(run, "part int, counts binary").groupBy("part").applyInArrow(total, "part int, counts binary").collect()
    count = np.zeros(size)
    for r in summed:
        count.reshape(rows, -1)[r.part] = np.frombuffer(r.counts, np.int64)
    mean = max(1.0, count.mean())
    return np.clip(np.round(4 * np.log2(1 + count / mean)), 0, 255).astype(U64)


def sets(docs: DataFrame, levels: np.ndarray, k: int, percent: int) -> DataFrame:
    """id, size, two sums that name the set, and its first shingles in order of rarity."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in blocks(batches):
            size, h1, h2, prefix = [], [], [], []
            for own in _sets(data, offs, k):
                n = len(own)
                size.append(n)
                h1.append(int(mix(own).sum(dtype=U64).astype(np.int64)))
                h2.append(int(mix(own ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64).astype(np.int64)))
                take = min(n, n - -(-n * percent // 100) + least(n)) if n else 0
                token = (shared.value[(own >> U64(64 - SKETCH_BITS)).astype(np.int64)] << U64(56)) | (own << U64(SKETCH_BITS) >> U64(8))
                prefix.append(np.sort(token)[:take].astype(np.int64))
            values = np.concatenate(prefix) if prefix else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, prefix)], dtype=np.int32), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("none"), pa.array(size, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), lists], ["id", "none", "n", "h1", "h2", "prefix"])

    return docs.select("id", "none", "text").mapInArrow(run, _SETS)


def meetings(classes: DataFrame, percent: int) -> DataFrame:
    """(id, n, bucket, pivot) of sets that share a shingle with one of a fitting size. A bucket is a shingle and a chain of
    sizes each fitting the next; its pivot is its first set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far: token, n, id, pivot, whether it was given out
        for batch in batches:
            token, n, own = (batch.column(c).to_numpy() for c in ("token", "n", "id"))
            if not len(token):
                continue
            old_pivot, given = None, False
            if held is not None:
                token, n, own = np.append(held[0], token), np.append(held[1], n), np.append(held[2], own)
                old_pivot, given = held[3], held[4]
            joins = np.append(False, (token[1:] == token[:-1]) & (100 * n[:-1].astype(np.int64) >= percent * n[1:].astype(np.int64)))
            chain = np.cumsum(~joins) - 1
            pivot = own[~joins][chain]
            if old_pivot is not None:
                pivot[chain == 0] = old_pivot
            keep = joins.copy()
            keep[:-1] |= joins[1:]
            if given:
                keep[0] = False
            held = (token[-1], n[-1], own[-1], pivot[-1], bool(keep[-1]) or (len(own) == 1 and given))
            bucket = mix(token[keep].astype(U64) ^ mix(pivot[keep].astype(U64))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own[keep]), pa.array(n[keep]), pa.array(bucket), pa.array(pivot[keep])], ["id", "n", "bucket", "pivot"])

    tokens = classes.select("id", "n", F.explode("prefix").alias("token"))
    return tokens.repartition("token").sortWithinPartitions("token", "n", "id").mapInArrow(run, "id long, n int, bucket long, pivot long")


def _texts(docs: DataFrame, need: DataFrame) -> DataFrame:
    """need, by id, with the texts. Few ids are broadcast, their number checked; else both sides are shuffled."""
    small = need.select("id").count() <= BROADCAST_ROWS
    return docs.select("id", "text").join(F.broadcast(need) if small else need, "id")


def _linked(overlap: np.ndarray, a: int, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * overlap >= percent * (a + b - overlap)


def star(docs: DataFrame, members: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, pivot) of members (id, pivot, salts) that link with their pivot; the pivot itself among them."""
    salted = members.select("id", "pivot", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"), F.lit(1).alias("role")).filter("id <> pivot")
    pivots = members.filter("id <> pivot").groupBy("pivot").agg(F.max("salts").alias("salts")).select(F.col("pivot").alias("id"), "pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"))
    rows = _texts(docs, stored(salted.unionByName(pivots), "star"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for own, pivot, salt, role, text in zip(*(batch.column(c).to_pylist() for c in ("id", "pivot", "salt", "role", "text"))):
                if (pivot, salt) != at:
                    at, heads = (pivot, salt), []
                shingles = _set_of(text, k)
                if role == 0:
                    heads.append(shingles)
                elif any(len(shingles) and len(h) and _linked(_overlap(shingles, h), len(shingles), len(h), percent) for h in heads):
                    out.append((own, pivot))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], ["id", "pivot"])

    sides = rows.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "role").select("id", "pivot", "salt", "role", "text")
    return sides.mapInArrow(run, "id long, pivot long").distinct()


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def enough(found: DataFrame) -> DataFrame:
    """(id, core, gid): the groups that hold need or more of a query's shingles; gids has a group once for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, gid = np.empty(0, np.int64), np.empty(0, np.int64)
            if batch.num_rows:
                gids = batch.column("gids")
                at = gids.offsets.to_numpy().astype(np.int64)
                values = gids.values.to_numpy()[at[0] : at[-1]]
                rows = np.repeat(np.arange(batch.num_rows), np.diff(at))
                order = np.lexsort((values, rows))
                rows, values = rows[order], values[order]
                new = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])))[: len(rows)]
                times = np.diff(np.append(new, len(rows)))
                ok = new[times >= batch.column("need").to_numpy()[rows[new]]] if len(rows) else new[:0]
                row, gid = rows[ok], values[ok]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), batch.column("core").take(pa.array(row)), pa.array(gid, pa.int64())], ["id", "core", "gid"])

    return found.select("id", "core", "need", "gids").mapInArrow(run, "id long, core boolean, gid long")


def open_groups(docs: DataFrame, members: DataFrame, probes: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) of query sets with members of the groups that they probe.

    members (id, gid, core), probes (id, gid, core): core of a probe is that of the query set."""
    load = probes.groupBy("gid").agg(F.count(F.lit(1)).alias("queries")).select("gid", F.ceil(F.col("queries") / SALT_ROWS).alias("salts"))
    load = stored(load, "load")
    own = members.join(load, "gid").select("id", "gid", "core", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"))
    asked = probes.join(load, "gid").select("id", "gid", "core", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"), F.lit(1).alias("role"))
    rows = _texts(docs, stored(own.unionByName(asked), "open"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        ids, tokens = [], []
        union = None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for me, gid, core, salt, role, text in zip(*(batch.column(c).to_pylist() for c in ("id", "gid", "core", "salt", "role", "text"))):
                if (gid, salt) != at:
                    at, ids, tokens, union = (gid, salt), [], [], None
                shingles = _set_of(text, k)
                if role == 0:
                    if len(shingles):
                        ids.append(me)
                        tokens.append(shingles)
                        group_core = core
                    continue
                if not ids or not len(shingles):
                    continue
                if union is None:
                    flat = np.concatenate(tokens)
                    order = np.argsort(flat, kind="stable")
                    flat, holder = flat[order], np.repeat(np.arange(len(ids)), [len(t) for t in tokens])[order]
                    union, begin = np.unique(flat, return_index=True)
                    begin = np.append(begin, len(flat))
                    sizes, names = np.array([len(t) for t in tokens]), np.array(ids)
                place = np.minimum(np.searchsorted(union, shingles), len(union) - 1)
                place = place[union[place] == shingles]
                if 100 * len(place) < percent * len(shingles):
                    continue  # not even all of the group's tokens together would do
                times = begin[place + 1] - begin[place]
                entry = np.repeat(begin[place], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                common = np.bincount(holder[entry], minlength=len(ids))
                ok = _linked(common, len(shingles), sizes, percent) & (names != me)
                if core == group_core:
                    ok &= names < me
                found = names[ok]
                out.extend((me, int(x)) for x in (found[:1] if group_core else found))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    sides = rows.repartition("gid", "salt").sortWithinPartitions("gid", "salt", "role").select("id", "gid", "core", "salt", "role", "text")
    return sides.mapInArrow(run, "a long, b long").distinct()


def _own_id() -> Column:
    """The id of a row inside the join: its doc_id, or one from NO_ID up by its text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID) + F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(1 << 61)))


def classes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text)."""
    real = lambda c, none: F.when(~F.col(none), F.col(c))
    return _classes(docs, k, percent).select(real("id", "none").alias("doc_id"), "n_shingles", real("root", "root_none").alias("component_id"))


def _classes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """id, none, n_shingles, root, root_none of every row: none marks rows without an id, root_none components of such rows alone."""
    docs = docs.select(_own_id().alias("id"), F.col("doc_id").cast("long").isNull().alias("none"), F.col("text").cast("string").alias("text"))
    named = stored(sets(docs, sketch(docs, k), k, percent), "sets")
    whole = stored(named.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("id").alias("id"), F.min_by("prefix", "id").alias("prefix")), "classes")
    met = stored(meetings(whole, percent), "meetings")
    need = F.greatest(F.lit(1), F.floor(F.ceil(F.min("n") * percent / 100) / 10)).cast("int")  # least() of the smallest set that fits any of the id's
    groups = met.groupBy("id").agg(F.mode("pivot", True).alias("pivot"), F.max("n").alias("n"), F.count(F.lit(1)).alias("met"), need.alias("need")).filter("met >= need")
    groups = stored(groups.drop("met"), "similar")
    counted = groups.groupBy("pivot").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("n").cast("long")).alias("tokens"))
    members = stored(groups.join(counted, "pivot").withColumn("salts", F.ceil(F.col("rows") / SALT_ROWS)), "members")
    cores = stored(star(docs, members, k, percent), "cores")
    members = members.join(cores.withColumnRenamed("pivot", "core_of"), "id", "left").withColumn("core", F.col("core_of").isNotNull() | (F.col("id") == F.col("pivot")))
    # A core set carries its pivot's name, any other its own: a bucket of one name needs no further look.
    members = members.withColumn("name", F.when(F.col("core"), F.col("pivot"))).drop("core_of")
    chunks = F.greatest(F.ceil(F.col("rows") / CHUNK_ROWS), F.ceil(F.col("tokens") / CHUNK_TOKENS))
    members = stored(members.select("id", "need", "pivot", "core", "name", F.xxhash64("pivot", "core", F.pmod(F.xxhash64("id", F.lit(1)), chunks)).alias("gid")), "groups")
    placed = met.select("id", "bucket").join(members, "id")
    matrix = placed.groupBy("bucket").agg(F.collect_set(F.struct("gid", "pivot", "core")).alias("groups"), F.min("name").alias("lo"), F.max("name").alias("hi"), F.count_if(~F.col("core")).alias("loose"))
    matrix = matrix.filter("loose > 0 or lo <> hi").select("bucket", "groups")
    seen = placed.join(matrix, "bucket")
    worth = lambda g: ~F.col("core") | (g["core"] & (g["pivot"] != F.col("pivot")))
    probes = seen.select("id", "core", "need", F.transform(F.filter("groups", worth), lambda g: g["gid"]).alias("gids")).filter(F.size("gids") > 0)
    probes = stored(enough(probes.groupBy("id", "core", "need").agg(F.flatten(F.collect_list("gids")).alias("gids"))), "probes")
    links = open_groups(docs, members.select("id", "gid", "core"), probes, k, percent)
    edges = cores.select(F.col("id").alias("a"), F.col("pivot").alias("b")).unionByName(links)
    reached = named.join(whole.select("h1", "h2", "n", F.col("id").alias("class")), ["h1", "h2", "n"], "left")
    several = reached.filter("class is not null").groupBy("id").agg(F.collect_set("class").alias("all")).filter(F.size("all") > 1)
    edges = edges.unionByName(several.select(F.col("id").alias("a"), F.explode("all").alias("b")))  # one document with several texts
    roots = components(edges)
    reached = reached.join(roots, reached["class"] == roots["node"], "left")
    out = reached.select("id", "none", F.col("n").cast("long").alias("n_shingles"), F.coalesce("root", "class", "id").alias("root"))
    if named.filter("none").isEmpty():
        return out.withColumn("root_none", F.lit(False))
    # Where rows have no id, a component's id is the smallest of those that have one, whatever stands for the others.
    out = stored(out, "roots")
    least_of = out.groupBy(F.col("root").alias("of")).agg(F.min(F.struct("none", "id")).alias("first"))
    return out.join(least_of, out["root"] == least_of["of"]).select("id", "none", "n_shingles", F.col("first.id").alias("root"), F.col("first.none").alias("root_none"))


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of docs: of the rows with the smallest doc_id the one whose text has the smallest hash; every
    column stays. Of a component without any id one row stays, chosen in the same way."""
    ids = stored(_classes(docs, k, percent).filter("id = root and none = root_none").select(F.col("id").alias("keep_id"), F.col("none").alias("keep_none")).distinct(), "keep")
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), _own_id().alias("own"), F.col("doc_id").cast("long").isNull().alias("none"), F.xxhash64(F.col("text").cast("string")).alias("th"))
    here = rows.join(ids, (F.col("own") == F.col("keep_id")) & (F.col("none") == F.col("keep_none")), "left_semi")
    once = Window.partitionBy("own", "none").orderBy("th")
    return here.withColumn("nth", F.row_number().over(once)).filter("nth = 1").select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"), 3, 90)


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP2_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i, w FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT y, c FROM r JOIN e ON x = doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(c) FROM r WHERE r.doc_id = w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id)
"""
