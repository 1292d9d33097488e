"""Helpers that the operators of this subpackage share: tables, shared storage, byte-level words and hashes.

Text work in Python is done on Arrow's UTF-8 buffers with numpy, a block of documents at a time,
so that no Python object is made for a word and memory follows the block, not the table.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
BLOCK_BYTES = 4 << 20  # text bytes that are worked on at a time; a longer text is a block of its own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset and Spark runs on this machine alone, a
    temporary folder is set. On a cluster an unset folder is an error, as executors would not see a folder of the driver's."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir is unset on {master}; set it to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='docflow-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/docflow/{tag}-{uuid.uuid4().hex}"


#: Seconds from which a step counts as large, so that what Spark keeps of it is let go as soon as it is stored; and those that
#: Spark is given to lose sight of it.
LARGE_STEP, PAUSE = 1.0, 0.5
#: Share of the heap it may take that the driver holds, garbage with it, from which small steps have it collected too.
HEAP_SHARE = 0.5


def stored(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """df written as Parquet in the shared folder and read again: lineage is cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    began = time.monotonic()
    df.write.parquet(path, compression=compression)
    if time.monotonic() - began >= LARGE_STEP:
        released(spark)
    elif heap_share(spark) > HEAP_SHARE:
        spark.sparkContext._jvm.System.gc()
        trimmed(spark)
    return spark.read.schema(df.schema).parquet(path)


def heap_share(spark: SparkSession) -> float:
    """What the driver's heap has taken of the machine's memory, as a share of all that it may take."""
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    return heap.totalMemory() / heap.maxMemory()


def released(spark: SparkSession) -> None:
    """Has the driver collect its garbage. Spark drops the shuffle files and broadcasts of a step that is over only when that happens;
    left to chance, disk holds those of many large steps at once, and the driver's heap grows to all that it may take. Twice, as the
    first may come while listeners still hold the step, which then is old and left alone by all but another full collection."""
    for _ in range(2):
        time.sleep(PAUSE)
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    trimmed(spark)


def trimmed(spark: SparkSession) -> bool:
    """Has the driver's JVM give back what it has freed outside its heap (compilers, buffers), which the C library keeps thread by thread
    for later. False where the JVM has no such command: not on Linux, or older than 17.0.9."""
    gateway, java = spark.sparkContext._gateway, spark.sparkContext._jvm
    try:
        # by the interface, as the server's own class can't be called from outside its module
        call = next(m for m in java.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods() if m.getName() == "invoke")
        args = gateway.new_array(java.Object, 4)
        args[0], args[1] = java.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        call.invoke(java.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        return False
    return True


def without(docs: DataFrame, bad: DataFrame, tag: str) -> DataFrame:
    """The rows of docs but those of a doc_id in bad (doc_id, key); of rows without an id those go whose text's xxhash64 is a
    key of a row without one in bad."""
    by_text = lambda i, key: F.when(i.isNull(), key)
    bad = stored(bad.select(F.col("doc_id").alias("bad_id"), by_text(F.col("doc_id"), F.col("key")).alias("bad_key")).distinct(), tag)
    own = docs["doc_id"].cast("long")
    return docs.join(bad, own.eqNullSafe(bad["bad_id"]) & by_text(own, F.xxhash64(docs["text"].cast("string"))).eqNullSafe(bad["bad_key"]), "left_anti")


HOT = 1024


def joined(rows: DataFrame, few: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """The inner join of rows with few, a stored table of a row for each key, whose column weight counts the rows that have it. Keys
    that more than one row in HOT has are HOT at most; they are broadcast, so that no task gathers their rows."""
    total = few.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight).cast("decimal(38,0)") * HOT > F.lit(total).cast("decimal(38,0)")
    hot = few.filter(is_hot)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(few.filter(~is_hot), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(rest)


def finite(column: Column) -> Column:
    """Whether an array of doubles is there and holds no null and no non-finite value."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return column.isNotNull() & ~F.exists(column, bad)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- Arrow and bytes


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offs[-1] == offs[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut into blocks of about BLOCK_BYTES of text, with the text's bytes and offsets."""
    for batch in batches:
        data, offs = utf8(batch.column(text))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + BLOCK_BYTES, "right")) - 1)
            yield batch.slice(i, j - i), data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            i = j


def _byte_table(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)], bool)


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Bytes of words that white space parts: [^\x20\x09-\x0D].
SPACE_WORDS = _byte_table(lambda b: not (b == 32 or 9 <= b <= 13))
#: Bytes of words of letters, digits and all beyond ASCII, of lower-cased text: [^\x00-\x2F\x3A-\x60\x7B-\x7F].
ALNUM_WORDS = _byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_POWERS = np.multiply.accumulate(np.full(1 << 16, 0x9E3779B97F4A7C15, U64))
_POWERS = mix(_POWERS) | U64(1)


def words(data: np.ndarray, offs: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, document) of every word of a block: maximal runs of bytes of a kind within a document."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    inside = kind[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    edge = offs[:-1][offs[:-1] < n]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    edge = offs[1:][offs[1:] > 0] - 1
    after[edge] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK_BYTES // 4, "right")))
        lens = ends[i:j] - starts[i:j]
        first = np.zeros(j - i, np.int64)
        np.cumsum(lens[:-1], out=first[1:])
        place = np.arange(int(lens.sum())) - np.repeat(first, lens)
        chars = data[place + np.repeat(starts[i:j], lens)].astype(U64) + U64(1)
        weights = _POWERS[place & 0xFFFF]
        far = np.flatnonzero(place > 0xFFFF)  # in a very long word every part of 65,536 bytes has weights of its own
        if len(far):
            weights[far] = mix(weights[far] + (place[far] >> 16).astype(U64) * U64(0xD6E8FEB86659FD93)) | U64(1)
        out[i:j] = np.add.reduceat(chars * weights, first) + lens.astype(U64)
        i = j
    return mix(out)


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k values in a row: one fewer than k shorter than the input."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.full(n, k, U64)
    for i in range(k):
        out = mix(out * U64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return out


def doc_shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of k words of a block, and bounds of each document's; with fewer words, one of them all."""
    at = np.searchsorted(doc, np.arange(n_docs + 1))
    count = np.diff(at)
    runs = run_hashes(hashes, k)
    keep = np.zeros(len(hashes), bool)
    if len(runs):
        keep[: len(runs)] = doc[: len(runs)] == doc[k - 1 :]
    short = np.flatnonzero((count > 0) & (count < k))
    keep[at[short]] = True
    full = np.zeros(len(hashes), U64)
    full[: len(runs)] = runs
    for d in short:
        full[at[d]] = run_hashes(hashes[at[d] : at[d + 1]], int(count[d]))[0]
    bounds = np.zeros(n_docs + 1, np.int64)
    np.cumsum(np.where(count >= k, count - k + 1, (count > 0).astype(np.int64)), out=bounds[1:])
    return full[keep], bounds
