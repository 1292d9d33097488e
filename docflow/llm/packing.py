"""Best-fit packing of tokenised documents into sequences, certified by lower bounds.

A document's ids are cut into pieces of at most ``capacity``; only a longer document is cut, and its first
piece takes what is left over. Pieces are dealt by hash into partitions of bounded size. Each partition is
packed by best-fit decreasing and held against a lower bound from dual feasible functions: a partition that
meets its bound can't be packed better. Partitions with a gap give away the bins that aren't full; these
bins are dealt anew into groups of bounded size, unpacked and packed again, and the new packing counts only
where it takes fewer bins. So no round makes the result worse, and no task holds more than ``part_rows`` pieces
in expectation, at any size of the table.

Defined results: a null or empty text is the end id alone (one piece of length 1); repeated rows are packed
each on its own; an empty table gives no rows; a null doc_id is kept as it is; pieces() ignores columns besides doc_id and
text; pack() keeps all columns but those named sequence_id, offset or certified, which its own replace.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

CAPACITY = 2048
PART_ROWS = 40_000
ROUNDS = 3
#: A sequence_id is level, group and bin, from these bits up: at most 32 levels, 2**27 groups, 2**31 bins of a group.
LEVEL_BIT, GROUP_BIT = 58, 31
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_CACHE_ROWS = 400_000
_ENCODERS: dict[str, "Encoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Byte-level BPE ids of whole texts as little-endian 32-bit bytes.

    The pre-tokeniser never joins what a blank parts from a preceding non-blank, so a text's ids are those of
    the pieces between blanks in a row. Pieces repeat; the most are found in a bounded cache. A text
    with two blanks in a row, a blank after other white space, or the special token goes whole to the tokenizer.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}
        ranks = path.removesuffix(".json") + ".tiktoken"
        self.fast = None
        if os.path.exists(ranks):  # the same vocabulary as ranks, which a faster library reads
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def slow(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        head, *tail = text.split(" ")
        if not head or head[-1].isspace():
            return self.slow(text)
        found = list(map(self.rest.get, tail))
        if None in found:
            if any(s in text for s in self.special):
                return self.slow(text)
            for i, ids in enumerate(found):
                if ids is None:
                    word = tail[i]
                    if not word or (word[-1].isspace() and i + 1 < len(tail)):
                        return self.slow(text)
                    found[i] = ids = self.slow(f" {word}")
                    if not word[-1].isspace() and len(word) < 64 and len(self.rest) < _CACHE_ROWS:
                        self.rest[word] = ids
        return self.slow(head) + b"".join(found)


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document; with_ids adds the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = enc.ids(text.as_py() or "") + end
                n = len(ids) // 4
                at = 0
                for piece in range(-(-n // capacity)):
                    to = n - (-(-n // capacity) - 1 - piece) * capacity
                    part = ids[4 * at : 4 * to]
                    for column, value in zip(out, (doc, piece, at, to - at, zlib.crc32(part), part if with_ids else b"")):
                        column.append(value)
                    at = to
            columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:5])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(out[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES + ", ids binary" * with_ids)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of the bounds by total, by leaving out small sizes (f_eps) and by rounding (u_k); all in whole numbers."""
    if not len(lengths):
        return 0
    sizes, count = np.unique(lengths, return_counts=True)
    sizes, count = sizes.astype(np.int64), count.astype(np.int64)
    best = -(-int((sizes * count).sum()) // capacity)
    for eps in np.unique(np.minimum(sizes, capacity - sizes)):
        if 0 < eps <= capacity // 2:
            value = np.where(sizes > capacity - eps, capacity, np.where(sizes < eps, 0, sizes))
            best = max(best, -(-int((value * count).sum()) // capacity))
    for k in range(1, 33):
        grown = (k + 1) * sizes
        value = np.where(grown % capacity == 0, sizes * k, grown // capacity * capacity)
        best = max(best, -(-int((value * count).sum()) // (capacity * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: (bin, offset) of each item and the number of bins. Open gaps are bits of one whole number."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = used = 0
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[i]
        fits = mask >> size
        if fits:
            gap = size + (fits & -fits).bit_length() - 1
            b = open_by_gap[gap].pop()
            if not open_by_gap[gap]:
                mask ^= 1 << gap
        else:
            gap, b = capacity, used
            used += 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > size:
            if not open_by_gap[gap - size]:
                mask |= 1 << (gap - size)
            open_by_gap[gap - size].append(b)
    return bins, offsets, used


def pack(items: DataFrame, capacity: int = CAPACITY, part_rows: int = PART_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """items (doc_id, piece, length, ...) with sequence_id, offset and certified (its group met the lower bound)."""
    columns = [f"`{c}`" for c in items.columns]
    items = stored(items.select(F.struct(*columns).alias("row"), F.col("length").cast("long").alias("length")), "pieces")
    parts = _parts(items.count(), part_rows)
    schema = f"row {items.schema['row'].dataType.simpleString()}, length long, sequence_id long, offset long, certified boolean, open boolean"

    def packer(level: int):
        def run(rows: pa.Table) -> pa.Table:
            lengths = rows.column("length").to_numpy()
            group = int(rows.column("part")[0].as_py())
            bins, offsets, used = best_fit(lengths, capacity)
            bins = bins + ((level << LEVEL_BIT) + (group << GROUP_BIT))
            if level:
                old = rows.column("sequence_id").to_numpy()
                if len(np.unique(old)) <= used:
                    bins, offsets, used = old, rows.column("offset").to_numpy(), len(np.unique(old))
            tight = used <= lower_bound(lengths, capacity)
            fill = dict(zip(*(x.tolist() for x in _fills(bins, lengths))))
            loose = np.array([not tight and fill[b] < capacity for b in bins.tolist()])
            return pa.table({"row": rows.column("row"), "length": rows.column("length"), "sequence_id": pa.array(bins, pa.int64()), "offset": pa.array(offsets, pa.int64()), "certified": np.full(len(lengths), tight), "open": loose})

        return run

    dealt = items.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)))  # rows, not ids: repeated and null ids are dealt out too
    packed = stored(dealt.groupBy("part").applyInArrow(packer(0), schema), "packed")
    done = packed.filter("not open")
    for level in range(1, rounds + 1):
        loose = packed.filter("open")
        n = loose.count()
        if not n:
            break
        again = loose.withColumn("part", F.pmod(F.xxhash64("sequence_id", F.lit(level)), F.lit(_parts(n, part_rows))))
        packed = stored(again.groupBy("part").applyInArrow(packer(level), schema), "packed")
        done = done.unionByName(packed.filter("not open"))
    own = [F.col(f"row.{c}") for c in columns if c.strip("`").lower() not in ("sequence_id", "offset", "certified")]
    return done.unionByName(packed.filter("open")).select(*own, "sequence_id", "offset", "certified")


def _parts(rows: int, part_rows: int) -> int:
    parts = max(1, math.ceil(rows / part_rows))
    if parts > 1 << (LEVEL_BIT - GROUP_BIT):
        raise ValueError(f"{parts} groups of {part_rows} pieces; a sequence_id has room for {1 << (LEVEL_BIT - GROUP_BIT)}: raise part_rows")
    return parts


def _fills(bins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    each, where = np.unique(bins, return_inverse=True)
    return each, np.bincount(where, lengths).astype(np.int64)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents"), default_tokenizer()))
