"""Media columns: TIFF. Walks image directories, undoes compression and predictor, and gives one row per page.

Reads classic TIFF of either byte order: strips and tiles; no compression, PackBits, LZW and deflate; predictor
1 and 2; 8- and 16-bit samples, one or more to a pixel, interleaved or in planes. ``write_tiff`` makes such files.

Defined results: a null media value gives no rows; bytes that aren't a readable TIFF give one row with page
null and ``error`` set, after the pages before the fault, so that no task fails on a bad file; a page whose pixels, or a strip
or tile of which, would take more than ``max_page_bytes`` is such a fault, and no codec gives out more than its strip or tile
holds; an empty table gives no rows; all other columns of the table stay, and a column of theirs with the name of an
output column is replaced by the output's.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
_FORMATS = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i"}
#: A page of more bytes is an error, so that a small file can't fill an executor's memory.
MAX_PAGE_BYTES = 1 << 29
_FLUSH_BYTES = 32 << 20
PAGE = T.StructType([T.StructField(n, t) for n, t in (("page", T.IntegerType()), ("width", T.IntegerType()), ("height", T.IntegerType()), ("samples", T.IntegerType()), ("bits", T.IntegerType()), ("compression", T.IntegerType()), ("predictor", T.IntegerType()), ("pixels", T.BinaryType()), ("error", T.StringType()))])


class TiffError(ValueError):
    pass


def unpack_bits(data: bytes, most: int) -> bytes:
    """The first ``most`` bytes or a little more; all if there are fewer."""
    out, i = bytearray(), 0
    while i < len(data) and len(out) < most:
        n = data[i]
        i += 1
        if n < 128:
            out += data[i : i + n + 1]
            i += n + 1
        elif n > 128:
            out += data[i : i + 1] * (257 - n)
            i += 1
    return bytes(out)


def pack_bits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        run = 1
        while run < 128 and i + run < len(data) and data[i + run] == data[i]:
            run += 1
        if run > 1:
            out += bytes((257 - run, data[i]))
            i += run
            continue
        j = i + 1
        while j < len(data) and j - i < 128 and not (j + 1 < len(data) and data[j] == data[j + 1]):
            j += 1
        out += bytes((j - i - 1,)) + data[i:j]
        i = j
    return bytes(out)


def unpack_lzw(data: bytes, most: int) -> bytes:
    """Codes of 9 to 12 bits, high bits first; each width ends one code early. Ends as unpack_bits does."""
    out = bytearray()
    names: list[bytes] = [bytes((i,)) for i in range(256)] + [b"", b""]
    width, bits, held, last = 9, 0, 0, b""
    for byte in data:
        held = (held << 8) | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == 257 or len(out) >= most:
            break
        if code == 256:
            del names[258:]
            width, last = 9, b""
            continue
        if code < len(names):
            entry = names[code]
        elif code == len(names) and last:
            entry = last + last[:1]
        else:
            raise TiffError("LZW code out of range")
        out += entry
        if last and len(names) < 4096:
            names.append(last + entry[:1])
        last = entry
        width = 9 if len(names) < 511 else 10 if len(names) < 1023 else 11 if len(names) < 2047 else 12
    return bytes(out)


def pack_lzw(data: bytes) -> bytes:
    out, held, bits = bytearray(), 0, 0
    codes: dict[bytes, int] = {}
    width = 9

    def put(code: int) -> None:
        nonlocal held, bits
        held = (held << width) | code
        bits += width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits)
            held &= (1 << bits) - 1

    def clear() -> None:
        nonlocal width
        put(256)
        codes.clear()
        codes.update({bytes((i,)): i for i in range(256)})
        width = 9

    clear()
    free, at = 258, b""
    for i in range(len(data)):
        longer = at + data[i : i + 1]
        if longer in codes:
            at = longer
            continue
        put(codes[at])
        codes[longer] = free
        free += 1
        if free in (512, 1024, 2048):
            width += 1
        if free == 4094:
            clear()
            free = 258
        at = data[i : i + 1]
    if at:
        put(codes[at])
        free += 1
        if free in (512, 1024, 2048):
            width += 1
    put(257)
    if bits:
        out.append((held << (8 - bits)) & 255)
    return bytes(out)


_DECODE = {NONE: lambda d, n: d, LZW: unpack_lzw, DEFLATE: lambda d, n: zlib.decompressobj().decompress(d, n), OLD_DEFLATE: lambda d, n: zlib.decompressobj().decompress(d, n), PACKBITS: unpack_bits}
_ENCODE = {NONE: bytes, LZW: pack_lzw, DEFLATE: lambda d: zlib.compress(d, 1), PACKBITS: pack_bits}


def _directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    if len(data) < 8 or data[:4] not in (b"II*\0", b"MM\0*"):
        raise TiffError("not a TIFF file")
    order = "<" if data[:2] == b"II" else ">"
    (at,) = struct.unpack_from(order + "I", data, 4)
    seen: set[int] = set()
    while at:
        if at in seen or at + 2 > len(data):
            raise TiffError("broken chain of directories")
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", data, at)
        tags = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
            if kind not in _FORMATS:
                continue
            size = _SIZES[kind] * count
            where = at + 10 + 12 * i if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * i)[0]
            if where + size > len(data):
                raise TiffError(f"tag {tag} lies outside the file")
            tags[tag] = struct.unpack_from(f"{order}{count}{_FORMATS[kind]}", data, where)
        yield order, tags
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)


def read_tiff(data: bytes, max_page_bytes: int = MAX_PAGE_BYTES) -> Iterator[tuple]:
    """(page, width, height, samples, bits, compression, predictor, pixels) of every image directory; TiffError, struct.error or
    zlib.error at the first fault."""
    for page, (order, t) in enumerate(_directories(data)):
        one = lambda tag, default=None: t[tag][0] if t.get(tag) else default
        width, height, samples = one(256), one(257), one(277, 1)
        bits, compression, predictor, planes = one(258, 1), one(259, 1), one(317, 1), one(284, 1)
        if not width or not height or bits not in (8, 16) or compression not in _DECODE or predictor not in (1, 2):
            raise TiffError(f"unsupported: {width} x {height}, {bits} bits, compression {compression}, predictor {predictor}")
        if min(width, height, samples) < 1 or planes not in (1, 2):
            raise TiffError(f"no image: {width} x {height}, {samples} samples, planes {planes}")
        kind = np.dtype(np.uint8 if bits == 8 else f"{order}u2")
        per = samples if planes == 1 else 1
        tiled = 322 in t
        wide, tall = (one(322), one(323)) if tiled else (width, min(one(278, height), height))
        if not wide or not tall or min(wide, tall) < 1:
            raise TiffError(f"strips or tiles of {wide} x {tall}")
        if max(width * height * samples, wide * tall * per) * kind.itemsize > max_page_bytes:
            raise TiffError(f"more than {max_page_bytes} bytes: {width} x {height}, {samples} samples, in parts of {wide} x {tall}")
        across, down = -(-width // wide), -(-height // tall)
        starts, counts = t.get(324 if tiled else 273), t.get(325 if tiled else 279)
        if not starts or not counts or len(starts) < across * down * (samples // per) or len(counts) < len(starts):
            raise TiffError("strips or tiles are missing")
        image = np.zeros((samples // per, height, width, per), kind)
        for k in range(across * down * (samples // per)):
            plane, cell = divmod(k, across * down)
            y, x = cell // across * tall, cell % across * wide
            rows = tall if tiled else min(tall, height - y)
            size = rows * wide * per * kind.itemsize
            if starts[k] < 0 or counts[k] < 0:
                raise TiffError("a strip or tile lies before the file")
            part = _DECODE[compression](data[starts[k] : starts[k] + counts[k]], size)
            if len(part) < size:
                raise TiffError("a strip or tile is short")
            block = np.frombuffer(part, kind, size // kind.itemsize).reshape(rows, wide, per)
            if predictor == 2:
                block = np.cumsum(block, axis=1, dtype=kind.newbyteorder("="))
            cut = block[: height - y, : width - x]
            image[plane, y : y + cut.shape[0], x : x + cut.shape[1]] = cut
        pixels = image[0] if per == samples else np.moveaxis(image[..., 0], 0, -1)
        yield page, width, height, samples, bits, compression, predictor, pixels.astype(kind.newbyteorder("<"), copy=False).tobytes()


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, rows_per_strip: int = 0, tile: tuple[int, int] | None = None, order: str = "<") -> bytes:
    """A TIFF file of pages of shape (height, width) or (height, width, samples), of 8 or 16 bits."""
    out = bytearray((b"II*\0" if order == "<" else b"MM\0*") + b"\0" * 4)
    link = 4
    for page in pages:
        image = page.reshape(*page.shape[:2], -1)
        image = image.astype(image.dtype.newbyteorder(order), copy=False)
        height, width, samples = image.shape
        wide, tall = tile or (width, rows_per_strip or height)
        starts, counts = [], []
        for y in range(0, height, tall):
            for x in range(0, width, wide):
                block = image[y : y + tall, x : x + wide]
                if tile:
                    whole = np.zeros((tall, wide, samples), image.dtype)
                    whole[: block.shape[0], : block.shape[1]] = block
                    block = whole
                if predictor == 2:
                    step = block.astype(block.dtype.newbyteorder("="))
                    step[:, 1:] = step[:, 1:] - step[:, :-1]
                    block = step.astype(image.dtype)
                part = _ENCODE[compression](block.tobytes())
                starts.append(len(out))
                counts.append(len(part))
                out += part
        tags = [(256, 4, (width,)), (257, 4, (height,)), (258, 3, (8 * image.dtype.itemsize,) * samples), (259, 3, (compression,)), (262, 3, (1 if samples < 3 else 2,)), (277, 3, (samples,)), (284, 3, (1,)), (317, 3, (predictor,))]
        tags += [(322, 4, (wide,)), (323, 4, (tall,)), (324, 4, tuple(starts)), (325, 4, tuple(counts))] if tile else [(273, 4, tuple(starts)), (278, 4, (tall,)), (279, 4, tuple(counts))]
        entries = []
        for tag, kind, values in sorted(tags):
            raw = struct.pack(f"{order}{len(values)}{_FORMATS[kind]}", *values)
            if len(raw) > 4:
                out += b"\0" * (len(out) % 2)
                raw, place = struct.pack(order + "I", len(out)), raw
                out += place
            entries.append(struct.pack(order + "HHI", tag, kind, len(values)) + raw.ljust(4, b"\0"))
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        link = len(out) + 2 + 12 * len(entries)
        out += struct.pack(order + "H", len(entries)) + b"".join(entries) + b"\0" * 4
    return bytes(out)


def tiff_pages(df: DataFrame, media: str = "media", max_page_bytes: int = MAX_PAGE_BYTES) -> DataFrame:
    """One row per page of the TIFF in column media: the table's other columns, then those of PAGE."""
    names = [c for c in df.columns if c != media and c.lower() not in PAGE.names]
    others = [f"_{i}" for i in range(len(names))]  # mapInArrow can't take every name, such as one with a dot
    schema = T.StructType([*(T.StructField(o, df.schema[c].dataType) for o, c in zip(others, names)), *PAGE.fields])

    def rows(data: bytes) -> Iterator[tuple]:
        try:
            for page in read_tiff(data, max_page_bytes):
                yield *page, None
        except (ValueError, TypeError, ArithmeticError, LookupError, struct.error, zlib.error, MemoryError) as e:  # TiffError is a ValueError
            yield *(None,) * 8, f"{type(e).__name__}: {e}"[:200]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in PAGE.names]
            source: list[int] = []
            size = 0
            for i, value in enumerate(batch.column("_media")):
                if not value.is_valid:
                    continue
                for row in rows(value.as_py()):
                    source.append(i)
                    size += len(row[7] or b"")
                    for column, v in zip(out, row):
                        column.append(v)
                    if size > _FLUSH_BYTES:
                        yield _rows(batch, others, source, out)
                        out, source, size = [[] for _ in PAGE.names], [], 0
            yield _rows(batch, others, source, out)

    return df.select(*(F.col(f"`{c}`").alias(o) for c, o in zip(names, others)), F.col(f"`{media}`").alias("_media")).mapInArrow(run, schema).toDF(*names, *PAGE.names)


def _rows(batch: pa.RecordBatch, others: list[str], source: list[int], out: list[list]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 7 + [pa.binary(), pa.string()]
    rest = batch.select(others).take(pa.array(source, pa.int64()))
    return pa.RecordBatch.from_arrays([*rest.columns, *(pa.array(c, k) for c, k in zip(out, kinds))], [*others, *PAGE.names])


def text_media(docs: DataFrame, row: int = 64, rows_per_strip: int = 256) -> DataFrame:
    """(doc_id, n_bytes, media): each text's bytes, null as empty, with bytes 0 up to whole rows of ``row``, as a one-page TIFF."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, media = [], []
            for value in batch.column("text"):
                data = value.as_buffer().to_pybytes() if value.is_valid else b""
                sizes.append(len(data))
                padded = data.ljust(max(row, -(-len(data) // row) * row), b"\0")
                media.append(write_tiff([np.frombuffer(padded, np.uint8).reshape(-1, row)], DEFLATE, 2, rows_per_strip))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def op4_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = text_media(table(spark, sf_dir, "documents")).withColumns({"media_bytes": F.length("media").cast("long"), "media_sha256": F.sha2("media", 256)})
    pages = tiff_pages(media)
    return pages.select(
        "doc_id",
        "n_bytes",
        F.length("pixels").cast("long").alias("payload_bytes"),
        F.sha2("pixels", 256).alias("payload_sha256"),
        F.crc32(F.substring("pixels", -64, 64)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        F.concat_ws(";", F.concat(F.lit("tiff:"), "width", F.lit("x"), "height", F.lit("x"), "samples"), F.concat(F.lit("bits="), "bits"), F.concat(F.lit("compression="), "compression"), F.concat(F.lit("predictor="), "predictor"), F.concat(F.lit("xxh="), F.hex(F.xxhash64("pixels")))).alias("feature"),
        (F.col("page") + 1).alias("n_pages"),
        "error",
    )
