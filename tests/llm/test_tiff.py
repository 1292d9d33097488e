import hashlib
import struct
import zlib

import numpy as np
import pytest

from docflow.llm import tiff
from docflow.llm.tiff import DEFLATE, LZW, NONE, PACKBITS, read_tiff, tiff_pages, write_tiff


@pytest.mark.parametrize("compression", [NONE, LZW, DEFLATE, PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("shape", [dict(rows_per_strip=5), dict(tile=(16, 16)), {}])
@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
def test_round_trip(compression, predictor, order, shape, kind):
    rng = np.random.default_rng(3)
    pages = [rng.integers(0, 9, (37, 41, 3)).astype(kind), (np.arange(33 * 64).reshape(33, 64) // 50).astype(kind)]
    got = list(read_tiff(write_tiff(pages, compression, predictor, order=order, **shape)))
    assert [g[0] for g in got] == [0, 1]
    for p, g in zip(pages, got):
        assert g[1:3] == (p.shape[1], p.shape[0]) and g[7] == p.astype(p.dtype.newbyteorder("<")).tobytes()


def test_codecs_on_hard_inputs():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 127, 128, 129, 300, 5000, 40000):
        for top in (1, 2, 256):
            data = rng.integers(0, top, n).astype(np.uint8).tobytes()
            assert tiff.unpack_bits(tiff.pack_bits(data), n + 1) == data
            assert tiff.unpack_lzw(tiff.pack_lzw(data), n + 1) == data
    assert len(tiff.unpack_bits(b"\x81\0" * 10**5, 1000)) < 1200 and len(tiff.unpack_lzw(tiff.pack_lzw(bytes(10**6)), 1000)) < 6000


def test_pages_keep_other_columns_and_report_bad_files(spark):
    good = write_tiff([np.zeros((2, 3), np.uint8)] * 2)
    rows = [(1, good, "a"), (2, None, "b"), (3, b"junk", "c"), (4, good[:20], "d"), (5, b"", "e")]
    got = tiff_pages(spark.createDataFrame(rows, "id int, media binary, page string")).collect()
    assert sorted((r.id, r.page, r.error is None) for r in got if r.page is not None) == [(1, 0, True), (1, 1, True)]
    assert sorted(r.id for r in got if r.error) == [3, 4, 5]
    assert tiff_pages(spark.createDataFrame([], "media binary")).count() == 0


def test_query_against_plain_python(spark, tmp_path):
    texts = ["", None, "x" * 64, "é" * 40, "y" * 200_000, "same", "same", "z" * 63]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in tiff.op4_tiff_media(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        padded = data.ljust(max(64, -(-len(data) // 64) * 64), b"\0")
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        media = write_tiff([np.frombuffer(padded, np.uint8).reshape(-1, 64)], DEFLATE, 2, 256)
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
    assert got[5].feature == got[6].feature


def test_pages_before_a_bad_one_stay(spark):
    pages = [np.full((2, 3), i, np.uint8) for i in range(3)]
    whole = write_tiff(pages)
    last = whole.rindex(b"\x00\x01\x04\x00\x01\x00\x00\x00\x03\x00\x00\x00")  # width of the last directory
    bad = whole[: last + 8] + b"\0" * 4 + whole[last + 12 :]
    got = tiff_pages(spark.createDataFrame([(1, bytearray(bad))], "id int, media binary")).collect()
    assert [(r.page, r.pixels is not None, r.error is None) for r in got] == [(0, True, True), (1, True, True), (None, False, False)]


def tagged(order="<", **tags):
    """A one-page file with some tags set to values of one's own, those given as None left out."""
    names = dict(width=256, height=257, bits=258, compression=259, starts=273, samples=277, rows=278, counts=279, planes=284, predictor=317, tile_width=322, tile_height=323, tile_starts=324, tile_counts=325)
    values = dict(width=4, height=4, bits=8, compression=1, starts=8, samples=1, rows=4, counts=16) | tags
    entries = sorted((names[n], v) for n, v in values.items() if v is not None)
    out = b"II*\0" + struct.pack("<I", 24) + bytes(range(16)) + struct.pack("<H", len(entries))
    return out + b"".join(struct.pack("<HHIi", tag, 9, 1, v) for tag, v in entries) + b"\0" * 4


BAD = [dict(rows=0), dict(rows=-1), dict(samples=0), dict(samples=-2), dict(width=-4), dict(height=0), dict(width=None), dict(bits=12), dict(compression=7), dict(planes=3), dict(planes=0), dict(predictor=9), dict(starts=None), dict(counts=-5), dict(starts=-9), dict(starts=10**6), dict(counts=3),
       dict(tile_width=4), dict(tile_width=4, tile_height=0, tile_starts=8, tile_counts=16), dict(tile_width=-4, tile_height=4, tile_starts=8, tile_counts=16), dict(width=2**31 - 1, height=2**31 - 1), dict(width=1, height=1, rows=2**31 - 1, tile_width=2**31 - 1, tile_height=2**31 - 1, tile_starts=8, tile_counts=16), dict(compression=5), dict(compression=8)]


def test_malformed_tags_give_error_rows(spark):
    assert [p[7] for p in read_tiff(tagged())] == [bytes(range(16))]
    rows = [(i, bytearray(tagged(**bad))) for i, bad in enumerate(BAD)] + [(len(BAD), bytearray(tagged()))]
    got = {r.id: r for r in tiff_pages(spark.createDataFrame(rows, "id int, media binary")).collect()}
    assert len(got) == len(rows)
    assert all(got[i].error and got[i].page is None for i in range(len(BAD))), [BAD[i] for i in range(len(BAD)) if not got[i].error]
    assert bytes(got[len(BAD)].pixels) == bytes(range(16))


def test_damaged_files_never_fail(spark):
    """Every byte of a file changed, and every cut of it: rows or an error row, never a failed task."""
    whole = write_tiff([(np.arange(48) % 7).astype(np.uint8).reshape(6, 8)] * 2, LZW, 2, rows_per_strip=3)
    rng = np.random.default_rng(7)
    files = [whole[:i] for i in range(0, len(whole), 5)] + [whole[:i] + bytes([int(rng.integers(256))]) + whole[i + 1 :] for i in range(len(whole))]
    got = tiff_pages(spark.createDataFrame([(i, bytearray(f)) for i, f in enumerate(files)], "id int, media binary"), max_page_bytes=1 << 20).collect()
    assert {r.id for r in got} == set(range(len(files)))


def test_clashing_names_and_case(spark):
    good = bytearray(write_tiff([np.zeros((2, 3), np.uint8)]))
    (row,) = tiff_pages(spark.createDataFrame([(good, "a", "b", "c")], "media binary, Page string, `x.y` string, error string")).collect()
    assert row["x.y"] == "b" and row["page"] == 0 and row["error"] is None and "Page" not in row
