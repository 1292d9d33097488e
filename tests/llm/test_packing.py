import zlib

import numpy as np
import pytest

from docflow.llm.packing import best_fit, default_tokenizer, encoder, lower_bound, pack, pieces

TEXTS = ["", None, "one", "a  b", " lead", "trail ", "don't 'tis  x's", "\n it\t x\n\n y ", "é ñ 漢字 😀", "a b c", "<|endoftext|> x y", "word " * 3000, "x" * 5000, "one"]


def test_pieces_are_the_tokenizers_ids(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_tokenizer())
    rows = [(i, t, "extra") for i, t in enumerate(TEXTS)]
    got = pieces(spark.createDataFrame(rows, "doc_id long, text string, length string"), default_tokenizer(), with_ids=True).collect()
    for i, t in enumerate(TEXTS):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == ids
        assert [r.piece for r in own] == list(range(len(own))) and [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1])
        assert all(r.length == 2048 for r in own[1:]) and all(r.ids_crc32 == zlib.crc32(r.ids) for r in own)


def test_bounds_and_best_fit():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sizes = rng.integers(1, 101, rng.integers(1, 200))
        bins, offsets, used = best_fit(sizes, 100)
        assert lower_bound(sizes, 100) <= used
        for b in range(used):
            own = sorted(zip(offsets[bins == b], sizes[bins == b]))
            assert own[0][0] == 0 and all(a + n == c for (a, n), (c, _) in zip(own, own[1:])) and own[-1][0] + own[-1][1] <= 100
    assert lower_bound(np.array([51] * 10), 100) == 10
    assert lower_bound(np.array([34] * 10), 100) == 5


@pytest.mark.parametrize("part_rows", [7, 1000])
def test_pack_is_gapless_and_whole(spark, part_rows):
    rng = np.random.default_rng(1)
    rows = [(int(i), 0, int(n)) for i, n in enumerate(rng.integers(1, 2049, 150))]
    got = pack(spark.createDataFrame(rows, "doc_id long, piece int, length long"), part_rows=part_rows).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in got) == rows
    for s in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_later_rounds(spark):
    """Bins saved in rounds 1 to 3 get ids of their own; every piece stays, without gaps, and no round takes more bins."""
    rows = [(i, 0, int(n)) for i, n in enumerate(np.random.default_rng(3).integers(300, 1100, 600))]
    items = spark.createDataFrame(rows, "doc_id long, piece int, length long")
    used = []
    for rounds in range(4):
        got = pack(items, part_rows=50, rounds=rounds).collect()
        check(got)
        assert sorted((r.doc_id, r.piece, r.length) for r in got) == rows
        used.append(len({r.sequence_id for r in got}))
    assert used == sorted(used, reverse=True) and used[3] < used[0]
    levels = {r.sequence_id >> 58 for r in got}
    assert max(levels) >= 2 and min(levels) == 0


def check(got):
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0) and r.sequence_id >= 0
        at[r.sequence_id] = r.offset + r.length
        assert at[r.sequence_id] <= 2048


def test_null_and_repeated_ids_are_dealt_out(spark):
    rows = [(None, 0, 700 + i % 9) for i in range(150)] + [(7, 0, 900)] * 150
    got = pack(spark.createDataFrame(rows, "doc_id long, piece int, length long"), part_rows=30, rounds=0).collect()
    check(got)
    assert sorted(((r.doc_id, r.length) for r in got), key=str) == sorted(((d, n) for d, _, n in rows), key=str)
    groups = [r.sequence_id >> 31 for r in got]
    assert len(set(groups)) == 10 and max(map(groups.count, groups)) < 90


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, 5, "p", "o", "s", "r")], "doc_id long, piece int, length long, part string, open string, Sequence_ID string, row string")
    (row,) = pack(df).collect()
    assert row.asDict() == {"doc_id": 1, "piece": 0, "length": 5, "part": "p", "open": "o", "row": "r", "sequence_id": 0, "offset": 0, "certified": True}


def test_both_libraries_agree(spark):
    """The faster library reads the same vocabulary; its ids are the tokenizer's, over whole texts of the tables and odd ones."""
    from tokenizers import Tokenizer

    tok, enc = Tokenizer.from_file(default_tokenizer()), encoder(default_tokenizer())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    odd = ["".join(map(chr, row)) for row in np.random.default_rng(5).choice([9, 10, 32, 32, 39, 65, 97, 115, 116, 48, 0xE9, 0x301, 0x5D0, 0x4E2D, 0x1F600, 0xA0, 0x2028, 0x3000], (400, 24))]
    for t in [*(t or "" for t in texts), *odd]:
        assert np.frombuffer(enc.ids(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_empty_table(spark):
    assert pack(pieces(spark.createDataFrame([], "doc_id long, text string"), default_tokenizer())).count() == 0
