import hashlib

import pyarrow as pa
import pytest

from docflow.llm import warc
from docflow.llm.warc import member, op8_warc, records, register, render

ROWS = [
    dict(record_type="response", record_id="<a>", target_uri="http://x/ y\n", payload=b"<p>" * 40_000, content_type="text/html"),
    dict(record_type="metadata", record_id="<b>", payload=b"\r\n\r\nWARC/1.1\r\n", content_type="text/plain"),
    dict(record_type="revisit", record_id="<c>", refers_to="<a>", payload_bytes=120_000, payload=None),
    dict(record_type="response", record_id="<d>", payload=b""),
]


@pytest.mark.parametrize("packed", [lambda r: r, member, None])
def test_records_come_back_and_are_skipped_undecoded(packed):
    import gzip

    data = gzip.compress(b"".join(map(render, ROWS))) if packed is None else b"".join(packed(render(r)) for r in ROWS)
    got = list(records(pa.BufferReader(data), lambda h: True, True))
    assert [h["warc-record-id"] for h, _ in got] == ["<a>", "<b>", "<c>", "<d>"]
    assert [warc._payload(h, b) for h, b in got] == [ROWS[0]["payload"], ROWS[1]["payload"], None, b""]
    assert [h["warc-record-id"] for h, _ in records(pa.BufferReader(data), lambda h: h["warc-type"] == "response", False)] == ["<a>", "<d>"]
    for cut in (10, len(data) // 2, len(data) - 30):
        assert len([r for r in records(pa.BufferReader(data[:cut]), lambda h: True, True)]) <= 4


def test_source_pushes_predicates(spark, tmp_path):
    register(spark)
    df = spark.createDataFrame([(r["record_type"], r["record_id"], r.get("payload")) for r in ROWS] * 5, "record_type string, record_id string, payload binary")
    for gzip in ("true", "false"):
        path = f"{tmp_path}/{gzip}"
        df.write.format("warc").mode("append").option("gzip", gzip).option("file_bytes", 1000).save(path)
        got = spark.read.format("warc").option("split_bytes", 1000).load(path).filter("record_type = 'response' and record_id in ('<a>', '<b>') and record_id like '<%'")
        assert [len(r.payload) for r in got.select("payload").collect()] == [120_000] * 5
        assert spark.read.format("warc").schema("record_id string, payload_bytes long").load(path).filter("record_id = '<d>'").count() == 5
        assert spark.read.format("warc").load(path).count() == 20
    reader = warc.WarcReader("file:///none", spark.createDataFrame([], "record_id string").schema, 1)
    assert list(reader.pushFilters([warc.EqualTo(("record_id",), "x"), warc.EqualTo(("payload",), b"x")])) == [warc.EqualTo(("payload",), b"x")]


def test_damaged_files(spark, tmp_path):
    """Records before the damage stay and one error row follows; the read fails only where asked to."""
    register(spark)
    good = b"".join(map(render, ROWS))
    bad = {
        "text.warc": b"hello\r\n\r\nworld",
        "number.warc": good + render(ROWS[3]).replace(b"\r\nContent-Length: ", b"\r\nContent-Length: x"),
        "negative.warc": good + b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: -7\r\n\r\nabc",
        "bytes.warc.gz": member(good) + member(b"".join(map(render, ROWS)))[:60] + b"\xff" * 400,
        "cut.warc": good + render(ROWS[0])[:300],
    }
    for name, data in bad.items():
        (tmp_path / name).write_bytes(data)
        got = spark.read.format("warc").load(f"{tmp_path}/{name}").collect()
        errors = [r.error for r in got if r.error]
        assert len(errors) == (name != "cut.warc") and all(name in e for e in errors)
        assert len([r for r in got if r.record_id]) >= (0 if name == "text.warc" else 4)
        assert spark.read.format("warc").load(f"{tmp_path}/{name}").filter("record_type = 'metadata'").count() >= (name != "text.warc")
        if name != "cut.warc":
            with pytest.raises(Exception, match=name):
                spark.read.format("warc").option("mode", "failfast").load(f"{tmp_path}/{name}").collect()
    assert spark.read.format("warc").load(str(tmp_path)).filter("error is null").count() >= 16


def test_revisits_are_held_against_their_response(spark, tmp_path):
    register(spark)
    rows = [("response", "<urn:page:9>", None, None, bytearray(b"abc"), None), ("revisit", "<urn:page:1>", "<urn:page:9>", "sha1:" + hashlib.sha1(b"abc").hexdigest(), None, 77), ("revisit", "<urn:page:2>", "<urn:page:9>", "sha1:other", None, 5), ("revisit", "<urn:page:3>", "<urn:page:8>", "sha1:gone", None, 6)]
    spark.createDataFrame(rows, "record_type string, record_id string, refers_to string, payload_digest string, payload binary, payload_bytes long").write.format("warc").mode("append").save(f"{tmp_path}/w")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.pages_of(f"{tmp_path}/w", spark).collect()}
    sha = hashlib.sha1(b"abc").hexdigest()
    assert got == {9: (3, sha, "response", None), 1: (3, sha, "revisit", 9), 2: (5, "other", "revisit", 9), 3: (6, "gone", "revisit", 8)}


def test_query(spark, tmp_path):
    big, other = "é" * 500, "b" * 999
    rows = [(1, "u", big, 1), (2, None, big, 1), (3, "u", other, 1), (4, "u", other, 1), (5, "u", None, 1), (6, "u", "", 1), (9, "u", big, 1), (None, "u", big, 1), (9, "v", big, 1)]
    spark.createDataFrame(rows, "page_id long, url string, html string, payload int").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op8_warc(spark, str(tmp_path)).collect()), key=str)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = [(i, len((t or "").encode()), sha(t), *(("revisit", 9) if t == big and i != 9 else ("response", None))) for i, _, t, _ in rows]
    assert got == sorted(want, key=str)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert op8_warc(spark, str(tmp_path)).count() == 0
