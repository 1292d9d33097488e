import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from docflow import config, engines
from docflow.engines import TRANSLATORS, failing
from docflow.operators import report, translate
from docflow.operators.registry import load
from docflow.plans import jobs
from docflow.sources import files, sinks
from docflow.streaming.ingest import ingest

EN = "The house by the sea and the garden of that man were old and it was for the cat. " * 4


@pytest.fixture
def store(spark, tmp_path):
    def run(df):
        path = f"{tmp_path}/steps/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return run


@pytest.fixture
def root(tmp_path):
    src = tmp_path / "to_translate"
    src.mkdir()
    (src / "b one.PDF").write_text(f"# Title\n\n{EN}\n\n![](images/a b.png)\f{EN}")
    (src / "a.pdf").write_text("short")
    (src / "copy.pdf").write_text("short")
    (src / "note.txt").write_text("no")
    return tmp_path


def test_from_files_to_index(spark, root, store):
    c = config.load(None, str(root))
    reg = f"{root}/registry"
    out = {r.original_name: r for r in jobs.extract(spark, c, reg, store, engine="text", ocr="text").collect()}
    assert set(out) == {"a.pdf", "b one.PDF"} and out["a.pdf"].duplicates == ["copy.pdf"]
    assert (out["b one.PDF"].step1.status, out["b one.PDF"].step1.mode, out["b one.PDF"].page_count, out["b one.PDF"].source_lang) == ("done", "text", 2, "en")
    assert out["a.pdf"].step1.mode == "ocr" and (root / "step1_md/a/a.md").read_text() == "<!-- page 1 (lang=eng) -->\n\nshort"

    TRANSLATORS["flaky"] = lambda: failing("house", 99, "boom")
    options = dict(sleep=lambda s: None, slots=2)
    first = {r.original_name: r.translation_md for r in jobs.translate(spark, c, reg, f"{root}/blocks", store, "flaky", **options).collect()}
    assert first["a.pdf"].status == "done" and first["b one.PDF"].status == "error" and first["b one.PDF"].partial_blocks_done >= 1
    cached = spark.read.parquet(f"{root}/blocks").count()
    second = {r.original_name: r.translation_md for r in jobs.translate(spark, c, reg, f"{root}/blocks", store, "upper", **options).collect()}
    assert second["b one.PDF"].status == "done" and spark.read.parquet(f"{root}/blocks").count() > cached
    md = (root / second["b one.PDF"].translated_md_relpath).read_text("utf-8")
    assert md.startswith("<!-- Translated automatically from b one.PDF via upper on ") and "# TITLE" in md and "../../step1_md/b%20one/images/a%20b.png" in md and "THE HOUSE" in md

    counts = {r.outcome: r.n for r in jobs.summaries(spark, c, reg, store, "latin").collect()}
    assert counts == {"summarized": 1, "empty": 1}
    assert {r.outcome: r.n for r in jobs.summaries(spark, c, reg, store, "latin").collect()} == {"cached": 1, "empty": 1}
    page = jobs.index(spark, c, reg)
    assert page.count("<tr>") == 2 and f"<strong>2</strong>{report.COUNTERS['translated']}" in page and "summary-text" in page
    assert page.count("<th>") == 10 and re.search(report.MADE_AT + r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", page)


HEBREW = "המאמר הזה עוסק בתולדות היישוב בארץ ישראל והוא מבוסס על מקורות רבים של החוקרים שלא הכירו זה את זה"


def test_target_language_errors_and_images(spark, root, store):
    """A Hebrew file ends as already_hebrew, a broken one tells the reader's error, and pictures are written and counted."""
    (root / "to_translate/he.pdf").write_text(f"{HEBREW}\n\n{HEBREW} " * 4, "utf-8")
    (root / "to_translate/bad.pdf").write_text("broken")

    def reader(content):
        if content == b"broken":
            raise ValueError("no trailer found")
        return engines.form_feed_pages(content)

    engines.EXTRACTORS["picky"], engines.IMAGES["picky"] = reader, lambda content: iter([("png", b"1"), ("jpg", b"22")] if b"images/" in content else [])
    c = config.load(None, str(root))
    out = {r.original_name: r for r in jobs.extract(spark, c, f"{root}/r", store, engine="picky").collect()}
    assert (out["bad.pdf"].step1.status, out["bad.pdf"].step1.error) == ("error", "no trailer found")
    one = out["b one.PDF"].step1
    assert (one.image_count, one.images_dir_relpath) == (2, "step1_md/b one/images") and (root / "step1_md/b one/images/image-0002.jpg").read_bytes() == b"22"
    assert out["he.pdf"].source_lang == "he" and out["he.pdf"].step1.image_count == 0 and out["he.pdf"].step1.images_dir_relpath is None
    done = {r.original_name: r.translation_md for r in jobs.translate(spark, c, f"{root}/r", f"{root}/blocks", store, "upper", slots=2).collect()}
    assert done["he.pdf"].status == "already_hebrew" and done["b one.PDF"].status == "done" and done["bad.pdf"] is None


def test_a_lost_run_pays_for_one_slice_at_most(spark, root, store, monkeypatch):
    c = config.load(None, str(root))
    jobs.extract(spark, c, f"{root}/r", store, engine="text")
    (root / "step1_md/b one/b one.md").write_text("\n\n".join(f"The text number {i} of it" for i in range(40)))
    kept, real = [], translate.run_engine

    def run(texts, *a, **k):
        kept.append(texts.count())
        if len(kept) == 4:
            raise RuntimeError("the driver is lost")
        return real(texts, *a, **k)

    monkeypatch.setattr(translate, "run_engine", run)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.translate(spark, c, f"{root}/r", f"{root}/blocks", store, "upper", slots=2, slice_texts=7)
    assert spark.read.parquet(f"{root}/blocks").count() == sum(kept[:3]) > 10
    before, total = sum(kept[:3]), len(kept)
    jobs.translate(spark, c, f"{root}/r", f"{root}/blocks", store, "upper", slots=2, slice_texts=7)
    assert sum(kept[total:]) + before == spark.read.parquet(f"{root}/blocks").count() and sum(kept[total:]) < 40


def test_import_of_partial_caches(spark, root):
    md = "# Head\n\nProse one.\n\n- a\n- b\n\nother"
    docs = spark.createDataFrame([("s1", md)], "sha256 string, md string")
    (root / "cache").mkdir()
    (root / "cache/a.json").write_text(json.dumps({"src_sha": "s1", "blocks": {"1": "# KOPF", "3": "PROSA", "5": "- A\n- B", "x": "no", "7": "OTHER"}}))
    (root / "cache/b.json").write_text(json.dumps({"src_sha": "gone", "blocks": {"1": "# X"}}))
    (root / "cache/c.json").write_text("not json")
    partial = translate.partial_cache(spark, str(root / "cache"))
    assert {(r.key, r.block_idx) for r in partial.collect()} == {("s1", 1), ("s1", 3), ("s1", 5), ("s1", 7), ("gone", 1)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r.src_sha: r.text for r in translate.from_partial(partial, docs).collect()}
    assert got == {sha("Head"): "KOPF", sha("Prose one."): "PROSA", sha("a"): "A", sha("b"): "B", sha("other"): "OTHER"}


def test_docx_flow(spark, root, store):
    (root / "to_translate/he.pdf").write_text(HEBREW, "utf-8")
    (root / "to_translate/bad.pdf").write_text(EN + " poison")
    engines.TRANSLATORS["poison"] = lambda: failing("poison", 99, "boom")
    c = config.load(None, str(root))
    run = lambda engine, **k: {r.original_name: r.translation_docx for r in jobs.translate_docx(spark, c, f"{root}/r", store, engine, "text", sleep=lambda s: None, slots=2, **k).collect()}
    first = run("poison")
    assert {n: d.status for n, d in first.items()} == {"a.pdf": "translated", "b one.PDF": "translated", "he.pdf": "already_hebrew", "bad.pdf": "error"}
    assert "boom" in first["bad.pdf"].error and first["bad.pdf"].original_relpath == "error_translate/bad.pdf"
    assert (root / "error_translate/bad.pdf").exists() and not (root / "to_translate/bad.pdf").exists()
    assert (root / "translated/he/he.pdf").exists() and first["he.pdf"].translated_relpath is None
    assert (root / "translated/b one/b one.PDF").exists() and first["b one.PDF"].translated_relpath == "translated/b one/b one.he.docx"
    assert "THE HOUSE" in zipfile.ZipFile(root / "translated/b one/b one.he.docx").read("word/document.xml").decode()
    assert run("poison") == first
    (root / "error_translate/bad.pdf").rename(root / "to_translate/bad.pdf")
    assert run("upper")["bad.pdf"].status == "error" and run("upper", reset_errors=True)["bad.pdf"].status == "translated"
    page = jobs.plain_index(spark, f"{root}/r")
    assert page.count("<th>") == 6 and page.count("<tr>") == 4


def test_fix_images_and_chosen_summaries(spark, root, store):
    c = config.load(None, str(root))
    jobs.extract(spark, c, f"{root}/r", store, engine="text", ocr="text")
    jobs.translate(spark, c, f"{root}/r", f"{root}/blocks", store, "upper", slots=2)
    path = root / "translated_md/b one/b one.he.md"
    path.write_text("x ![](images/c d.png) ![](https://h/x.png)")
    assert jobs.fix_images(spark, c, f"{root}/r", store).first().asDict() == {"files": 2, "changed": 1, "failed": 0}
    assert path.read_text() == "x ![](../../step1_md/b%20one/images/c%20d.png) ![](https://h/x.png)"
    assert jobs.fix_images(spark, c, f"{root}/r", store).first().changed == 0
    path.write_text(EN * 3)
    assert {r.outcome: r.n for r in jobs.summaries(spark, c, f"{root}/r", store, "latin", only="a*").collect()} == {"empty": 1}
    sha = load(spark, f"{root}/r").filter("original_name = 'b one.PDF'").first().sha256
    assert {r.outcome: r.n for r in jobs.summaries(spark, c, f"{root}/r", store, "latin", sha=sha[:8]).collect()} == {"summarized": 1}
    assert sum(r.n for r in jobs.summaries(spark, c, f"{root}/r", store, "latin", limit=1).collect()) == 1
    assert load(spark, f"{root}/r").count() == 2


def test_download_takes_what_is_missing(spark, root, store, tmp_path):
    spark.dataSource.register(files.RemoteListing)
    c = config.load(None, str(tmp_path / "other"))
    remote = spark.read.format("remote_listing").load(str(root / "to_translate"))

    def flaky(key, read=files.reader_of(str(root / "to_translate"))):
        if key == "copy.pdf":
            raise OSError("gone")
        return read(key)

    got = {r.name: r.error for r in jobs.download(spark, c, store, remote, flaky).collect()}
    assert got == {"a.pdf": None, "b one.PDF": None, "copy.pdf": "gone"} and (tmp_path / "other/to_translate/a.pdf").read_text() == "short"
    again = {r.name: r.error for r in jobs.download(spark, c, store, remote, files.reader_of(str(root / "to_translate"))).collect()}
    assert again == {"copy.pdf": None}


def test_ocr_renders_a_page_once(spark):
    calls = []
    engine = engines.RasterOcr(lambda content, page, dpi: calls.append((page, dpi)) or content, lambda picture, lang, command, data: 1 / 0 if lang == "heb" else f"{lang} {command}", dpi=144, command="c")
    texts = engine(b"x", 3, ["eng", "heb"])
    assert texts[0] == "eng c" and isinstance(texts[1], ZeroDivisionError) and calls == [(3, 144)]
    engines.OCRS["counted"] = lambda **settings: engine
    docs = spark.createDataFrame([("s", bytearray(b"x"))], "sha256 string, content binary")
    numbers = spark.createDataFrame([("s", i) for i in range(1, 8)], "sha256 string, page_no int")
    got = files.ocr_candidates(docs, numbers, ["eng", "heb"], "counted", part=3).collect()
    assert sorted((r.page_no, r.lang, r.text, r.error) for r in got if r.page_no in (1, 7)) == [(p, *x) for p in (1, 7) for x in (("eng", "eng c", None), ("heb", None, "division by zero"))] and len(got) == 14


def test_programs_are_found(tmp_path):
    (tmp_path / "bin/tessdata").mkdir(parents=True)
    (tmp_path / "bin/prog").write_text("#!/bin/sh\n")
    (tmp_path / "bin/prog").chmod(0o755)
    home = str(tmp_path / "bin/prog"), str(tmp_path / "bin/tessdata")
    assert engines.find_program("prog", environ={}) == ("", "")
    assert engines.find_program("prog", environ={"PATH": str(tmp_path / "bin")}) == home == engines.find_program("prog", folders=(str(tmp_path / "bin"),), environ={}) == engines.find_program("prog", command=home[0], environ={})
    assert engines.find_program("prog", command=home[0], environ={"TESSDATA_PREFIX": str(tmp_path)})[1] == str(tmp_path)


def test_pictures_of_a_simple_pdf():
    pixels = bytes(range(24))
    stream = lambda head, body: b"1 0 obj <<" + head + b">>\nstream\n" + body + b"\nendstream endobj\n"
    pdf = stream(b"/Subtype /Image /Width 4 /Height 2 /BitsPerComponent 8 /ColorSpace /DeviceRGB /Filter /FlateDecode", zlib.compress(pixels)) + stream(b"/Subtype /Image /Filter /DCTDecode", b"\xff\xd8jpeg") + stream(b"/Subtype /Image /Width 9 /Height 9 /BitsPerComponent 1 /ColorSpace /DeviceGray", b"?")
    (a, data), (b, jpg) = engines.simple_pdf_images(pdf)
    assert (a, b, jpg) == ("png", "jpg", b"\xff\xd8jpeg") and data[:8] == b"\x89PNG\r\n\x1a\n"
    size = struct.unpack(">I", data[33:37])[0]
    raw = zlib.decompress(data[41 : 41 + size])
    assert raw == b"\0" + pixels[:12] + b"\0" + pixels[12:] and struct.unpack(">II", data[16:24]) == (4, 2)


def test_cli(spark, root, capsys, monkeypatch):
    from docflow import cli

    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    other = root / "cli"
    assert cli.main(["download", "--root", str(other), "--from", str(root / "to_translate")]) == 0
    for job in (["extract", "--engine", "text"], ["translate", "--engine", "upper", "--only", "b*"], ["fix-images"], ["summarize", "--script", "latin", "--limit", "1"], ["index"], ["docx", "--engine", "upper", "--reset-errors", "--limit", "1"], ["plain-index"]):
        assert cli.main([job[0], "--root", str(other), *job[1:]]) == 0
    assert report.TITLE in (other / "index.html").read_text("utf-8")
    assert cli.main(["config", "--root", str(other)]) == 0 and '"chunk_char_limit"' in capsys.readouterr().out


def test_a_second_run_does_nothing(spark, root, store):
    c = config.load(None, str(root))
    jobs.extract(spark, c, f"{root}/r", store, engine="text")
    before = sorted(map(str, load(spark, f"{root}/r").collect()))
    jobs.extract(spark, c, f"{root}/r", store, engine="text")
    assert sorted(map(str, load(spark, f"{root}/r").collect())) == before


def test_streaming_takes_each_file_once(spark, root):
    run = lambda: ingest(spark, str(root / "to_translate"), f"{root}/sr", f"{root}/cp")
    assert {r.original_name: r.duplicates for r in run().collect()} == {"a.pdf": ["copy.pdf"], "b one.PDF": []}
    (root / "to_translate/new.pdf").write_text("new")
    assert run().count() == 3
    before = sorted(map(str, run().collect()))
    assert sorted(map(str, run().collect())) == before


def test_remote_listing_and_fetch(spark, root):
    spark.dataSource.register(files.RemoteListing)
    remote = spark.read.format("remote_listing").load(str(root / "to_translate"))
    wanted, skipped = files.targets(remote)
    assert {r.name for r in wanted.collect()} == {"a.pdf", "copy.pdf", "b one.PDF"} and {r.name for r in skipped.collect()} == {"note.txt"}

    def download(key):
        if key == "copy.pdf":
            raise OSError("gone")
        return b"bytes"

    present = spark.createDataFrame([("a.pdf", 5), ("b one.PDF", 0)], "name string, size long")
    assert {r.name: (r.content, r.error) for r in files.fetch(wanted, present, download).collect()} == {"copy.pdf": (None, "gone"), "b one.PDF": (b"bytes", None)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("x/a.md", "é"), ("../up.md", "no")], "path string, content string")
    got = {r.path: (r.bytes, r.error is None) for r in sinks.write_files(df, str(tmp_path)).collect()}
    assert got == {"x/a.md": (2, True), "../up.md": (None, False)} and (tmp_path / "x/a.md").read_text("utf-8") == "é" and not (tmp_path.parent / "up.md").exists()
    from docflow.operators.pages import docx_paragraphs

    pages = spark.createDataFrame([("k", 1, "one\n\n two <b>"), ("k", 2, " \n")], "sha256 string, page_no int, text string")
    docs = spark.createDataFrame([("k", "Title", ["m1"], "k.docx")], "sha256 string, title string, meta array<string>, path string")
    data = sinks.docx_files(docs, docx_paragraphs(pages)).first().content
    xml = zipfile.ZipFile(BytesIO(data)).read("word/document.xml").decode()
    assert xml.count("<w:p>") == 8 and "two &lt;b&gt;" in xml and "<w:bidi/>" in xml
    bad = sinks.quarantine(spark.createDataFrame([("s", "f.pdf", bytearray(b"1")), ("t", "g.pdf", bytearray(b"2"))], "sha256 string, name string, content binary"), spark.createDataFrame([("s", "error"), ("t", "done")], "sha256 string, status string"), str(tmp_path / "bad"))
    assert [r.path for r in bad.collect()] == ["f.pdf"]


def test_pages_through_an_engine(spark, store):
    pages = spark.createDataFrame([("k", 1, "one\ntwo"), ("k", 2, "  "), ("k", 3, "x" * 12)], "sha256 string, page_no int, text string")
    got = {r.page_no: r.text for r in translate.translate_pages(pages, "upper", store, limit=5).collect()}
    assert got == {1: "ONE\nTWO", 2: "", 3: "XXXXX\nXXXXX\nXX"}


def test_plain_index(spark):
    df = spark.createDataFrame([("s", "n<.pdf", True, 3, "en", ("translated", "t.docx", "o.pdf", None, "at")), ("t", "m", False, None, None, ("error", None, None, "<e>", None))], "sha256 string, original_name string, has_pictures boolean, page_count int, source_lang string, translation_docx struct<status: string, translated_relpath: string, original_relpath: string, error: string, translated_at: string>")
    rows = [r.row for r in report.plain_rows(df).collect()]
    assert "&lt;e&gt;" in rows[0] and '<a href="t.docx">DOCX</a>' in rows[1] and 'href="o.pdf">n&lt;.pdf</a>' in rows[1]
    assert report.page(report.plain_rows(df), None, "now").count("<tr>") == 2
    assert F is not None
