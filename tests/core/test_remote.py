import hashlib
import json
import threading
import urllib.parse
import uuid
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from docflow import cli, config
from docflow.operators.registry import load
from docflow.plans import jobs
from docflow.sources.remote import HttpListing, Remote, reader_of

#: id: (name, mime, parent); folders of the top level, one below, and one that holds itself.
TREE = {f"f{i}": (f"doc {i}.pdf", "application/pdf", "root") for i in range(7)}
TREE |= {"d1": ("one", "application/vnd.folder", "root"), "d2": ("two", "application/vnd.folder", "root"), "d3": ("deep", "application/vnd.folder", "d1"), "d2 ": ("loop", "application/vnd.folder", "d2")}
TREE |= {f"g{i}": (f"g{i}.pdf", "application/pdf", "d1") for i in range(5)} | {"h": ("h.pdf", "application/pdf", "d3"), "n": ("note.txt", "text/plain", "d2"), "gone": ("gone.pdf", "application/pdf", "d2")}


@pytest.fixture
def server():
    asked, flaky = [], {"2"}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            url = urllib.parse.urlparse(self.path)
            query = dict(urllib.parse.parse_qsl(url.query))
            asked.append(self.path)
            code, body = 200, b""
            if url.path == "/drive/files":
                page = query.get("pageToken", "0")
                if query["parent"] == "root" and page in flaky:  # once
                    flaky.discard(page)
                    code = 503
                own = [{"id": k, "name": n, "mimeType": m} for k, (n, m, p) in TREE.items() if p == query["parent"]]
                at = int(page)
                body = json.dumps({"files": own[at : at + 2]} | ({"nextPageToken": str(at + 2)} if at + 2 < len(own) else {})).encode()
            elif url.path.startswith("/drive/files/"):
                key = urllib.parse.unquote(url.path.rsplit("/", 1)[-1])
                code, body = (404, b"") if key == "gone" else (200, f"bytes of {key}".encode())
            else:
                body = b"<html>"
            self.send_response(code)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}", asked
    httpd.shutdown()


def test_paged_listing(spark, server):
    base, asked = server
    spark.dataSource.register(HttpListing)
    listing = spark.read.format("http_listing").load(f"{base}/drive")
    got = {r.id: r.path for r in listing.collect()}
    assert set(got) == set(TREE) and got["h"] == "one/deep/h.pdf" and got["f3"] == "doc 3.pdf" and got["d2 "] == "two/loop"
    assert listing.rdd.getNumPartitions() >= 7  # five pages of the top level and its two folders
    assert sum("parent=root" in a and "pageToken=2" in a for a in asked) >= 2  # asked again after 503


def test_errors_are_clear(server):
    base, _ = server
    with pytest.raises(OSError, match="doesn't answer with a listing"):
        Remote(f"{base}/other").page("root")
    with pytest.raises(OSError, match="404"):
        reader_of(f"{base}/drive")("gone")
    with pytest.raises(ValueError, match="http or https"):
        Remote("ftp://x").page("root")


def test_download_over_http(spark, server, tmp_path, monkeypatch, capsys):
    base, _ = server
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    assert cli.main(["download", "--root", str(tmp_path), "--from", f"{base}/drive"]) == 1  # one is gone
    said = capsys.readouterr().out
    assert "14 to have, 5 skipped" in said and "failed: gone.pdf" in said and "404" in said
    have = {p.name for p in (tmp_path / "to_translate").iterdir() if not p.name.startswith(".")}
    assert have == {n for n, m, _ in TREE.values() if m.endswith("pdf")} - {"gone.pdf"}
    assert (tmp_path / "to_translate/g3.pdf").read_text() == "bytes of g3"


def test_import_of_partial_caches_by_job(spark, tmp_path):
    def store(df):
        path = f"{tmp_path}/steps/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    (tmp_path / "to_translate").mkdir()
    (tmp_path / "to_translate/a.pdf").write_text("The first text of it is here.\n\n" + "And the second text. " * 20)
    c = config.load(None, str(tmp_path))
    jobs.extract(spark, c, f"{tmp_path}/r", store, engine="text")
    sha = load(spark, f"{tmp_path}/r").first().sha256
    (tmp_path / "old").mkdir()
    (tmp_path / "old/a.json").write_text(json.dumps({"src_sha": sha, "blocks": {"1": "TAKEN UP"}}))
    run = lambda: jobs.import_cache(spark, c, f"{tmp_path}/r", f"{tmp_path}/blocks", store, f"{tmp_path}/old")
    assert run() == 1 and run() == 0
    [row] = spark.read.parquet(f"{tmp_path}/blocks").collect()
    assert (row.src_sha, row.text) == (hashlib.sha256(b"The first text of it is here.").hexdigest(), "TAKEN UP")
    jobs.translate(spark, c, f"{tmp_path}/r", f"{tmp_path}/blocks", store, "upper", slots=2)
    md = (tmp_path / "translated_md/a/a.he.md").read_text("utf-8")
    assert "TAKEN UP" in md and "AND THE SECOND TEXT." in md
