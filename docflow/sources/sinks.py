"""Files from tables: one file per row, written by the tasks into a folder that all of them share.

A file is written under a hidden name and then moved, so a repeated task leaves whole files only. Jobs write in two steps with a
manifest between them, so that every file's outcome is known to its document, and a run that is lost is completed.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_files(df: DataFrame, folder: str, path: str = "path", content: str = "content") -> DataFrame:
    """Writes content (text or bytes) below folder by path; returns (path, bytes, error), a row for each file. Call an action."""
    root_uri = folder if "://" in folder else f"file://{folder}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(root_uri)
        for batch in batches:
            rows = []
            for name, data in zip(batch[path], batch[content]):
                try:
                    if name.startswith("/") or ".." in name.split("/"):
                        raise ValueError("the path leaves the folder")
                    data = data.encode() if isinstance(data, str) else bytes(data)
                    target = f"{root}/{name}"
                    parent, _, base = target.rpartition("/")
                    fs.create_dir(parent, recursive=True)
                    hidden = f"{parent}/.{base}.{uuid.uuid4().hex}"
                    with fs.open_output_stream(hidden) as out:
                        out.write(data)
                    fs.move(hidden, target)
                    rows.append((name, len(data), None))
                except Exception as e:
                    rows.append((name, None, str(e)[:500]))
            yield pd.DataFrame(rows, columns=["path", "bytes", "error"])

    return df.select(path, content).mapInPandas(run, "path string, bytes long, error string")


MANIFEST = "key string, path string, staged string, bytes long, sha256 string, error string"
OUTCOME = "key string, path string, bytes long, sha256 string, error string"


def stage_files(df: DataFrame, folder: str, run: str, key: str = "sha256", path: str = "path", content: str = "content", known: DataFrame | None = None) -> DataFrame:
    """The first step of a write: each row's content (text or bytes) under a hidden name beside its target; a row of MANIFEST for
    each. Content that known (path, sha256) says is there already, and whose file has its length, isn't written: staged is null."""
    root_uri = folder if "://" in folder else f"file://{folder}"
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(path).alias("path"), F.col(content).alias("content"))
    if known is None:
        rows = rows.withColumn("known", F.lit(None).cast("string"))
    else:
        rows = rows.join(known.groupBy("path").agg(F.max("sha256").alias("known")), "path", "left").select("key", "path", "content", "known")

    def stage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import uuid

        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(root_uri)
        for batch in batches:
            out = []
            for key, name, data, sha in zip(batch["key"], batch["path"], batch["content"], batch["known"]):
                try:
                    if name.startswith("/") or ".." in name.split("/"):
                        raise ValueError("the path leaves the folder")
                    data = data.encode() if isinstance(data, str) else bytes(data)
                    own = hashlib.sha256(data).hexdigest()
                    there = fs.get_file_info(f"{root}/{name}") if own == sha else None
                    if there is not None and there.type == pafs.FileType.File and there.size == len(data):
                        out.append((key, name, None, len(data), own, None))
                        continue
                    parent, _, base = name.rpartition("/")
                    fs.create_dir(f"{root}/{parent}", recursive=True)
                    hidden = f"{parent}{'/' if parent else ''}.{base}.{run}.{uuid.uuid4().hex[:8]}"
                    with fs.open_output_stream(f"{root}/{hidden}") as to:
                        to.write(data)
                    out.append((key, name, hidden, len(data), own, None))
                except Exception as e:
                    out.append((key, name, None, None, None, (str(e) or type(e).__name__)[:500]))
            yield pd.DataFrame(out, columns=["key", "path", "staged", "bytes", "sha256", "error"]).astype({"bytes": "Int64"})

    return rows.mapInPandas(stage, MANIFEST)


def publish_files(manifest: DataFrame, folder: str) -> DataFrame:
    """The second step: staged files of a stored manifest get their names; a row of OUTCOME for each. It can run again: a file
    that has its name already, by length, is a success."""
    root_uri = folder if "://" in folder else f"file://{folder}"

    def publish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(root_uri)
        for batch in batches:
            errors = []
            for name, staged, size, error in zip(batch["path"], batch["staged"], batch["bytes"], batch["error"]):
                try:
                    if error is None and isinstance(staged, str):
                        if fs.get_file_info(f"{root}/{staged}").type == pafs.FileType.File:
                            fs.move(f"{root}/{staged}", f"{root}/{name}")
                        elif fs.get_file_info(f"{root}/{name}").size != size:
                            error = "the staged file is gone"
                except Exception as e:
                    error = (str(e) or type(e).__name__)[:500]
                errors.append(error)
            yield batch.assign(error=errors)[["key", "path", "bytes", "sha256", "error"]]

    return manifest.mapInPandas(publish, OUTCOME)


def _swept(manifest: DataFrame, folder: str, run: str) -> int:
    """Deletes what lost tasks of a run have staged and no manifest names; returns the number of folders that were looked at."""
    root_uri = folder if "://" in folder else f"file://{folder}"

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(root_uri)
        for batch in batches:
            for parent in batch["parent"]:
                for f in fs.get_file_info(pafs.FileSelector(f"{root}/{parent}", allow_not_found=True)):
                    if f.type == pafs.FileType.File and f.base_name.startswith(".") and f".{run}." in f.base_name:
                        fs.delete_file(f.path)
            yield batch

    parents = manifest.filter("staged is not null").select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("parent")).distinct()
    return parents.mapInPandas(sweep, "parent string").count()


def write_with_outcome(df: DataFrame, folder: str, log: str, key: str = "sha256", path: str = "path", content: str = "content") -> DataFrame:
    """Writes files in two steps, and returns OUTCOME, a stored row for each file: its error, or its length and SHA-256.

    All content is staged first; the manifest of it, written to a run's folder of log, is the point from which the run can be
    completed (recover()); then the files get their names. What earlier runs of the log have written alike stays as it is."""
    import uuid

    spark, run = df.sparkSession, uuid.uuid4().hex
    stage_files(df, folder, run, key, path, content, outcomes(spark, log, folder)).withColumn("folder", F.lit(folder)).write.parquet(f"{log}/{run}/manifest")
    return _finished(spark, log, run)


def _finished(spark, log: str, run: str) -> DataFrame:
    manifest = spark.read.schema(f"{MANIFEST}, folder string").parquet(f"{log}/{run}/manifest")
    first = manifest.select("folder").first()
    folder = first[0] if first else "/"
    publish_files(manifest.drop("folder"), folder).withColumn("folder", F.lit(folder)).write.mode("overwrite").parquet(f"{log}/{run}/outcome")
    _swept(manifest, folder, run)
    return spark.read.schema(f"{OUTCOME}, folder string").parquet(f"{log}/{run}/outcome").drop("folder")


def _runs(spark, log: str) -> list[tuple[str, bool, bool]]:
    """(run, staged, published) of each run of a log."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(log)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    has = lambda run, part: fs.exists(jvm.org.apache.hadoop.fs.Path(f"{log}/{run}/{part}/_SUCCESS"))
    names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
    return [(n, has(n, "manifest"), has(n, "outcome")) for n in sorted(names)]


def recover(spark, log: str) -> int:
    """Completes the runs that were lost between the two steps; returns their number. Call it before a job writes."""
    lost = [run for run, staged, published in _runs(spark, log) if staged and not published]
    for run in lost:
        _finished(spark, log, run)
    return len(lost)


def outcomes(spark, log: str, folder: str) -> DataFrame | None:
    """(path, sha256) of the files that the runs of a log have written into a folder."""
    done = [f"{log}/{run}/outcome" for run, _, published in _runs(spark, log) if published]
    return spark.read.schema(f"{OUTCOME}, folder string").parquet(*done).filter((F.col("folder") == folder) & F.col("error").isNull()).select("path", "sha256") if done else None


def forget(spark, log: str) -> None:
    """Deletes the runs that are published: their outcomes are in the registry by now."""
    jvm = spark._jvm
    for run, _, published in _runs(spark, log):
        if published:
            p = jvm.org.apache.hadoop.fs.Path(f"{log}/{run}")
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_errors(outcome: DataFrame, name: str) -> DataFrame:
    """(sha256, name): the first error, by path, of each key's files."""
    bad = outcome.filter("error is not null")
    return bad.groupBy(F.col("key").alias("sha256")).agg(F.min_by(F.concat(F.lit("not written: "), "path", F.lit(": "), "error"), "path").alias(name))


def quarantine(files: DataFrame, results: DataFrame, folder: str) -> DataFrame:
    """Copies the files (sha256, name, content) of failed results (sha256, status) into folder; to move them, store the result and
    pass it to remove_files."""
    bad = results.filter(F.col("status") == "error").select("sha256")
    return write_files(files.join(bad, "sha256", "left_semi"), folder, "name", "content")


def remove_files(copied: DataFrame, folder: str) -> DataFrame:
    """copied (path, bytes, error), a stored table, with the files of folder deleted whose copies have no error. A file that
    is gone already is no fault, so that the step can run again. Call an action."""
    root_uri = folder if "://" in folder else f"file://{folder}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(root_uri)
        for batch in batches:
            for name, error in zip(batch["path"], batch["error"]):
                if error is None and ".." not in name.split("/") and fs.get_file_info(f"{root}/{name}").type == pafs.FileType.File:
                    fs.delete_file(f"{root}/{name}")
            yield batch

    return copied.mapInPandas(run, "path string, bytes long, error string")


_W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def _paragraph(text: str, size: int, font: str, bold: bool = False) -> str:
    run = f'<w:rPr><w:rFonts w:ascii="{font}" w:hAnsi="{font}" w:cs="{font}"/>{"<w:b/>" if bold else ""}<w:sz w:val="{2 * size}"/><w:rtl/></w:rPr>'
    return f'<w:p><w:pPr><w:bidi/><w:jc w:val="right"/></w:pPr><w:r>{run}<w:t xml:space="preserve">{escape(text)}</w:t></w:r></w:p>'


def docx(title: str, meta: list[str], pages: list[list[str]], page_word: str = "עמוד", empty: str = "(אין טקסט בעמוד זה — ייתכן ומדובר בעמוד תמונה)", font: str = "Arial", size: int = 11) -> bytes:
    """A right-to-left DOCX: title, lines of metadata, and each page's number and paragraphs."""
    body = [_paragraph(title, size + 9, font, True), *(_paragraph(m, size, font) for m in meta), _paragraph("", size, font)]
    for i, paragraphs in enumerate(pages, 1):
        body += [_paragraph(f"{page_word} {i}", size + 3, font, True), *(_paragraph(p, size, font) for p in paragraphs or [empty])]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in (
            ("[Content_Types].xml", '<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>'),
            ("_rels/.rels", '<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>'),
            ("word/document.xml", f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><w:document {_W}><w:body>{"".join(body)}<w:sectPr><w:bidi/></w:sectPr></w:body></w:document>'),
        ):
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.compress_type = zipfile.ZIP_DEFLATED
            z.writestr(info, text)
    return out.getvalue()


def docx_files(documents: DataFrame, paragraphs: DataFrame, key: str = "sha256") -> DataFrame:
    """(key, path, content): a DOCX for each document (key, title, meta array<string>, path) of its pages' paragraphs."""
    by_page = paragraphs.groupBy(key, "page_no").agg(F.array_sort(F.collect_list(F.struct("par_no", "text"))).alias("p"))
    texts = F.filter(F.transform("p", lambda x: x["text"]), lambda t: t.isNotNull())
    by_doc = by_page.select(key, "page_no", texts.alias("t")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page_no", "t"))).alias("pages"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [docx(title, list(meta), [list(p["t"]) for p in pages] if pages is not None else []) for title, meta, pages in zip(batch["title"], batch["meta"], batch["pages"])]
            yield pd.DataFrame({key: batch[key], "path": batch["path"], "content": rows})

    return documents.join(by_doc, key, "left").select(key, "path", "title", "meta", "pages").mapInPandas(run, f"{key} string, path string, content binary")
