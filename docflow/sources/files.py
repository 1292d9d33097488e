"""Files as tables: folder scans, whole texts, fingerprints, remote listings, and pages through extraction engines."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..engines import EXTRACTORS, IMAGES, OCRS, find
from ..functions.text import glob
from ..schema import OCR_CANDIDATES, PAGES

OCR_PAGES = 64
PART_BYTES = 128 << 20
PART_PAGES = 200


def scan(spark: SparkSession, folder: str, suffix: str = ".pdf", only: str | None = None, ordered: bool = False) -> DataFrame:
    """(path, name, modificationTime, length, content) of a folder's own files with the suffix, in either case; in order of paths
    if asked for. Jobs don't ask for it: what depends on the order of arrival takes it from path."""
    letters = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    df = spark.read.format("binaryFile").option("pathGlobFilter", f"*{letters}").load(folder)
    df = df.select("path", F.substring_index("path", "/", -1).alias("name"), "modificationTime", "length", "content")
    df = df.filter(glob(F.col("name"), only)) if only else df
    return df.orderBy("path") if ordered else df


def listed(spark: SparkSession, folder: str, suffix: str = ".pdf", only: str | None = None) -> DataFrame:
    """(path, name, length, mtime) of a folder's own files with the suffix; contents aren't read."""
    return scan(spark, folder, suffix, only).select("path", "name", "length", F.col("modificationTime").alias("mtime"))


def _bytes_of(path: str) -> bytes:
    """A file's content by its path as Spark lists it."""
    import pyarrow.fs as pafs

    if path.startswith("file:") or "://" not in path:
        with open("/" + path.removeprefix("file:").lstrip("/"), "rb") as f:
            return f.read()
    scheme, _, rest = path.partition("://")
    host, _, name = rest.partition("/")
    fs, root = pafs.FileSystem.from_uri(f"{scheme}://{host}/")
    with fs.open_input_file(f"{root.rstrip('/')}/{name}") as f:
        return f.read()


def _dealt(files: DataFrame, part_bytes: int) -> DataFrame:
    """files over as many partitions as their bytes (length) need, and one for each slot at least."""
    total = files.agg(F.sum(F.coalesce("length", F.lit(0)))).first()[0] or 0
    return files.repartition(max(files.sparkSession.sparkContext.defaultParallelism, -(-total // part_bytes)))


def with_content(files: DataFrame, text: bool = False, part_bytes: int = PART_BYTES) -> DataFrame:
    """files (path, length, ...) with content, read by path and nothing else of their folders: bytes, or with text a string; and
    error, set where a file can't be read. A file that isn't there has the error "missing"."""
    kind = "string" if text else "binary"
    columns = files.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields) + f", content {kind}, error string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a file at a time, as one may be large
                data, error = None, None
                try:
                    data = _bytes_of(batch.column("path")[i].as_py())
                    data = data.decode("utf-8", "replace") if text else data
                except FileNotFoundError:
                    error = "missing"
                except Exception as e:
                    error = _told(e)
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([data], pa.string() if text else pa.binary()), pa.array([error], pa.string())], [*columns, "content", "error"])

    return _dealt(files, part_bytes).mapInArrow(run, schema)


def hashed(files: DataFrame) -> DataFrame:
    """files (path, length, ...) with sha256, null where a file can't be read."""
    read = with_content(files)
    return read.withColumn("sha256", F.when(F.col("error").isNull(), F.sha2("content", 256))).drop("content", "error")


def read_files(files: DataFrame, engine: str = "pdf", part_bytes: int = PART_BYTES, part_pages: int = PART_PAGES, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(path, sha256, page_no, text, n_images, error) of files (path, length): hashed and cut into pages. A file that can't be opened has a
    row without sha256; one that the engine can't read a row without page_no.

    A file of at most part_pages pages is read once. Of a longer one, if the engine can count pages and read a range of them, the
    first pass only tells the number, and its ranges are dealt out to tasks, each of which reads the file once; store
    keeps the first pass, so that it runs once."""
    extract = find(EXTRACTORS, engine)
    count, read_range = getattr(extract, "count", None), getattr(extract, "read_range", None)
    columns = ["path", "sha256", "page_no", "text", "n_images", "error", "pages"]
    schema = f"path string, {PAGES}, error string, pages int"
    frame = lambda rows: pd.DataFrame(rows, columns=columns).astype({"page_no": "Int32", "n_images": "Int32", "pages": "Int32"})

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            for path in batch["path"]:
                sha = None
                try:
                    data = _bytes_of(path)
                    sha = hashlib.sha256(data).hexdigest()
                    n = count(data) if count and read_range else 0
                    if n > part_pages:
                        rows = [(path, sha, None, None, None, None, n)]
                    else:
                        rows = [(path, sha, i, text, k, None, None) for i, (text, k) in enumerate(extract(data), 1)]
                except Exception as e:
                    rows = [(path, sha, None, None, None, _told(e), None)]
                yield frame(rows or [(path, sha, None, None, None, None, None)])  # no page and no error

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, sha, a, n in zip(batch["path"], batch["sha256"], batch["a"], batch["pages"]):
                try:
                    rows = [(path, sha, i, text, k, None, None) for i, (text, k) in enumerate(read_range(_bytes_of(path), int(a), min(int(a) + part_pages, int(n) + 1)), int(a))]
                except Exception as e:
                    rows = [(path, sha, None, None, None, f"pages from {a}: {_told(e)}", None)]
                yield frame(rows)

    found = _dealt(files, part_bytes).select("path").mapInPandas(first, schema)
    if count is None or read_range is None:
        return found.drop("pages")
    found = store(found) if store else found
    long = found.filter("pages is not null").select("path", "sha256", "pages", F.explode(F.sequence(F.lit(1), F.col("pages"), F.lit(part_pages))).alias("a"))
    parts = long.count() if store else 64
    if not parts:
        return found.drop("pages")
    dealt = long.repartition(min(parts, 10_000), "path", "a").mapInPandas(ranges, schema)
    return found.filter("pages is null").unionByName(dealt).drop("pages")


def with_sha(files: DataFrame) -> DataFrame:
    return files.withColumn("sha256", F.sha2("content", 256))


def whole_texts(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, text, size, mtime) of files read whole."""
    df = spark.read.option("recursiveFileLookup", recursive).text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), F.col("_metadata.file_size").alias("size"), F.unix_timestamp("_metadata.file_modification_time").alias("mtime"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, mtime) of all files below a path; contents aren't read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return df.select("path", F.col("length").alias("size"), F.unix_timestamp("modificationTime").alias("mtime"))


def readings(files: DataFrame, engine: str = "pdf") -> DataFrame:
    """Pages of files (sha256, content) with error null; a file that can't be read has one row, page_no null and error set."""
    extract = find(EXTRACTORS, engine)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for sha, content in zip(batch["sha256"], batch["content"]):
                try:
                    rows += [(sha, i, text, n, None) for i, (text, n) in enumerate(extract(bytes(content)), 1)]
                except Exception as e:
                    rows.append((sha, None, None, None, _told(e)))
            out = pd.DataFrame(rows, columns=["sha256", "page_no", "text", "n_images", "error"])
            yield out.astype({"page_no": "Int32", "n_images": "Int32"})

    return files.select("sha256", "content").mapInPandas(run, f"{PAGES}, error string")


def pages(files: DataFrame, engine: str = "pdf") -> DataFrame:
    """Pages of files (sha256, content); a file that can't be read has no pages."""
    return readings(files, engine).filter("error is null").drop("error")


def images(files: DataFrame, engine: str = "pdf") -> DataFrame:
    """(sha256, image_no, name, content) of the pictures in files (sha256, content), numbered from 1; none of a file that can't be read."""
    pictures = IMAGES.get(engine, lambda content: iter(()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for sha, content in zip(batch["sha256"], batch["content"]):
                rows = []
                try:
                    for i, (suffix, data) in enumerate(pictures(bytes(content)), 1):
                        rows.append((sha, i, f"image-{i:04d}.{suffix}", data))
                except Exception:
                    pass  # the file's own error is told with its pages
                yield pd.DataFrame(rows, columns=["sha256", "image_no", "name", "content"])

    return files.select("sha256", "content").mapInPandas(run, "sha256 string, image_no int, name string, content binary")


def _told(e: Exception) -> str:
    return (str(e) or type(e).__name__)[:500]


def ocr_candidates(files: DataFrame, page_numbers: DataFrame, languages: list[str], engine: str = "blank", part: int = OCR_PAGES, **settings) -> DataFrame:
    """A reading of every page in every language. A file's bytes travel once for each ``part`` pages, and the engine gets
    a page once, with all languages, so that it can render it once. A call that fails is an error of each language."""
    read = find(OCRS, engine)(**settings)
    wanted = page_numbers.groupBy("sha256", F.floor((F.col("page_no") - 1) / part).alias("_part")).agg(F.array_sort(F.collect_list("page_no")).alias("page_nos"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for sha, numbers, content in zip(batch["sha256"], batch["page_nos"], batch["content"]):
                content = bytes(content)
                for no in map(int, numbers):
                    try:
                        texts = read(content, no, languages)
                    except Exception as e:
                        texts = [e] * len(languages)
                    for i, (lang, text) in enumerate(zip(languages, texts)):
                        failed = isinstance(text, Exception)
                        rows.append((sha, no, lang, i, None if failed else text, _told(text) if failed else None))
            yield pd.DataFrame(rows, columns=["sha256", "page_no", "lang", "lang_ord", "text", "error"])

    return files.select("sha256", "content").join(wanted.drop("_part"), "sha256").mapInPandas(run, OCR_CANDIDATES)


class _Listing(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [InputPartition(None)]

    def read(self, partition):
        import mimetypes

        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        for f in sorted(fs.get_file_info(pafs.FileSelector(root, recursive=True)), key=lambda f: f.path):
            folder = f.type == pafs.FileType.Directory
            yield f.path[len(root) :].lstrip("/"), f.base_name, "application/vnd.folder" if folder else mimetypes.guess_type(f.base_name)[0] or ""


class RemoteListing(DataSource):
    """(id, name, mime) of all that a remote folder holds; here the remote is any file system that pyarrow opens."""

    @classmethod
    def name(cls) -> str:
        return "remote_listing"

    def schema(self) -> str:
        return "id string, name string, mime string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Listing(self.options["path"])


def reader_of(folder: str) -> Callable[[str], bytes]:
    """What gives the bytes of a file of a folder by its id in RemoteListing."""
    uri = folder if "://" in folder else f"file://{folder}"

    def read(key: str) -> bytes:
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(uri)
        with fs.open_input_file(f"{root.rstrip('/')}/{key}") as file:
            return file.read()

    return read


def targets(remote: DataFrame, pdfs_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """(targets, skipped) of a listing: folders never, other files than PDFs only if asked for."""
    is_folder = F.coalesce(F.col("mime").contains("folder"), F.lit(False))
    wanted = ~is_folder & (F.lit(not pdfs_only) | F.coalesce(F.lower("name").endswith(".pdf"), F.lit(False)))
    return remote.filter(wanted), remote.filter(~wanted)


def fetch(remote: DataFrame, present: DataFrame, download: Callable[[str], bytes]) -> DataFrame:
    """(name, content, error) of what isn't present (name, size) with a size above 0; a failure is a row, not an end."""
    due = remote.join(present.filter("size > 0").select("name"), "name", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, name in zip(batch["id"], batch["name"]):
                try:
                    rows.append((name, download(key), None))
                except Exception as e:
                    rows.append((name, None, str(e)[:500]))
            yield pd.DataFrame(rows, columns=["name", "content", "error"])

    return due.select("id", "name").mapInPandas(run, "name string, content binary, error string")
