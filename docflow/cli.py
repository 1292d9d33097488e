"""python -m docflow.cli JOB: the jobs from the command line. Exit 1 if a download failed or no entry has the hash asked for, 0 else."""

from __future__ import annotations

import argparse
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from .config import load
from .operators.registry import load as load_registry
from .operators.registry import with_sha_prefix
from .plans import jobs
from .sources.files import RemoteListing, reader_of, targets
from .sources.remote import HttpListing
from .sources.remote import reader_of as http_reader


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="docflow")
    parser.add_argument("job", choices=["download", "extract", "translate", "docx", "fix-images", "summarize", "index", "plain-index", "import-cache", "config"])
    parser.add_argument("--root", default=".")
    parser.add_argument("--config", default="config.toml")
    parser.add_argument("--only")
    parser.add_argument("--limit", type=int)
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--engine", default=None)
    parser.add_argument("--sha", help="summarize: only entries whose hash begins so")
    parser.add_argument("--reset-errors", action="store_true", help="docx: documents that failed are tried again")
    parser.add_argument("--from", dest="remote", help="download: a folder of any file system that can be listed, or the base URL of an HTTP listing; import-cache: the folder of partial caches")
    parser.add_argument("--folder", default="root", help="download: the folder's id in an HTTP listing")
    parser.add_argument("--script", default="hebrew")
    parser.add_argument("--ocr", default="blank", help="extract: the OCR engine, by name")
    parser.add_argument("--rate", type=float, help="translate: calls a second of all slots together")
    parser.add_argument("--per-page", type=int, help="index: entries of a file; all in one without it")
    a = parser.parse_args(argv)
    config = load(str(Path(a.root, a.config)), a.root)
    if a.job == "config":
        print(config.dump())
        return 0
    spark = SparkSession.builder.appName("docflow").getOrCreate()
    work = f"{config.root}/.docflow"

    def store(df):
        path = f"{work}/steps/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    registry = f"{work}/registry"
    if a.job == "download":
        folder = (a.remote or config.folder_url).rstrip("/")
        if folder.startswith(("http://", "https://")):
            spark.dataSource.register(HttpListing)
            listing, fetch = spark.read.format("http_listing").option("folder", a.folder).load(folder), http_reader(folder)
        else:
            spark.dataSource.register(RemoteListing)
            listing, fetch = spark.read.format("remote_listing").load(folder), reader_of(folder)
        listing = store(listing.select("id", "name", "mime"))
        wanted, skipped = targets(listing, config.pdfs_only)
        print(f"{wanted.count()} to have, {skipped.count()} skipped")
        got = jobs.download(spark, config, store, listing, fetch)
        failed = got.filter("error is not null").collect()
        for r in failed:
            print(f"failed: {r.name}: {r.error}")
        return 1 if failed else 0
    if a.job == "import-cache":
        print(f"{jobs.import_cache(spark, config, registry, f'{work}/blocks', store, a.remote)} texts taken up")
    elif a.job == "extract":
        jobs.extract(spark, config, registry, store, a.engine or "pdf", a.ocr, force=a.force, only=a.only, limit=a.limit)
    elif a.job == "translate":
        jobs.translate(spark, config, registry, f"{work}/blocks", store, a.engine or config.engine, a.force, a.only, a.limit, rate=a.rate, pause=f"{work}/pause")
    elif a.job == "docx":
        jobs.translate_docx(spark, config, registry, store, a.engine or config.engine, only=a.only, limit=a.limit, reset_errors=a.reset_errors)
        Path(config.index_file).write_text(jobs.plain_index(spark, registry), "utf-8")
    elif a.job == "fix-images":
        jobs.fix_images(spark, config, registry, store, a.only).show()
    elif a.job == "summarize":
        if a.sha and with_sha_prefix(load_registry(spark, registry), a.sha).isEmpty():
            print(f"no entry's hash begins with {a.sha}")
            return 1
        jobs.summaries(spark, config, registry, store, a.script, a.force, a.only, a.limit, a.sha).show()
    elif a.job == "index" and a.per_page:
        wrote = jobs.index_pages(spark, config, registry, store, a.per_page)
        for r in wrote.filter("error is not null").collect():
            print(f"failed: {r.path}: {r.error}")
    else:
        page = jobs.plain_index(spark, registry) if a.job == "plain-index" else jobs.index(spark, config, registry)
        Path(config.index_file).write_text(page, "utf-8")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
