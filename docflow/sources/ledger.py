"""The ledger of source files: which content a file had when it was last read, by path, length and time of change.

A file whose path, length and time the ledger has isn't read again to know its hash; so a run over a folder in which nothing
is new reads listings only. A file that was replaced by one of the same length and time isn't noticed.
The ledger is a stored table by path (operators/registry.py): a run adds a delta of the files that were new to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import registry
from ..schema import LEDGER


def split(listed: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, fresh) of listed (path, name, length, mtime): known files have their sha256, fresh ones are to be read."""
    held = ledger.select(F.col("path").alias("_path"), F.col("length").alias("_length"), F.col("mtime").alias("_mtime"), "sha256")
    same = (F.col("path") == F.col("_path")) & (F.col("length") == F.col("_length")) & (F.col("mtime") == F.col("_mtime"))
    both = listed.join(held, same, "left").drop("_path", "_length", "_mtime")
    return both.filter("sha256 is not null"), both.filter("sha256 is null").drop("sha256")


def load(spark: SparkSession, path: str) -> DataFrame:
    return registry.load(spark, path, LEDGER, "path")


def add(spark: SparkSession, path: str, files: DataFrame) -> int:
    """Commits files (path, length, mtime, sha256), a stored table, to the ledger; files that it has as they are aren't written."""
    new = files.select("path", "length", "mtime", "sha256").dropDuplicates(["path"])
    return registry.update(spark, path, lambda held: new.subtract(held.join(new.select("path"), "path", "left_semi").select(*new.columns)), LEDGER, "path")
