"""Incremental ingest: new files of a folder go into the registry once, however often the job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import registry
from ..schema import FILES


def ingest(spark: SparkSession, folder: str, registry_path: str, checkpoint: str, suffix: str = ".pdf", batch_files: int = 1000) -> DataFrame:
    """Takes up all files that are new since the last run, batch_files at a time, and ends; returns the registry. Each batch commits a
    delta of the entries that it adds or changes. A batch that is run again changes nothing, as an upsert of the
    same names is the same registry."""
    letters = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", f"*{letters}").option("maxFilesPerTrigger", batch_files).load(folder)
    named = files.select(F.sha2("content", 256).alias("sha256"), F.substring_index("path", "/", -1).alias("name"), "path")

    def take(batch: DataFrame, _number: int) -> None:
        batch = batch.persist()  # contents are read and hashed once, also where the commit is made again
        try:
            registry.update(batch.sparkSession, registry_path, lambda known: registry.upserted(known, batch))
        finally:
            batch.unpersist()

    query = named.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return registry.load(spark, registry_path)
