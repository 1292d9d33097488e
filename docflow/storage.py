"""Where the library's own queries keep what they write: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path below spark.checkpoint.dir. Where that is unset, a temporary folder is set if Spark runs on this machine alone; on
    a cluster it is an error, as executors would not see a folder of the driver's."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir is unset on {master}; set it to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='docflow-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/docflow/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written there and read again."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
