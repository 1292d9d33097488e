"""From documents to packed sequences, in five stages.

1. quality classifier: documents that score below 0.7 go.
2. line dedup: lines that an earlier line matches (five-word shingles, similarity 0.8 or more) are cut out; a document
   of which no line with words is left goes; n_chars follows the text.
3. near duplicates: of each component of documents linked by five-word shingles at 0.8 or more, the one with the smallest doc_id stays.
4. benchmark decontamination: documents in which a window of a benchmark item occurs go.
5. best-fit packing: the pieces of what is left, with their places in sequences of 2048 tokens.

Every stage works on all that the one before kept. A classifier can't be stated in SQL, so ORACLE_SQL is None, and the
stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import decontaminate, jaccard, linededup, packing, quality
from docflow.llm.common import shared_path, table

ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.deduplicated(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicated(docs, 5, 80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, packing.default_tokenizer()))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
