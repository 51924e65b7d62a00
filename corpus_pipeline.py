"""A training corpus from `documents`: toxic and poor documents go, boilerplate lines go, one of each group of near copies stays, the rest is packed.

Each stage takes all that the one before kept, written and read again. Null and empty texts,
repeated rows and other columns are as the operator of the stage says; a null key is carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beaconframe.llm import jaccard_join, line_dedup, packing, quality, toxicity
from beaconframe.session import scratch, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, with their columns. Null and empty texts stay; without labels of both classes all stay."""
    return toxicity.reject_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score `quality.THRESHOLD` or more, with their columns. A null text counts as empty; without labels of both classes all stay."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; a text may become empty, a null one stays null."""
    return line_dedup.without_boilerplate(docs)


def jaccard_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least key; equal texts without words, null ones too, are a group."""
    return jaccard_join.one_of_each(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences that hold all documents; a null or empty text is one token."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", jaccard_join_stage),
    ("packing", packing_stage),
]
#: The classifiers and the recursive join can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, of the whole table `documents`. What a stage wrote is deleted when the next one has ended, but for the last's."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return docs
