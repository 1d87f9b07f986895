"""The corpus pipeline: quality rules, near copies, repeated passages, personal data, packing.

Every stage works on all that the one before it kept, is written as Parquet and
read again. All but the last return the columns of ``documents``; the lengths in
``n_chars`` follow the texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ticktide.llm import packing, pii, quality, simhash, substring_dedup
from ticktide.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier test reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays."""
    return simhash.drop_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut; documents with nothing left go."""
    return _measured(substring_dedup.remove_repeats(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced."""
    return _measured(pii.sanitise(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packed", packed),
]

# Robust estimates, connected components and token ids have no SQL; see tests/llm.
ORACLE_SQL = None


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``.

    Stage results are written below the shared folder; each is deleted once the
    next one stands, the last one is what the returned rows are read from.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        folder = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before is not None:
            _delete(spark, before)
        before = folder
    return docs
