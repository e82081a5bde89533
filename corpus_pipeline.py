"""A corpus pipeline: quality, near duplicates, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import decontamination, near_duplicates, packing, pii, quality
from paperloom.llm.common import remove_folder, shared_folder, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: The learned classifier and the packing order are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet to the shared
    folder and reread as the next one's documents. What a stage read goes once its own rows are
    written; the last folder stays, as the result reads it."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        own = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(own)
        docs = spark.read.parquet(own)
        if before:
            remove_folder(spark, before)
        before = own
    return STAGES[-1][1](spark, docs, sf_dir)
