"""A corpus pipeline: from documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on everything its predecessor kept, and
what it returns is written as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of documents. Null texts, empty tables and extra columns are handled as the operators say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agorakit.llm.decontaminate import clean
from agorakit.llm.language import recognised
from agorakit.llm.ngram_join import jaccard_components, keep_one
from agorakit.llm.packing import pack
from agorakit.llm.quality import good
from agorakit.llm.queries import table, vocabulary
from agorakit.session import apply_runtime_conf, materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Rows of a batch that Python workers get at a time; whole documents pass through them in several stages.
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language the model cannot tell, go."""
    small_batches(spark)
    return recognised(docs)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go."""
    small_batches(spark)
    return good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.75 or more stays."""
    return keep_one(docs, materialize(jaccard_components(docs), "groups"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark passages go."""
    small_batches(spark)
    return clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 ids, ids included."""
    small_batches(spark)
    return pack(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the learned stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; what each returns is a table in the shared folder."""
    docs = apply_runtime_conf(spark).read.parquet(f"{sf_dir}/documents.parquet")
    before = spark.conf.get(BATCH_SETTING)
    try:
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name)
    finally:
        spark.conf.set(BATCH_SETTING, before)
    return docs
