"""The registered queries of this package and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from agorakit.llm.decontaminate import contamination
from agorakit.llm.fingerprint import fingerprints
from agorakit.llm.fixity import AUDIT_SQL, replica_audit
from agorakit.llm.hard_negatives import hard_negatives
from agorakit.llm.language import held_out, languages
from agorakit.llm.licences import licence_scan, licence_sql
from agorakit.llm.mincut import main_text
from agorakit.llm.ngram_join import jaccard_components
from agorakit.llm.packing import pack
from agorakit.llm.phrases import collocations
from agorakit.llm.placement import documents_placed
from agorakit.llm.ppm import code_length
from agorakit.llm.quality import quality_scores
from agorakit.session import apply_runtime_conf

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return apply_runtime_conf(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Text of a public vocabulary file, read where the driver runs; the tasks get it broadcast."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op1_warc_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replica_audit(table(spark, sf_dir, "pages"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_placed(table(spark, sf_dir, "documents"))


def op11_phrase_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_length(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 1))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_warc_fixity_audit,
        op2_language_id,
        op3_html_extraction,
        op4_packing,
        op5_benchmark_decontamination,
        op6_ngram_jaccard_join,
        op7_document_fingerprints,
        op8_licence_scan,
        op9_quality_classifier,
        op10_sharding,
        op11_phrase_collocation_mining,
        op12_hard_negative_mining,
        op13_lm_scoring,
    )
}
SQL: dict[str, str] = {"op1_warc_fixity_audit": AUDIT_SQL, "op8_licence_scan": licence_sql()}
