"""Text search over an inverted index: postings by term, in a table bucketed by the term."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agorakit.sources.sinks import read_upserted, upsert


def terms_of(text: Column) -> Column:
    """Distinct lower-cased words (letters and digits) of a text."""
    return F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), lambda t: t != "")


def index_batch(path: str, rows: DataFrame, keys: Sequence[str], column: str, version: str, batch_id: int | None = None, source: str | None = None) -> None:
    """Take a batch of documents into the index, from a static frame or inside ``foreachBatch``.

    ``keys`` name a document, ``version`` orders its states (the highest stays, in whatever order they come). The rows are
    kept in a table bucketed by their keys, the postings (term, keys, version) in one bucketed by the term; only
    buckets that the batch has terms or documents of are written again. Postings of an older state stay until their term's
    bucket is merged with a newer posting of the document, and are passed over in a search. Null texts have no postings.
    """
    postings = rows.select(F.explode(terms_of(F.col(column))).alias("term"), *keys, F.col(version).alias("_version"))
    upsert(f"{path}/postings", postings, ["term", *keys], ["_version"], batch_id, source, bucket_by=["term"])
    upsert(f"{path}/rows", rows, keys, [version], batch_id, source)


def search(spark: SparkSession, path: str, terms: Sequence[str], keys: Sequence[str], version: str) -> DataFrame:
    """The documents that hold any of the terms as a word, whatever the case, in their newest state.

    Only the buckets of the terms are opened, and of the documents those that the postings name.
    """
    wanted = sorted({t.lower() for t in terms})
    hits = read_upserted(spark, f"{path}/postings", wanted).select(*keys, F.col("_version").alias(version)).distinct()
    return read_upserted(spark, f"{path}/rows", hits)
