"""Streaming scans of JSON topics."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from agorakit.sources import schemas


def read_topic(spark: SparkSession, topics: str, schema: str, servers: str, **options: str) -> DataFrame:
    """Kafka topics from the earliest offset; the query checkpoint holds the committed offsets."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )
    return parse_messages(raw.select("topic", "partition", "offset", F.col("value").cast("string").alias("value")), schema)


def parse_messages(raw: DataFrame, schema: str) -> DataFrame:
    """JSON text in ``value`` to columns; unknown fields are dropped, text that is no JSON gives nulls."""
    carried = [c for c in raw.columns if c != "value"]
    parsed = raw.withColumn("_m", F.from_json("value", schemas.struct(schema), {"mode": "PERMISSIVE"}))
    return parsed.select(*carried, F.col("value").alias("_raw"), "_m.*")


def read_topic_files(spark: SparkSession, path: str, schema: str, max_files: int = 100) -> DataFrame:
    """Topic messages landed as JSON-lines files."""
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)
    return parse_messages(raw, schema)


def read_parquet_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """A parquet table, one file or a folder of part files, as a stream with the table's schema.

    Files come in no order of event time. What reads more than one batch must not depend on how rows are
    spread over batches: use order-aware upserts, or partial sums per batch that are added up on reading.
    """
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return stream.parquet(path)
    # the source wants a folder: the file's own, with only this name let through
    name = re.sub(r"([\\{}\[\]*?,])", r"\\\1", place.getName())
    return stream.option("pathGlobFilter", name).parquet(str(place.getParent()))
