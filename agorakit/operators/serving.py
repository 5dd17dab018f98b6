"""Serving layer: batch and stream tables as one, and their reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from agorakit.functions import half_up, money_sum
from agorakit.operators.marts import daily_from_windows

BATCH, STREAM = "batch", "stream"


def _batch_rows(wide: DataFrame) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    return wide.select(
        "order_id",
        F.to_date(ts).alias("order_date"),
        "order_status",
        "order_total",
        "customer_id",
        "customer_state",
        F.lit(BATCH).alias("_source_layer"),
        ts.alias("_timestamp"),
    )


def _stream_rows(rt: DataFrame) -> DataFrame:
    ts = F.col("event_timestamp")
    return rt.select(
        "order_id",
        F.to_date(ts).alias("order_date"),
        F.coalesce("event_type", F.lit("order_placed")).alias("order_status"),
        "order_total",
        "customer_id",
        "customer_state",
        F.lit(STREAM).alias("_source_layer"),
        ts.alias("_timestamp"),
    )


def prefer_stream(both: DataFrame, keys: list[str], layer: str = "_source_layer", newest: Column | None = None) -> DataFrame:
    """One row per key; the stream row where both layers have one, of several the newest."""
    rest = [c for c in both.columns if c not in keys]
    rank = F.struct(
        (F.col(layer) == STREAM).cast("int").alias("layer"),
        *([newest.alias("newest")] if newest is not None else []),
        *[F.col(c).alias(f"tie_{i}") for i, c in enumerate(rest)],
    )
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*both.columns)


def unified_orders(
    wide: DataFrame, rt: DataFrame, policy: str = "union", boundary: str | Column | None = None
) -> DataFrame:
    """Batch and stream orders together.

    ``union``: all rows of both layers, tagged. ``stream_wins``: one row per
    order, the stream's if it has one. ``boundary``: batch before the date,
    stream from it on.
    """
    batch, stream = _batch_rows(wide), _stream_rows(rt)
    if policy == "union":
        return batch.unionByName(stream)
    if policy == "stream_wins":
        return prefer_stream(batch.unionByName(stream), ["order_id"], newest=F.col("_timestamp"))
    if policy == "boundary":
        if boundary is None:
            raise ValueError("a boundary date is required")
        day = (F.lit(boundary) if isinstance(boundary, str) else boundary).cast("date")
        return batch.where(F.col("order_date") < day).unionByName(stream.where(F.col("order_date") >= day))
    raise ValueError(f"unknown policy {policy}")


def unified_daily(daily: DataFrame, metrics: DataFrame) -> DataFrame:
    """Batch days and stream windows summed per day, in one schema."""
    batch = daily.select(
        F.col("date").alias("metric_date"),
        "total_orders",
        "total_gmv",
        "avg_order_value",
        "unique_customers",
        "late_delivery_rate",
        F.lit(BATCH).alias("_source_layer"),
    )
    stream = daily_from_windows(metrics).withColumn("_source_layer", F.lit(STREAM))
    return batch.unionByName(stream, allowMissingColumns=True)


def unified_grains(summary: DataFrame, metrics: DataFrame, grain: str = "seller_summary") -> DataFrame:
    """Rows of unlike schemas stacked, tagged with source and grain; missing columns are null."""
    batch = summary.withColumn("_source", F.lit(BATCH)).withColumn("_grain", F.lit(grain))
    stream = metrics.withColumn("_source", F.lit(STREAM)).withColumn("_grain", F.lit("5min_window"))
    return batch.unionByName(stream, allowMissingColumns=True)


def unified_experiments(batch: DataFrame, stream: DataFrame, policy: str = "stream_wins") -> DataFrame:
    """Experiment results per (experiment, variant).

    ``stream_wins`` keeps one row with the columns of both layers;
    ``side_by_side`` puts live and batch figures next to each other.
    """
    keys = ["experiment_id", "variant"]
    if policy == "stream_wins":
        both = batch.withColumn("_source", F.lit(BATCH)).unionByName(
            stream.withColumn("_source", F.lit(STREAM)), allowMissingColumns=True
        )
        return prefer_stream(both, keys, "_source")
    if policy == "side_by_side":
        live = stream.select(
            *keys,
            F.col("impressions").alias("live_impressions"),
            F.col("conversions").alias("live_conversions"),
            F.col("conversion_rate").alias("live_conversion_rate"),
        )
        done = batch.select(
            *keys,
            F.col("total_orders").alias("batch_total_orders"),
            F.col("conversion_rate").alias("batch_conversion_rate"),
        )
        return (
            live.join(done, keys, "full")
            .withColumn(
                "_primary_source",
                F.when(F.col("live_impressions").isNotNull(), STREAM).otherwise(BATCH),
            )
            .orderBy(*keys)
        )
    raise ValueError(f"unknown policy {policy}")


def reconcile(batch: DataFrame, stream: DataFrame, key: str = "order_id", samples: int = 5) -> DataFrame:
    """How many ids only one layer has, both have, and there are in all, with the smallest ids as samples.

    Each id carries a flag per layer through one aggregate; no id list is built.
    The samples are a top-n per category taken from a sort that keeps n rows.
    """
    ids = (
        batch.select(F.trim(F.col(key).cast("string")).alias("id"), F.lit(1).alias("b"), F.lit(0).alias("s"))
        .unionByName(
            stream.select(F.trim(F.col(key).cast("string")).alias("id"), F.lit(0).alias("b"), F.lit(1).alias("s"))
        )
        .where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.max("b").alias("b"), F.max("s").alias("s"))
    )
    both, only_stream = (F.col("b") == 1) & (F.col("s") == 1), F.col("b") == 0

    counts = ids.agg(
        F.count_if(only_stream).alias("stream_only"),
        F.count_if(F.col("s") == 0).alias("batch_only"),
        F.count_if(both).alias("overlap"),
        F.count(F.lit(1)).alias("totals"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("n_batch"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("n_stream"),
    )

    def sample(condition: Column) -> Column:
        first = ids.where(condition).orderBy("id").limit(samples)
        joined = first.agg(F.array_join(F.sort_array(F.collect_list("id")), ", "))
        return F.coalesce(joined.scalar(), F.lit(""))

    summary = F.concat(
        F.lit("batch="), F.col("n_batch"), F.lit(" stream="), F.col("n_stream"), F.lit(" union="), F.col("totals")
    )

    def row(category: str, count: str, text: Column) -> Column:
        return F.struct(
            F.lit(category).alias("category"), F.col(count).alias("order_count"), text.alias("sample_ids")
        )

    return counts.select(
        F.explode(
            F.array(
                row("stream_only", "stream_only", sample(only_stream)),
                row("batch_only", "batch_only", F.lit("")),
                row("overlap", "overlap", sample(both)),
                row("totals", "totals", summary),
            )
        ).alias("r")
    ).select("r.*")


def layer_totals(unified: DataFrame, amount: str = "order_total") -> DataFrame:
    return unified.groupBy("_source_layer").agg(
        F.count(F.lit(1)).alias("cnt"), half_up(money_sum(F.col(amount)), 2).alias("gmv")
    )


def unified_recent(unified: DataFrame, day: str | Column, days: int = 30) -> DataFrame:
    """Orders and revenue per day and layer of the last ``days`` days."""
    date = (F.lit(day) if isinstance(day, str) else day).cast("date")
    return (
        unified.where(F.col("order_date") >= F.date_sub(date, days))
        .groupBy("order_date", "_source_layer")
        .agg(F.count(F.lit(1)).alias("orders"), money_sum(F.col("order_total")).alias("revenue"))
        .orderBy(F.col("order_date").desc(), "_source_layer")
    )


__all__ = [
    "layer_totals",
    "prefer_stream",
    "reconcile",
    "unified_daily",
    "unified_experiments",
    "unified_grains",
    "unified_orders",
    "unified_recent",
]
