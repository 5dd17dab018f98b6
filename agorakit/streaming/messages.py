"""Message rules, event derivation from tables and the replay clock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agorakit.functions import half_up
from agorakit.operators.assignment import arm_of
from agorakit.sources.documents import first_product
from agorakit.sources.sinks import split_dlq


def message_rules(df: DataFrame, required: Sequence[str]) -> dict[str, Column]:
    """Reason -> condition under which a parsed message is bad."""
    payload = [c for c in df.columns if c not in ("_raw", "topic", "partition", "offset")]
    empty = F.coalesce(*[F.col(c).cast("string") for c in payload]).isNull()
    return {"Message must be a non-empty dict": empty, **{f"Missing {f}": F.col(f).isNull() for f in required}}


def validate(df: DataFrame, required: Sequence[str], consumer: str) -> tuple[DataFrame, DataFrame]:
    """Good messages and dead letters."""
    return split_dlq(df, message_rules(df, required), consumer)


def replay_time(ts: Column, first: Column, last: Column, start: Column, hours: float = 48.0) -> Column:
    """Event time mapped linearly from [first, last] onto ``hours`` hours from ``start``."""
    span = F.unix_micros(last) - F.unix_micros(first)
    factor = F.coalesce(F.try_divide(F.lit(hours * 3_600_000_000.0), F.when(span > 0, span)), F.lit(1.0))
    moved = (F.unix_micros(ts) - F.unix_micros(first)) * factor
    return F.timestamp_micros(F.unix_micros(start) + F.floor(moved + F.lit(0.5)).cast("long"))


def replayed(events: DataFrame, start: str, hours: float = 48.0, column: str = "event_time") -> DataFrame:
    """Events with their replay time; first and last event come from a scalar subquery."""
    edges = events.agg(F.struct(F.min(column).alias("a"), F.max(column).alias("b"))).scalar()
    moment = F.lit(start).cast("timestamp")
    return events.withColumn(
        "replay_at", replay_time(F.col(column), edges["a"], edges["b"], moment, hours)
    )


def order_events(orders: DataFrame, items: DataFrame, experiment: str = "exp_001") -> DataFrame:
    """One message per order, typed by its status."""
    totals = items.groupBy("order_id").agg(half_up(F.sum("price"), 2).alias("order_total"))
    status = F.coalesce(F.nullif(F.lower(F.trim("order_status")), F.lit("")), F.lit("placed"))
    return orders.join(totals, "order_id", "left").select(
        F.concat(F.lit("order_"), status).alias("event_type"),
        "order_id",
        F.trim("customer_id").alias("customer_id"),
        F.coalesce("order_total", F.lit(0.0)).alias("order_total"),
        F.lower(F.trim("order_status")).alias("order_status"),
        F.lit(experiment).alias("experiment_id"),
        arm_of(F.trim("customer_id"), F.lit(experiment)).alias("variant"),
        F.col("order_purchase_timestamp").alias("event_time"),
    )


def payment_events(payments: DataFrame, orders: DataFrame, delay_seconds: int = 60) -> DataFrame:
    """One message per payment of a known order, shortly after the order."""
    times = orders.select("order_id", "order_purchase_timestamp")
    return payments.join(times, "order_id").select(
        F.lit("payment_completed").alias("event_type"),
        "order_id",
        F.coalesce("payment_type", F.lit("credit_card")).alias("payment_type"),
        F.coalesce("payment_value", F.lit(0.0)).alias("payment_value"),
        F.coalesce("payment_installments", F.lit(1)).alias("payment_installments"),
        (F.col("order_purchase_timestamp") + F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")).alias("event_time"),
    )


def delivery_events(orders: DataFrame) -> DataFrame:
    """Four steps per order: shipped +2 d, in transit +4 d, out for delivery the day before, delivered."""
    bought = F.col("order_purchase_timestamp")
    done = F.coalesce("order_delivered_customer_date", bought + F.expr("INTERVAL 10 DAYS"))
    steps = {
        "shipped": bought + F.expr("INTERVAL 2 DAYS"),
        "in_transit": bought + F.expr("INTERVAL 4 DAYS"),
        "out_for_delivery": done - F.expr("INTERVAL 1 DAY"),
        "delivered": done,
    }
    rows = F.array(*[F.struct(F.lit(k).alias("event_type"), t.alias("event_time")) for k, t in steps.items()])
    return orders.select("order_id", F.explode(rows).alias("e")).select("e.event_type", "order_id", "e.event_time")


def review_events(reviews: DataFrame, items: DataFrame) -> DataFrame:
    return reviews.join(first_product(items), "order_id", "left").select(
        F.lit("review_posted").alias("event_type"),
        F.coalesce("review_id", F.lit("")).alias("review_id"),
        "order_id",
        F.coalesce("product_id", "order_id").alias("product_id"),
        F.coalesce("review_score", F.lit(5)).alias("review_score"),
        F.col("review_creation_date").alias("event_time"),
    )


def as_json(events: DataFrame, time: str = "event_time") -> DataFrame:
    """Events as topic values: JSON text with an ISO-8601 timestamp."""
    fields = [c for c in events.columns if c != time]
    stamp = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")
    return events.select(F.to_json(F.struct(*fields, stamp)).alias("value"))


def event_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Parsed event time next to the ISO text of a message."""
    return df.withColumn("event_timestamp", F.try_to_timestamp(column))
