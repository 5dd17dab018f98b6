"""Funnels, sessions and conversion over click events.

Every session-level question first reduces events to one row per session with a
map-side aggregate; questions about neighbouring events cut sessions into time
chunks, so a session holding a large share of the log is still many groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from agorakit.functions import fixed, half_up, money_sum
from agorakit.functions.grouping import with_neighbour

CONVERTED = "checkout_complete"


def time_chunk(seconds: int = 300, column: str = "event_timestamp") -> Column:
    return F.floor(F.unix_seconds(column) / F.lit(seconds))


def stage_table(like: DataFrame, stages: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(s) for s in stages])
    return like.sparkSession.range(1).select(F.posexplode(names).alias("step", "stage"))


def stage_counts(events: DataFrame, stages: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct sessions and value per stage."""
    per_session = (
        events.where(F.col("event_type").isin(list(stages)))
        .groupBy(*by, "event_type", "session_id")
        .agg(F.sum("value").alias("value") if "value" in events.columns else F.lit(0.0).alias("value"))
    )
    return per_session.groupBy(*by, F.col("event_type").alias("stage")).agg(
        F.count("session_id").alias("cnt"), money_sum(F.col("value")).alias("value")
    )


def funnel(events: DataFrame, stages: Sequence[str] = fixed.FUNNEL_STAGES, by: Sequence[str] = ()) -> DataFrame:
    """Sessions per ordered stage, share of the first stage, drop-off against the stage before.

    Revenue is the value of the last stage (other stages carry 0). Groups are at
    most stages x attribute values.
    """
    counts = stage_counts(events, stages, by)
    steps = stage_table(events, stages)
    if by:
        # every group gets every stage, without pairing groups and stages by a join
        groups = events.select(*by).distinct()
        steps = groups.withColumn(
            "s", F.explode(F.transform(F.array(*[F.lit(s) for s in stages]), lambda x, i: F.struct(i.alias("step"), x.alias("stage"))))
        ).select(*by, "s.step", "s.stage")
    on = [steps["stage"] == counts["stage"], *[steps[b].eqNullSafe(counts[b]) for b in by]]
    filled = steps.join(counts, on, "left").select(
        *[steps[b] for b in by],
        steps["step"],
        steps["stage"],
        F.coalesce(counts["cnt"], F.lit(0)).alias("count"),
        F.coalesce(counts["value"], F.lit(0.0)).alias("value"),
    )
    order = Window.partitionBy(*by).orderBy("step")
    # an empty first stage or previous stage counts as 1 in the denominators
    base = F.greatest(F.first("count").over(order), F.lit(1))
    before = F.greatest(F.lag("count").over(order), F.lit(1))
    last = len(stages) - 1
    return filled.select(
        *by,
        F.col("step").cast("int").alias("step"),
        "stage",
        "count",
        half_up(F.col("count") / base * F.lit(100), 1).alias("percentage"),
        F.when(F.col("step") == 0, 0.0)
        .otherwise(half_up((F.lit(1) - F.col("count") / before) * F.lit(100), 1))
        .alias("drop_off_rate"),
        F.when(F.col("step") == last, half_up(F.col("value"), 2)).otherwise(0.0).alias("revenue"),
    ).orderBy(*by, "step")


def funnel_by_variant(events: DataFrame, experiment: str, stages: Sequence[str] = fixed.FUNNEL_STAGES) -> DataFrame:
    """Both arms side by side with the improvement of treatment per stage."""
    arms = funnel(events.where(F.col("experiment_id") == experiment), stages, ["variant"])

    def arm(name: str, column: str) -> Column:
        return F.max(F.when(F.col("variant") == name, F.col(column)))

    sides = arms.groupBy("step", "stage").agg(
        F.coalesce(arm("control", "count"), F.lit(0)).alias("control"),
        F.coalesce(arm("treatment", "count"), F.lit(0)).alias("treatment"),
        F.coalesce(arm("control", "percentage"), F.lit(0.0)).alias("control_pct"),
        F.coalesce(arm("treatment", "percentage"), F.lit(0.0)).alias("treatment_pct"),
    )
    gain = (F.col("treatment") - F.col("control")) / F.greatest("control", F.lit(1)) * F.lit(100)
    return sides.withColumn("improvement_percent", half_up(gain, 1)).orderBy("step")


def funnel_by_device(events: DataFrame, stages: Sequence[str] = fixed.FUNNEL_STAGES) -> DataFrame:
    return funnel(events.where(F.col("device").isNotNull()).withColumn("device", F.lower("device")), stages, ["device"])


def sessionize(
    events: DataFrame,
    gap_seconds: int = 1800,
    user: str = "customer_id",
    ts: str = "event_timestamp",
    tie: str = "event_id",
    chunk_seconds: int = 300,
) -> DataFrame:
    """Number the sessions of each user: a new one starts after ``gap_seconds`` without events.

    A user is cut into time chunks; starts are counted inside each chunk and the
    counts of earlier chunks are added from a summary with one row per chunk.
    """
    prior = with_neighbour(events, [user], [ts, tie], time_chunk(chunk_seconds, ts), F.col(ts), "_prior")
    pause = F.unix_micros(ts) - F.unix_micros("_prior")
    marked = prior.withColumn(
        "_start", F.when(F.col("_prior").isNull() | (pause > gap_seconds * 1_000_000), 1).otherwise(0)
    ).withColumn("_chunk", time_chunk(chunk_seconds, ts))
    inner = Window.partitionBy(user, "_chunk").orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(user).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        marked.groupBy(user, "_chunk")
        .agg(F.sum("_start").alias("_n"))
        .select(user, "_chunk", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_before"))
    )
    return (
        marked.withColumn("_within", F.sum("_start").over(inner))
        .join(before, [user, "_chunk"])
        .select(*events.columns, (F.col("_within") + F.col("_before")).cast("long").alias("session_no"))
    )


def conversion_by(events: DataFrame, attribute: str) -> DataFrame:
    """Sessions, converted sessions and rate by a session attribute (its largest non-blank value)."""
    per_session = events.groupBy("session_id").agg(
        F.max(F.when(F.col(attribute) != "", F.col(attribute))).alias(attribute),
        F.max(F.when(F.col("event_type") == CONVERTED, 1).otherwise(0)).alias("converted"),
    )
    return (
        per_session.where(F.col(attribute).isNotNull())
        .groupBy(attribute)
        .agg(F.count("session_id").alias("sessions"), F.sum("converted").alias("orders"))
        .withColumn("conversion_rate", half_up(F.try_divide("orders", "sessions"), 4))
        .orderBy(F.col("sessions").desc(), attribute)
    )


def time_to_convert(events: DataFrame) -> DataFrame:
    """Whole minutes from the first event to the purchase, in 5-minute buckets below an hour."""
    times = events.groupBy("session_id").agg(
        F.max(F.when(F.col("event_type") == CONVERTED, F.col("event_timestamp"))).alias("bought"),
        F.min("event_timestamp").alias("started"),
    )
    minutes = F.floor((F.unix_micros("bought") - F.unix_micros("started")) / F.lit(60_000_000))
    start = (F.floor(minutes / F.lit(5)) * 5).cast("int")
    return (
        times.where(F.col("bought").isNotNull())
        .where(minutes.between(0, 59))
        .groupBy(start.alias("minutes_start"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.concat_ws("-", F.col("minutes_start").cast("string"), (F.col("minutes_start") + 5).cast("string")).alias(
                "bucket"
            ),
            "minutes_start",
            "count",
        )
        .orderBy("minutes_start")
    )


def transitions(events: DataFrame, n: int = 20, chunk_seconds: int = 300) -> DataFrame:
    """The most frequent pairs of an event and the next one of its session, ``exit`` after the last.

    Pairs inside a (session, time chunk) are counted there; pairs across chunks
    come from the first and last event of every chunk. Neither needs a whole
    session in one task, and no row is joined.
    """
    order = ["event_timestamp", "event_id"]
    chunked = events.select("session_id", "event_type", *order, time_chunk(chunk_seconds).alias("_chunk"))
    inner = Window.partitionBy("session_id", "_chunk").orderBy(*order)
    inside = (
        chunked.select(F.col("event_type").alias("source"), F.lead("event_type").over(inner).alias("target"))
        .where(F.col("target").isNotNull())
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("value"))
    )
    rank = F.struct(*order)
    outer = Window.partitionBy("session_id").orderBy("_chunk")
    across = (
        chunked.groupBy("session_id", "_chunk")
        .agg(F.min_by("event_type", rank).alias("first_type"), F.max_by("event_type", rank).alias("source"))
        .select("source", F.coalesce(F.lead("first_type").over(outer), F.lit("exit")).alias("target"))
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("value"))
    )
    return (
        inside.unionByName(across)
        .groupBy("source", "target")
        .agg(F.sum("value").alias("value"))
        .orderBy(F.col("value").desc(), "source", "target")
        .limit(n)
    )


def abandonment(events: DataFrame) -> DataFrame:
    per_session = events.groupBy("session_id").agg(
        F.max(F.when(F.col("event_type") == "add_to_cart", 1).otherwise(0)).alias("cart"),
        F.max(F.when(F.col("event_type") == CONVERTED, 1).otherwise(0)).alias("bought"),
    )
    sums = per_session.agg(
        F.coalesce(F.sum("cart"), F.lit(0)).alias("carts"), F.coalesce(F.sum("bought"), F.lit(0)).alias("orders")
    )
    lost = F.col("carts") - F.col("orders")
    return sums.select(
        lost.alias("abandoned_carts"),
        F.coalesce(half_up(F.try_divide(lost, "carts") * F.lit(100), 1), F.lit(0.0)).alias("abandonment_rate"),
        "carts",
        "orders",
    )


def session_metrics(events: DataFrame, accuracy: int = 100_000) -> DataFrame:
    """Median duration (approximate quantile), pages, bounce and conversion of sessions."""
    per_session = events.groupBy("session_id").agg(
        F.floor(
            (F.unix_micros(F.max("event_timestamp")) - F.unix_micros(F.min("event_timestamp"))) / F.lit(1_000_000)
        ).alias("seconds"),
        F.count(F.lit(1)).alias("pages"),
        F.max(F.when(F.col("event_type") == CONVERTED, 1).otherwise(0)).alias("converted"),
    )
    total = F.count(F.lit(1))
    return per_session.agg(
        F.approx_percentile("seconds", 0.5, accuracy).alias("median_session_duration_sec"),
        half_up(F.avg("pages"), 1).alias("avg_pages_per_session"),
        half_up(F.try_divide(F.count_if(F.col("pages") <= 2), total) * F.lit(100), 1).alias("bounce_rate"),
        half_up(F.try_divide(F.sum("converted"), total) * F.lit(100), 1).alias("session_conversion"),
    )
