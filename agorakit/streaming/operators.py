"""Stream operators. Each takes a static or a streaming frame and declares the same plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agorakit.functions import fixed, from_units, half_up, money_sum, money_units


def enrich_orders(orders: DataFrame, customers: DataFrame, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Order messages with the customer's place and tier, as operational and analytic rows.

    ``customers``: customer_id, city, state, customer_tier. An unknown customer
    is flagged ``needs_enrichment``. On a stream this is a stream-static join with the dimension as it was when
    the query started; ``enrich_sink`` reads it anew for every batch.
    """
    moment = now if now is not None else F.current_timestamp()
    known = customers.select(
        "customer_id", F.col("city").alias("_city"), F.col("state").alias("_state"), F.col("customer_tier").alias("_tier")
    ).withColumn("_known", F.lit(True))
    joined = orders.join(known, "customer_id", "left")
    total = F.coalesce("order_total", F.lit(0.0))
    kind = F.coalesce("event_type", F.lit("order_placed"))
    operational = joined.select(
        "order_id",
        "customer_id",
        F.coalesce("_city", F.lit("unknown")).alias("customer_city"),
        F.coalesce("_state", F.lit("unknown")).alias("customer_state"),
        total.alias("order_total"),
        F.coalesce("order_status", F.lit("unknown")).alias("order_status"),
        kind.alias("event_type"),
        "experiment_id",
        "variant",
        F.coalesce("event_timestamp", moment).alias("event_timestamp"),
        moment.alias("processing_timestamp"),
        F.col("_known").isNull().alias("needs_enrichment"),
    )
    analytic = joined.select(
        "order_id",
        "customer_id",
        F.col("_state").alias("customer_state"),
        F.col("_tier").alias("customer_tier"),
        total.alias("order_total"),
        "order_status",
        kind.alias("event_type"),
        "experiment_id",
        "variant",
        "event_timestamp",
        moment.alias("processed_at"),
    )
    return operational, analytic


def window_partials(
    events: DataFrame, size: str = fixed.WINDOW_SIZE, order_types: Sequence[str] = ("order_placed",)
) -> DataFrame:
    """Sums per (window, session); they can be added up over any cut of the events."""
    is_order = F.col("event_type").isin(list(order_types))
    # only clicks name sessions
    session = F.when(~F.coalesce(is_order, F.lit(False)), F.nullif(F.col("session_id"), F.lit("")))
    return (
        events.where(F.col("event_timestamp").isNotNull())
        .withColumn("_session", session)
        .groupBy(F.window("event_timestamp", size).alias("window"), "_session")
        .agg(
            F.count_if(is_order).alias("orders"),
            F.sum(F.when(is_order, money_units(F.coalesce("order_total", F.lit(0.0))))).alias("gmv"),
            F.count(F.lit(1)).alias("rows"),
        )
    )


def window_totals(partials: DataFrame, size: str = fixed.WINDOW_SIZE) -> DataFrame:
    """Metrics of each window in long form, from sums that have one row for each window and session."""
    totals = partials.groupBy(F.window("window", size).alias("w")).agg(
        F.sum("orders").alias("orders"),
        half_up(F.coalesce(from_units(F.sum("gmv")), F.lit(0.0)), 2).alias("gmv"),
        F.count("_session").alias("sessions"),
        (F.sum("rows") - F.sum("orders")).alias("clicks"),
    )
    orders, gmv, sessions = F.col("orders"), F.col("gmv"), F.col("sessions")
    metrics = {
        "total_orders": orders.cast("double"),
        "total_gmv": gmv,
        "unique_sessions": sessions.cast("double"),
        "conversion_rate": F.coalesce(half_up(F.try_divide(orders, sessions) * F.lit(100), 2), F.lit(0.0)),
        "avg_order_value": F.coalesce(half_up(F.try_divide(gmv, orders), 2), F.lit(0.0)),
        "total_clicks": F.col("clicks").cast("double"),
    }
    rows = F.array(
        *[F.struct(F.lit(k).alias("metric_name"), v.alias("metric_value")) for k, v in metrics.items()]
    )
    return totals.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), F.explode(rows).alias("m")
    ).select("window_start", "window_end", "m.metric_name", "m.metric_value")


def window_metrics(
    events: DataFrame,
    grace: str | None = None,
    size: str = fixed.WINDOW_SIZE,
    order_types: Sequence[str] = ("order_placed",),
) -> DataFrame:
    """Tumbling-window metrics in long form: one row per window and metric.

    The first aggregate is per (window, session), the second per window: distinct
    sessions are exact, no session set is held in state, and a busy window is
    spread over its sessions. On a live stream run it in append mode (a window is
    emitted once the watermark passes its end); rows later than ``grace``, which a stream must give, are
    dropped and counted in the query's progress. To replay stored files, which come in no order of time, use
    ``window_partials`` for each batch and ``combined_partials`` with ``window_totals`` on reading: nothing is late then.
    """
    if events.isStreaming:
        if grace is None:
            raise ValueError("a stream needs a grace period")
        events = events.withWatermark("event_timestamp", grace)
    return window_totals(window_partials(events, size, order_types), size)


def combined_partials(partials: DataFrame) -> DataFrame:
    """Partial sums of several batches added up to one row for each window and session."""
    return partials.groupBy("window", "_session").agg(*[F.sum(c).alias(c) for c in ("orders", "gmv", "rows")])


def gap_sessions(
    events: DataFrame, gap_seconds: int = 1800, grace: str | None = None, user: str = "customer_id", ts: str = "event_timestamp"
) -> DataFrame:
    """Sessions of each user: a pause of more than ``gap_seconds`` ends one. First and last event and number of events.

    Static or streaming. On a stream the state holds the open sessions of each user; an event that falls between two of
    them, in whatever batch it comes, makes them one. A session is emitted (append mode) once event time has passed its end by
    ``grace``, which a stream must give; rows later than that are dropped and counted in the query's progress.
    Events without a user or a time belong to no session.
    """
    if events.isStreaming:
        if grace is None:
            raise ValueError("a stream needs a grace period")
        events = events.withWatermark(ts, grace)
    return (
        events.where(F.col(user).isNotNull())
        .groupBy(user, F.session_window(ts, f"{int(gap_seconds)} seconds").alias("_session"))
        .agg(F.count(F.lit(1)).alias("events"), F.max(ts).alias("ended_at"))
        .select(user, F.col("_session.start").alias("started_at"), "ended_at", "events")
    )


def experiment_counters(events: DataFrame) -> DataFrame:
    """Running impressions, clicks, conversions and revenue per experiment and variant.

    State is one row per (experiment, variant); run in update mode into an upsert.
    """
    kind = F.col("event_type")
    converted = kind.isin(fixed.CONVERSION_EVENTS)
    named = events.where((F.col("experiment_id") != "") & (F.col("variant") != ""))
    counts = named.groupBy("experiment_id", "variant").agg(
        F.count_if(kind.isin(fixed.IMPRESSION_EVENTS)).alias("impressions"),
        F.count_if(kind.isin(fixed.CLICK_EVENTS)).alias("clicks"),
        F.count_if(converted).alias("conversions"),
        half_up(F.coalesce(money_sum(F.when(converted, F.col("order_total"))), F.lit(0.0)), 2).alias("revenue"),
    )
    rate = half_up(F.try_divide("conversions", "impressions") * F.lit(100), 4)
    return counts.withColumn("conversion_rate", F.coalesce(rate, F.lit(0.0)))


def live_significance(counters: DataFrame, min_impressions: int = fixed.MIN_IMPRESSIONS) -> DataFrame:
    """Pooled z-test on the running counters, for experiments with enough impressions in both arms."""

    def arm(name: str, column: str) -> Column:
        return F.max(F.when(F.col("variant") == name, F.col(column)))

    sides = counters.groupBy("experiment_id").agg(
        arm("control", "impressions").alias("n_c"),
        arm("treatment", "impressions").alias("n_t"),
        arm("control", "conversions").alias("x_c"),
        arm("treatment", "conversions").alias("x_t"),
    )
    enough = sides.where((F.col("n_c") >= min_impressions) & (F.col("n_t") >= min_impressions))
    p_c, p_t = F.try_divide("x_c", "n_c"), F.try_divide("x_t", "n_t")
    pooled = F.try_divide(F.col("x_c") + F.col("x_t"), F.col("n_c") + F.col("n_t"))
    one = F.lit(1.0)
    # impressions and conversions are counted apart, so a pooled rate above 1 is
    # possible; it has no standard error
    variance = pooled * (one - pooled) * (F.try_divide(one, F.col("n_c")) + F.try_divide(one, F.col("n_t")))
    se = F.when(variance > 0, F.sqrt(variance))
    z = F.coalesce(F.try_divide(p_t - p_c, se), F.lit(0.0))
    return enough.select(
        "experiment_id", p_c.alias("rate_control"), p_t.alias("rate_treatment"), z.alias("z")
    ).select(
        "*",
        (F.abs("z") > F.lit(fixed.API_Z_ALPHA)).alias("significant"),
        F.when(F.col("z") > fixed.API_Z_ALPHA, "treatment").when(F.col("z") < -fixed.API_Z_ALPHA, "control").alias(
            "winner"
        ),
    )


def _alert_columns(shipped: Column, delivered: Column, seller: Column) -> list[Column]:
    days = (F.unix_micros(delivered) - F.unix_micros(shipped)) / F.lit(86_400_000_000.0)
    return [
        F.col("order_id"),
        seller.alias("seller_id"),
        shipped.alias("shipped_at"),
        delivered.alias("delivered_at"),
        half_up(days, 1).alias("days_to_deliver"),
        half_up(days - F.lit(fixed.SLA_DAYS), 1).alias("days_late"),
        (days > fixed.SLA_DAYS).alias("is_late"),
        F.when(days > fixed.SLA_CRITICAL_DAYS, "critical").otherwise("warning").alias("alert_severity"),
        delivered.alias("created_at"),
    ]


def delivery_alerts(events: DataFrame) -> DataFrame:
    """Orders delivered more than three days after shipping.

    ``events``: order_id, event_type, event_timestamp and optionally seller_id.
    Static input is one aggregate per order; the order of arrival does not matter.
    """
    seller = F.max("seller_id") if "seller_id" in events.columns else F.lit(None).cast("string")
    ts = F.col("event_timestamp")
    per_order = (
        events.where(F.col("event_type").isin("shipped", "delivered"))
        .groupBy("order_id")
        .agg(
            F.max(F.when(F.col("event_type") == "shipped", ts)).alias("_shipped"),
            F.max(F.when(F.col("event_type") == "delivered", ts)).alias("_delivered"),
            seller.alias("_seller"),
        )
        .where(F.col("_shipped").isNotNull() & F.col("_delivered").isNotNull())
    )
    return per_order.select(*_alert_columns(F.col("_shipped"), F.col("_delivered"), F.col("_seller"))).where("is_late")


def delivery_alerts_stream(events: DataFrame, max_days: int = 60, delay: str = "1 day") -> DataFrame:
    """The same on a stream, as a stream-stream join within a time bound.

    A shipped event is kept until ``max_days`` have passed. An order not delivered by then, delivered later
    or never, leaves the state with a critical alert that has no delivery time, created when the bound ran out. A
    delivery that arrives before its shipping event waits for it within ``delay``.
    """
    has_seller = "seller_id" in events.columns

    def side(kind: str, prefix: str) -> DataFrame:
        rows = events.where(F.col("event_type") == kind).withWatermark("event_timestamp", delay)
        extra = [F.col("seller_id").alias("_seller")] if has_seller and kind == "shipped" else []
        return rows.select(F.col("order_id").alias(f"{prefix}_id"), F.col("event_timestamp").alias(f"{prefix}_at"), *extra)

    bound = F.expr(f"s_id = d_id AND d_at > s_at AND d_at <= s_at + INTERVAL {int(max_days)} DAYS")
    joined = side("shipped", "s").join(side("delivered", "d"), bound, "left_outer").where(
        F.expr(f"d_at IS NULL OR d_at > s_at + INTERVAL {fixed.SLA_DAYS} DAYS")
    )
    seller = F.col("_seller") if has_seller else F.lit(None).cast("string")
    rows = joined.withColumnRenamed("s_id", "order_id").select(*_alert_columns(F.col("s_at"), F.col("d_at"), seller))
    open_since = F.col("shipped_at") + F.make_dt_interval(days=F.lit(max_days))
    missing = F.col("delivered_at").isNull()
    return rows.withColumns(
        {
            "is_late": F.coalesce("is_late", F.lit(True)),
            "alert_severity": F.when(missing, "critical").otherwise(F.col("alert_severity")),
            "created_at": F.coalesce("created_at", open_since),
        }
    )
