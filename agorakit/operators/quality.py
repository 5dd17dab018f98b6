"""Data quality, freshness, stream health and anomalies; every check is a row, not an exception."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from agorakit.functions import fixed, half_up, money_sum
from agorakit.functions.grouping import first_per, with_neighbour

ERROR, WARN = "error", "warning"


@dataclass(frozen=True)
class Check:
    """A named aggregate giving the number of violations of a table."""

    name: str
    violations: Column
    severity: str = ERROR
    tolerance: float = 0.0  # share of rows that may violate


def not_null(column: str, severity: str = ERROR) -> Check:
    return Check(f"not_null:{column}", F.count_if(F.col(column).isNull()), severity)


def accepted(column: str, values: Sequence[str], severity: str = ERROR) -> Check:
    bad = ~F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    return Check(f"accepted:{column}", F.count_if(bad), severity)


def non_negative(column: str, severity: str = ERROR) -> Check:
    return Check(f"non_negative:{column}", F.count_if(F.col(column) < 0), severity)


def in_range(column: str, low: float, high: float, severity: str = ERROR) -> Check:
    return Check(f"range:{column}", F.count_if(~F.col(column).between(low, high)), severity)


def unique(*columns: str, severity: str = ERROR) -> Check:
    key = F.struct(*columns) if len(columns) > 1 else F.col(columns[0])
    return Check(f"unique:{','.join(columns)}", F.count(key) - F.count_distinct(key), severity)


def has_rows(severity: str = WARN) -> Check:
    return Check("has_rows", F.when(F.count(F.lit(1)) > 0, 0).otherwise(1), severity)


def identity(name: str, left: Column, right: Column, tolerance: float = 0.01, severity: str = ERROR) -> Check:
    return Check(f"identity:{name}", F.count_if(F.abs(left - right) > tolerance), severity)


def ordered(earlier: str, later: str, severity: str = ERROR, tolerance: float = 0.0) -> Check:
    return Check(f"ordered:{earlier}<={later}", F.count_if(F.col(later) < F.col(earlier)), severity, tolerance)


def has_values(column: str, values: Sequence[str], severity: str = WARN) -> Check:
    """Every one of ``values`` occurs, such as both source layers."""
    missing = sum((F.when(F.count_if(F.col(column) == v) > 0, 0).otherwise(1) for v in values), start=F.lit(0))
    return Check(f"has_values:{column}", missing, severity)


def run_checks(df: DataFrame, checks: Sequence[Check], table: str = "") -> DataFrame:
    """All checks of a table in one aggregate over it, one row per check."""
    names = [f"_c{i}" for i in range(len(checks))]
    row = df.agg(
        F.count(F.lit(1)).alias("_total"), *[c.violations.cast("long").alias(n) for c, n in zip(checks, names)]
    )
    results = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c.name).alias("check_name"),
            F.lit(c.severity).alias("severity"),
            (F.col(n) <= F.col("_total") * F.lit(c.tolerance)).alias("passed"),
            F.col(n).alias("violations"),
            F.col("_total").alias("total"),
        )
        for c, n in zip(checks, names)
    ]
    return row.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def standard_checks() -> dict[str, list[Check]]:
    """The checks of every table of the model."""
    known = fixed.STATUS_COMPLETED + fixed.STATUS_IN_PROGRESS + fixed.STATUS_CANCELED + ["unknown"]
    approved = F.col("order_approved_at")
    delivered = F.col("order_delivered_customer_date")
    base = F.coalesce(approved, F.col("order_purchase_timestamp"))
    times = (approved < F.col("order_purchase_timestamp")) | (delivered < base)
    return {
        "stg_orders": [
            not_null("order_id"),
            accepted("order_status", known),
            Check("timestamps", F.count_if(F.coalesce(times, F.lit(False)))),
        ],
        "stg_payments": [not_null("order_id")],
        "stg_customers": [not_null("customer_id")],
        "stg_products": [
            Check(
                "non_negative:dimensions",
                sum(
                    (
                        F.count_if(F.col(c) < 0)
                        for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
                    ),
                    start=F.lit(0),
                ),
            )
        ],
        "stg_reviews": [in_range("review_score", 1, 5)],
        "stg_order_items": [non_negative("price")],
        "dim_customers": [unique("customer_id")],
        "dim_sellers": [unique("seller_id")],
        "fct_order_items": [
            has_rows(),
            identity("item_total", F.col("item_total"), F.col("price") + F.col("freight_value")),
        ],
        "fct_product_performance": [has_rows(), non_negative("total_revenue")],
        "fct_seller_performance": [has_rows(), in_range("late_delivery_rate", 0, 100)],
        "fct_experiment_results": [has_rows()],
        "realtime_orders": [has_rows(), non_negative("order_total")],
        "realtime_metrics": [has_rows()],
        "experiments_realtime": [in_range("conversion_rate", 0, 100)],
        "unified_orders": [has_rows(), unique("order_id"), has_values("_source_layer", ["batch", "stream"])],
        "unified_daily": [has_rows()],
        "unified_experiments": [has_rows()],
    }


def count_drift(a: DataFrame, b: DataFrame, pct: float = 5.0) -> DataFrame:
    """Row counts of two layers and whether they differ by at most ``pct`` percent of the first."""
    other = b.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = a.agg(F.count(F.lit(1)).alias("count_a")).withColumn("count_b", other)
    diff = F.abs(F.col("count_a") - F.col("count_b")) / F.greatest("count_a", F.lit(1)) * F.lit(100)
    return counts.withColumn("_d", diff).select(
        "count_a", "count_b", half_up(F.col("_d"), 2).alias("diff_pct"), (F.col("_d") <= pct).alias("passed")
    )


def stream_drift(recon: DataFrame, limit: float = 50.0) -> DataFrame:
    """Share of stream ids the batch layer does not have, from a reconciliation."""

    def count(category: str) -> Column:
        return F.max(F.when(F.col("category") == category, F.col("order_count")))

    sums = recon.agg(
        count("stream_only").alias("stream_only_orders"),
        (count("stream_only") + count("overlap")).alias("stream_total"),
    )
    drift = F.col("stream_only_orders") / F.greatest("stream_total", F.lit(1)) * F.lit(100)
    return sums.withColumn("_d", drift).select(
        "stream_only_orders", "stream_total", half_up(F.col("_d"), 1).alias("drift_pct"), (F.col("_d") < limit).alias("passed")
    )


def check_order(df: DataFrame, key: str, seq: str, value: str, chunk: Column | None = None) -> DataFrame:
    """Per key, how often ``value`` falls while ``seq`` (arrival) grows."""
    part = chunk if chunk is not None else F.floor(F.col(seq) / F.lit(4096))
    prior = with_neighbour(df, [key], [seq], part, F.col(value), "_prior")
    return prior.groupBy(key).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col(value) < F.col("_prior")).alias("out_of_order")
    )


def check_messages(df: DataFrame, topic: str, now: Column | str | None = None, time: str = "timestamp") -> DataFrame:
    """Messages of a topic with schema issues, one array of issues per message."""
    moment = F.current_timestamp() if now is None else (F.lit(now) if isinstance(now, str) else now).cast("timestamp")
    stamp = F.try_to_timestamp(F.col(time).cast("string"))
    given = F.coalesce(F.col(time).cast("string") != "", F.lit(False))
    issues: list[Column] = []
    for name in fixed.TOPIC_FIELDS[topic]:
        if name not in df.columns:
            issues.append(F.lit(f"Missing {name}"))
            continue
        text = F.col(name).cast("string")
        issues += [
            F.when(text.isNull(), F.lit(f"Missing {name}")),
            F.when(text == "", F.lit(f"Empty {name}")),
        ]
    issues += [
        F.when(given & stamp.isNull(), F.lit("Invalid timestamp format")),
        F.when(stamp > moment, F.lit("Future timestamp")),
    ]
    if "variant" in df.columns and "experiment_id" in df.columns:
        stray = (F.col("experiment_id") != "") & (F.col("variant") != "") & ~F.col("variant").isin(fixed.VARIANTS)
        issues.append(F.when(stray, F.concat(F.lit("Invalid variant: "), F.col("variant"))))
    found = F.array_compact(F.array(*issues))
    return df.withColumn("issues", found).where(F.size("issues") > 0)


def message_issue_counts(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("messages"))


def validate_events(
    events: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame | None,
    items: DataFrame,
    assignments: DataFrame,
    now: Column | str,
    experiment: str = "exp_001",
    arrival: str = "event_id",
    event_types: Sequence[str] = fixed.EVENT_TYPES,
    required: Sequence[str] = ("event_id", "event_type", "session_id", "customer_id"),
) -> DataFrame:
    """The event log against the batch tables: coverage, orphans, order, totals, ranges, split.

    ``events`` has event_id, event_type, event_timestamp, session_id, customer_id,
    variant, and optionally order_id, product_id and total. Order within a
    session is judged by ``arrival``.
    """
    moment = (F.lit(now) if isinstance(now, str) else now).cast("timestamp")
    kind = F.col("event_type")
    bought = events.where((kind == "checkout_complete") & (F.col("order_id") != ""))
    bought_ids = bought.select("order_id").distinct()

    def missing(ids: DataFrame, known: DataFrame, key: str) -> DataFrame:
        return ids.where(F.col(key).isNotNull()).select(key).distinct().join(known.select(key).distinct(), key, "left_anti")

    seen = events.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
    assigned = assignments.where(F.col("experiment_id") == experiment)
    rows: list[DataFrame] = []

    def add(name: str, df: DataFrame, bad: Column, total: Column | None = None) -> None:
        rows.append(
            df.agg(bad.cast("long").alias("violations")).select(
                F.lit(name).alias("check_name"), (F.col("violations") == 0).alias("passed"), "violations"
            )
        )

    every = F.count(F.lit(1))
    add("all_orders_have_events", missing(orders, bought_ids, "order_id"), every)
    add("all_customers_known", missing(events, customers, "customer_id"), every)
    if products is not None and "product_id" in events.columns:
        add(
            "all_products_known",
            missing(events.where(kind.isin("add_to_cart", "product_view")), products, "product_id"),
            every,
        )
    add(
        "all_customers_have_assignments",
        missing(seen.join(customers.select("customer_id"), "customer_id", "left_semi"), assigned, "customer_id"),
        every,
    )
    disordered = check_order(
        events.where(F.col("session_id") != "").withColumn("_arrival", F.col(arrival).cast("long")),
        "session_id",
        "_arrival",
        "event_timestamp",
    )
    add("timestamps_chronological", disordered, F.count_if(F.col("out_of_order") > 0))
    if "total" in events.columns:
        expected = items.groupBy("order_id").agg(half_up(F.sum("price"), 2).alias("expected"))
        off = F.abs(F.col("total") - F.coalesce("expected", F.lit(0.0))) > 0.01
        add("order_totals_match", bought.where(F.col("total").isNotNull()).join(expected, "order_id", "left"), F.count_if(off))

    # One pass over the events, reduced to sessions, serves all remaining counts.
    fields = [F.col(c).isNull() for c in required]
    bad_schema = (
        sum((f.cast("int") for f in fields), start=F.lit(0))
        + F.when((kind != "") & ~kind.isin(list(event_types)), 1).otherwise(0)
        + F.when((F.col("variant") != "") & ~F.col("variant").isin(fixed.VARIANTS), 1).otherwise(0)
    )
    per_session = events.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n"),
        ((F.unix_micros(F.max("event_timestamp")) - F.unix_micros(F.min("event_timestamp"))) / F.lit(60_000_000.0)).alias(
            "minutes"
        ),
        F.count_if(F.col("event_timestamp") > moment).alias("future"),
        F.sum(bad_schema).alias("schema_issues"),
        F.count_if(kind == "session_start").alias("starts"),
        F.count_if(kind == "page_view").alias("views"),
        F.count_if(kind == "checkout_complete").alias("completes"),
    )
    order_count = bought_ids.agg(every.alias("n")).scalar()
    real = F.col("session_id") != ""
    totals = per_session.agg(
        F.sum("n").alias("events"),
        F.avg(F.when(real, F.col("minutes"))).alias("minutes"),
        F.coalesce(F.sum("future"), F.lit(0)).alias("future"),
        F.coalesce(F.sum("schema_issues"), F.lit(0)).alias("schema_issues"),
        F.sum("starts").alias("starts"),
        F.sum("views").alias("views"),
        F.sum("completes").alias("completes"),
    ).withColumn("orders", order_count)
    per_order = F.col("events") / F.greatest("orders", F.lit(1))

    def flag(name: str, ok: Column, count: Column | None = None) -> Column:
        n = count if count is not None else F.when(ok, 0).otherwise(1)
        return F.struct(F.lit(name).alias("check_name"), ok.alias("passed"), n.cast("long").alias("violations"))

    flags = [
        flag("events_per_order_reasonable", per_order.between(8, 15)),
        flag("session_duration_realistic", F.coalesce(F.col("minutes").between(5, 90), F.lit(False))),
        flag("no_future_timestamps", F.col("future") == 0, F.col("future")),
        flag("schema_valid", F.col("schema_issues") == 0, F.col("schema_issues")),
        flag(
            "funnel_makes_sense",
            (F.col("views") >= F.col("completes")) & (F.col("starts") >= F.col("completes")),
        ),
    ]
    rows.append(totals.select(F.explode(F.array(*flags)).alias("r")).select("r.*"))

    arms = assigned.groupBy("customer_id").agg(
        F.count_if(F.col("variant") == "control").alias("c"), F.count_if(F.col("variant") == "treatment").alias("t")
    )
    split = arms.agg(
        F.sum("c").alias("c"), F.sum("t").alias("t"), F.count_if((F.col("c") > 0) & (F.col("t") > 0)).alias("both")
    )
    share = F.try_divide(F.col("c"), F.col("c") + F.col("t")) * F.lit(100)
    rows.append(
        split.select(
            F.explode(
                F.array(
                    flag("experiment_50_50_split", F.coalesce(share.between(49, 51), F.lit(False))),
                    flag("no_customer_in_both_variants", F.col("both") == 0, F.col("both")),
                )
            ).alias("r")
        ).select("r.*")
    )
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def event_stats(events: DataFrame) -> DataFrame:
    """Events per type, as the validator reports them."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def lag_status(lag: Column) -> Column:
    return F.when(lag > fixed.LAG_CRITICAL, "critical").when(lag > fixed.LAG_WARNING, "warning").otherwise("healthy")


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """Lag and status per consumer group and measurement, summed over its partitions."""
    behind = F.greatest(F.lit(0), F.col("head") - F.col("committed"))
    return (
        offsets.groupBy("consumer_group", "measured_at")
        .agg(
            F.array_join(F.array_sort(F.collect_set("topic")), ",").alias("topics"),
            F.sum(behind).cast("long").alias("total_lag"),
            F.count(F.lit(1)).cast("int").alias("partitions"),
        )
        .withColumn("status", lag_status(F.col("total_lag")))
    )


def table_stats(tables: Mapping[str, tuple[DataFrame, str]], now: Column | str) -> DataFrame:
    """Row count and newest timestamp of each table; ``tables`` maps a label to (frame, time column)."""
    moment = (F.lit(now) if isinstance(now, str) else now).cast("timestamp")
    out = None
    for label, (df, column) in tables.items():
        one = df.agg(
            F.count(F.lit(1)).alias("document_count"), F.max(F.col(column).cast("timestamp")).alias("newest_timestamp")
        ).select(
            F.lit(label).alias("collection"), F.lit(label).alias("label"), "document_count", "newest_timestamp",
            moment.alias("measured_at"),
        )
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no tables given")
    return out


def consumer_health(offsets: DataFrame, stats: DataFrame) -> DataFrame:
    """Consumer lag and table statistics in one table; columns the other kind lacks are null."""
    lags = consumer_lag(offsets).withColumn("source", F.lit("kafka"))
    return lags.unionByName(stats.withColumn("source", F.lit("table")), allowMissingColumns=True)


def latest_health(health: DataFrame) -> DataFrame:
    """Newest row of each consumer group, largest lag first."""
    named = health.where(F.col("consumer_group").isNotNull()).select(
        "consumer_group", "topics", "total_lag", "partitions", "status", "measured_at"
    )
    newest = first_per(named, ["consumer_group"], ["measured_at", "total_lag"], ascending=False)
    return newest.orderBy(F.col("total_lag").desc(), "consumer_group")


def health_check(latest: DataFrame) -> DataFrame:
    bad = F.count_if(F.col("status").isin("critical", "unreachable"))
    return latest.agg(F.count(F.lit(1)).alias("total_groups"), bad.alias("critical_groups")).withColumn(
        "passed", F.col("critical_groups") == 0
    )


def lag_history(health: DataFrame, hours: int = 24) -> DataFrame:
    """Lag of the last hours: one row for each measurement and consumer group, whatever groups there are."""
    named = health.where(F.col("consumer_group").isNotNull())
    newest = named.agg(F.max("measured_at")).scalar()
    recent = named.where(F.col("measured_at") >= newest - F.expr(f"INTERVAL {int(hours)} HOURS"))
    return (
        recent.groupBy(F.col("measured_at").alias("timestamp"), "consumer_group")
        .agg(F.max("total_lag").alias("total_lag"))
        .orderBy("timestamp", "consumer_group")
    )


def throughput(metrics: DataFrame, hours: int = 24) -> DataFrame:
    """Hourly sums of three stream metrics, as columns."""
    newest = metrics.agg(F.max("window_start")).scalar()
    recent = metrics.where(F.col("window_start") >= newest - F.expr(f"INTERVAL {int(hours)} HOURS"))

    def total(metric: str, name: str) -> Column:
        value = F.when(F.col("metric_name") == metric, F.col("metric_value"))
        return half_up(F.coalesce(money_sum(value), F.lit(0.0)), 1).alias(name)

    return (
        recent.groupBy(F.date_trunc("hour", "window_start").alias("timestamp"))
        .agg(
            total("total_orders", "orders_stream"),
            total("total_clicks", "clickstream"),
            total("total_gmv", "deliveries_stream"),
        )
        .orderBy("timestamp")
    )


def sla_calendar(daily: DataFrame, n: int = 30, target_minutes: int = 1440) -> DataFrame:
    """Gap to the day before for the last days of the daily mart; a gap of one day meets the target."""
    days = daily.where(F.col("date").isNotNull()).select("date").distinct()
    prior = F.lag("date").over(Window.orderBy("date"))
    gap = F.datediff("date", "_prior")
    return (
        days.withColumn("_prior", prior)
        .orderBy(F.col("date").desc())
        .limit(n + 1)
        .where(F.col("_prior").isNotNull())
        .orderBy(F.col("date").desc())
        .limit(n)
        .select(
            "date",
            (gap <= 1).alias("sla_met"),
            (gap * 1440).alias("duration_min"),
            F.lit(target_minutes).alias("sla_target_min"),
        )
        .orderBy("date")
    )


def sla_days_met(calendar: DataFrame) -> DataFrame:
    return calendar.agg(F.count_if("sla_met").alias("days_met"), F.count(F.lit(1)).alias("days"))


def recent_alerts(alerts: DataFrame, n: int = 20) -> DataFrame:
    return (
        alerts.orderBy(F.col("created_at").desc(), "order_id")
        .limit(n)
        .select(
            F.col("created_at").alias("timestamp"),
            F.lit("Delivery SLA").alias("type"),
            F.col("alert_severity").alias("severity"),
            F.concat(
                F.lit("Order "), F.col("order_id"), F.lit(" — "), F.floor("days_to_deliver").cast("string"),
                F.lit(" days to deliver"),
            ).alias("message"),
            F.when(F.col("is_late"), "open").otherwise("resolved").alias("status"),
        )
    )


def health_score(latest: DataFrame, alerts: DataFrame, fresh: DataFrame | None = None) -> DataFrame:
    """Percent of healthy consumers less 5 per open alert, with its band.

    Without consumers the share of fresh tables (output of ``freshness``) counts.
    """
    opened = alerts.agg(F.count_if(F.col("status") == "open")).scalar()
    counts = latest.agg(
        F.count_if(F.col("status") == "healthy").alias("healthy_consumers"), F.count(F.lit(1)).alias("total_consumers")
    )
    if fresh is None:
        spare = F.lit(0)
    else:
        share = F.floor(F.count_if(F.col("status") == "fresh") / F.greatest(F.count(F.lit(1)), F.lit(1)) * 100)
        spare = F.coalesce(fresh.agg(share).scalar(), F.lit(0))
    base = F.coalesce(F.floor(F.try_divide("healthy_consumers", "total_consumers") * F.lit(100)), spare)
    score = F.greatest(F.lit(0), base - F.col("open_alerts") * 5).cast("int")
    return (
        counts.withColumn("open_alerts", opened)
        .withColumn("score", score)
        .withColumn(
            "status", F.when(F.col("score") >= 90, "excellent").when(F.col("score") >= 70, "warning").otherwise("critical")
        )
        .select("score", "healthy_consumers", "total_consumers", "open_alerts", "status")
    )


def freshness(stats: DataFrame, sla_hours: int | Mapping[str, int] = 72, now: Column | str | None = None) -> DataFrame:
    """Age of each table's newest row against its allowed age (input: ``table_stats``)."""
    moment = F.col("measured_at") if now is None else (F.lit(now) if isinstance(now, str) else now).cast("timestamp")
    if isinstance(sla_hours, int):
        allowed = F.lit(sla_hours)
    else:
        pairs = F.create_map(*[F.lit(x) for pair in sla_hours.items() for x in pair])
        allowed = F.element_at(pairs, F.col("label"))
    age = (F.unix_micros(moment) - F.unix_micros("newest_timestamp")) / F.lit(3_600_000_000.0)
    return stats.select(
        F.col("label").alias("dataset"),
        F.col("document_count").alias("row_count"),
        F.col("newest_timestamp").alias("last_updated"),
        half_up(age, 2).alias("age_hours"),
        allowed.alias("sla_hours"),
        F.when(F.col("newest_timestamp").isNull() | allowed.isNull(), "unknown")
        .when(age <= allowed, "fresh")
        .otherwise("stale")
        .alias("status"),
    )


def growth(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Rows added to each table since an earlier ``table_stats``."""
    before = previous.select("label", F.col("document_count").alias("_before"))
    delta = F.col("document_count") - F.coalesce("_before", F.lit(0))
    return current.join(before, "label", "left").select(
        "label", "document_count", delta.alias("new_rows"), (delta > 0).alias("changed")
    )


def anomaly_scan(
    daily: DataFrame, reviews: DataFrame, orders: DataFrame, stats: DataFrame | None = None, min_orders: int = 10
) -> DataFrame:
    """Findings about the latest day with more than ``min_orders`` orders: GMV, cancellations, delivery times, reviews and stale tables.

    Windows run over one row per calendar day. ``stats`` (from ``table_stats``)
    adds freshness findings with limits of 24 h, critical above twice that.
    """
    month = Window.orderBy("date").rowsBetween(-30, -1)
    busy = daily.where(F.col("total_orders") > min_orders)
    last = F.col("_age") == 1
    age = F.row_number().over(Window.orderBy(F.col("date").desc()))

    mean = F.try_divide(half_up(F.sum("total_gmv").over(month), 4), F.count("total_gmv").over(month))
    gmv = (
        busy.select("date", F.col("total_gmv").alias("value"), mean.alias("expected"),
                    F.stddev_samp("total_gmv").over(month).alias("sd"), age.alias("_age"))
        .where(last & (F.col("expected") > 0))
    )
    # a missing or zero deviation counts as 1
    spread = F.when(F.coalesce(F.col("sd"), F.lit(0.0)) == 0, 1.0).otherwise(F.col("sd"))
    z = F.try_divide(F.col("value") - F.col("expected"), spread)
    found_gmv = gmv.withColumn("score", z).where(F.abs("score") > 2).select(
        F.lit("Daily GMV").alias("metric"),
        F.when(F.abs("score") > 3, "critical").otherwise("warning").alias("severity"),
        half_up(F.col("value"), 2).alias("value"),
        half_up(F.col("expected"), 2).alias("expected"),
        half_up(F.col("score"), 2).alias("score"),
        "date",
    )

    def ratio_finding(df: DataFrame, value: Column, name: str, factor: float) -> DataFrame:
        valued = df.withColumn("value", value)
        expected = F.try_divide(half_up(F.sum("value").over(month), 8), F.count("value").over(month))
        latest = valued.select("date", "value", expected.alias("expected"), age.alias("_age")).where(last)
        hit = latest.where((F.col("expected") > 0) & (F.col("value") > F.col("expected") * F.lit(factor)))
        return hit.select(
            F.lit(name).alias("metric"),
            F.lit("warning").alias("severity"),
            half_up(F.col("value"), 2).alias("value"),
            half_up(F.col("expected"), 2).alias("expected"),
            half_up(F.col("value") / F.col("expected"), 2).alias("score"),
            "date",
        )

    canceled = ratio_finding(
        busy, F.try_divide("orders_canceled", "total_orders") * F.lit(100), "Cancellation Rate", 1.5
    )
    slow = ratio_finding(
        daily.where(F.col("avg_delivery_time_days") > 0), F.col("avg_delivery_time_days"), "Delivery Time", 1.3
    )

    newest = orders.agg(F.max(F.to_date("order_purchase_timestamp"))).scalar()
    recent_orders = orders.where(
        F.col("order_purchase_timestamp") >= F.date_sub(newest, 7).cast("timestamp")
    ).select("order_id")
    recent = reviews.join(recent_orders, "order_id", "left_semi").agg(F.avg("review_score")).scalar()
    scores = reviews.agg(F.avg("review_score").alias("expected")).withColumn("value", recent)
    reviewed = scores.where(
        (F.col("expected") > 0) & (F.coalesce("value", F.lit(0.0)) < F.col("expected") * F.lit(0.9))
    ).select(
        F.lit("Review Score").alias("metric"),
        F.lit("warning").alias("severity"),
        half_up(F.coalesce("value", F.lit(0.0)), 2).alias("value"),
        half_up(F.col("expected"), 2).alias("expected"),
        half_up(F.coalesce("value", F.lit(0.0)) / F.col("expected"), 2).alias("score"),
        F.lit(None).cast("date").alias("date"),
    )
    findings = found_gmv.unionByName(canceled).unionByName(slow).unionByName(reviewed)
    if stats is not None:
        hours = (F.unix_micros("measured_at") - F.unix_micros("newest_timestamp")) / F.lit(3_600_000_000.0)
        stale = stats.withColumn("value", hours).where(F.col("value") > 24).select(
            F.concat(F.lit("Data Freshness: "), F.col("label")).alias("metric"),
            F.when(F.col("value") > 48, "critical").otherwise("warning").alias("severity"),
            half_up(F.col("value"), 2).alias("value"),
            F.lit(24.0).alias("expected"),
            half_up(F.col("value") / F.lit(24.0), 2).alias("score"),
            F.to_date("newest_timestamp").alias("date"),
        )
        findings = findings.unionByName(stale)
    return findings


def describe(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Columns of a table in order, with type and nullability."""
    session = spark or df.sparkSession
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return session.createDataFrame(rows, "position int, column_name string, data_type string, is_nullable boolean")


def layer_accuracy(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Cross-layer rules: deliveries before purchase below 1 %, prices not negative, ids unique."""
    delivered = orders.where(
        F.col("order_purchase_timestamp").isNotNull() & F.col("order_delivered_customer_date").isNotNull()
    )
    early = run_checks(
        delivered,
        [ordered("order_purchase_timestamp", "order_delivered_customer_date", tolerance=0.01)],
        "orders",
    )
    ids = run_checks(orders, [unique("order_id"), has_rows()], "orders")
    prices = run_checks(items, [non_negative("price"), has_rows()], "order_items")
    people = run_checks(customers, [unique("customer_id"), has_rows()], "customers")
    return early.unionByName(ids).unionByName(prices).unionByName(people)


def profile(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Null count and rate of every column and the number of repeated keys, one row per column."""
    keys = [key] if isinstance(key, str) else list(key)
    duplicates = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") - 1)).scalar()
    row = df.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in df.columns]
    )
    columns = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n_{c}").alias("null_count")) for c in df.columns
    ]
    return (
        row.select("_total", F.explode(F.array(*columns)).alias("c"))
        .select(
            "c.column_name",
            F.col("_total").alias("row_count"),
            "c.null_count",
            half_up(F.coalesce(F.try_divide("c.null_count", "_total"), F.lit(0.0)) * F.lit(100), 2).alias("null_pct"),
        )
        .withColumn("duplicate_keys", F.coalesce(duplicates, F.lit(0)))
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key ``parent`` does not have, counted per key first."""
    counted = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    lost = counted.join(parent.select(key).distinct(), key, "left_anti")
    return lost.agg(
        F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")
    )


