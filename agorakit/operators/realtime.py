"""Live operations views over the stream order table (``rt``) and window metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from agorakit.functions import half_up, money_sum
from agorakit.functions.grouping import first_per


def _day() -> Column:
    return F.to_date("event_timestamp")


def latest_day(rt: DataFrame) -> Column:
    """The newest day with events, as a scalar subquery."""
    return rt.agg(F.to_date(F.max("event_timestamp"))).scalar()


def _on_day(rt: DataFrame, day: Column, back: int = 0) -> DataFrame:
    """Rows of one day, as a timestamp range so the filter reaches the scan."""
    start = F.date_sub(day, back).cast("timestamp")
    ts = F.col("event_timestamp")
    return rt.where((ts >= start) & (ts < F.date_add(F.date_sub(day, back), 1).cast("timestamp")))


def _daily(rt: DataFrame, day: Column, days: int) -> DataFrame:
    """Measures per day of the last ``days`` days, distinct orders through a (day, order) pre-aggregate."""
    ts = F.col("event_timestamp")
    recent = rt.where(ts >= F.date_sub(day, days - 1).cast("timestamp"))
    per_order = recent.groupBy(_day().alias("d"), "order_id").agg(
        F.sum("order_total").alias("gmv"),
        F.count("order_total").alias("priced"),
        F.count_if(F.col("event_type") == "order_canceled").alias("canceled"),
        F.max("event_timestamp").alias("last_event"),
    )
    return per_order.groupBy("d").agg(
        F.coalesce(money_sum(F.col("gmv")), F.lit(0.0)).alias("gmv"),
        F.sum("priced").alias("priced"),
        F.count("order_id").alias("orders"),
        F.sum("canceled").alias("canceled"),
        F.max("last_event").alias("last_event"),
    )


def rt_sparkline(rt: DataFrame, days: int = 24) -> DataFrame:
    daily = _daily(rt, latest_day(rt), days)
    return daily.select(
        "d", "gmv", "orders", half_up(F.coalesce(F.try_divide("gmv", "priced"), F.lit(0.0)), 2).alias("aov")
    ).orderBy("d")


def rt_kpis(rt: DataFrame) -> DataFrame:
    """Key figures of the latest day and their change against the day before."""
    day = latest_day(rt)
    two = _daily(rt, day, 2)

    def today(column: str) -> Column:
        return F.max(F.when(F.col("d") == day, F.col(column)))

    def yesterday(column: str) -> Column:
        return F.max(F.when(F.col("d") == F.date_sub(day, 1), F.col(column)))

    zero = F.lit(0)
    row = two.agg(
        F.coalesce(today("gmv"), F.lit(0.0)).alias("total_gmv"),
        F.coalesce(today("orders"), zero).alias("total_orders"),
        today("priced").alias("priced"),
        today("last_event").alias("last_event"),
        F.coalesce(today("canceled"), zero).alias("canceled"),
        yesterday("gmv").alias("y_gmv"),
        yesterday("orders").alias("y_orders"),
    )

    def change(now: str, before: str) -> Column:
        return F.coalesce(half_up(F.try_divide(F.col(now) - F.col(before), F.col(before)) * F.lit(100), 1), F.lit(0.0))

    return row.select(
        "total_gmv",
        "total_orders",
        F.coalesce(F.try_divide("total_gmv", "priced"), F.lit(0.0)).alias("avg_order_value"),
        "last_event",
        half_up(F.col("total_orders") / F.lit(1440), 2).alias("orders_per_minute"),
        F.coalesce(half_up(F.try_divide("canceled", "total_orders") * F.lit(100), 2), F.lit(0.0)).alias("cancel_rate"),
        change("total_gmv", "y_gmv").alias("gmv_vs_yesterday"),
        change("total_orders", "y_orders").alias("orders_vs_yesterday"),
    )


def _hourly(rt: DataFrame) -> DataFrame:
    per_order = rt.groupBy(F.date_trunc("hour", "event_timestamp").alias("ts"), "order_id").agg(
        F.sum("order_total").alias("gmv")
    )
    return per_order.groupBy("ts").agg(
        F.count("order_id").alias("orders"), F.coalesce(money_sum(F.col("gmv")), F.lit(0.0)).alias("gmv")
    )


def rt_timeseries(rt: DataFrame) -> DataFrame:
    """Hours of the latest day next to the same hours of the day before."""
    day = latest_day(rt)
    today = _hourly(_on_day(rt, day)).withColumn("hour", F.hour("ts"))
    before = _hourly(_on_day(rt, day, 1)).select(
        F.hour("ts").alias("hour"), F.col("orders").alias("y_orders"), F.col("gmv").alias("y_gmv")
    )
    return (
        today.join(before, "hour", "left")
        .select(
            F.col("ts").alias("timestamp"),
            "orders",
            "gmv",
            F.coalesce("y_orders", F.lit(0)).alias("orders_yesterday"),
            F.coalesce("y_gmv", F.lit(0.0)).alias("gmv_yesterday"),
        )
        .orderBy("timestamp")
    )


def rt_by_state(rt: DataFrame, n: int = 15) -> DataFrame:
    """Top states of the latest day with their share of the rows returned."""
    per_order = (
        _on_day(rt, latest_day(rt))
        .where(F.col("customer_state").isNotNull())
        .groupBy(F.col("customer_state").alias("state"), "order_id")
        .agg(F.sum("order_total").alias("total"))
    )
    top = (
        per_order.groupBy("state")
        .agg(F.count("order_id").alias("orders"), F.coalesce(money_sum(F.col("total")), F.lit(0.0)).alias("revenue"))
        .orderBy(F.col("revenue").desc(), "state")
        .limit(n)
    )
    total = half_up(F.sum("revenue").over(Window.partitionBy()), 4)
    return top.withColumn("share_pct", half_up(F.try_divide(F.col("revenue"), total) * F.lit(100), 1))


def rt_by_status(rt: DataFrame) -> DataFrame:
    return (
        _on_day(rt, latest_day(rt))
        .groupBy(F.col("event_type").alias("status"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "status")
    )


def rt_recent(rt: DataFrame, n: int = 15) -> DataFrame:
    return (
        rt.select("order_id", "customer_id", "customer_state", "order_total", "event_type", "event_timestamp")
        .orderBy(F.col("event_timestamp").desc(), "order_id")
        .limit(n)
    )


def cancellation_trend(rt: DataFrame, hours: int = 48) -> DataFrame:
    return (
        rt.groupBy(F.date_trunc("hour", "event_timestamp").alias("timestamp"))
        .agg(F.count_if(F.col("event_type") == "order_canceled").alias("canceled"), F.count(F.lit(1)).alias("total"))
        .orderBy(F.col("timestamp").desc())
        .limit(hours)
        .select("timestamp", half_up(F.try_divide("canceled", "total") * F.lit(100), 2).alias("rate"))
        .orderBy("timestamp")
    )


def last_hours(rt: DataFrame, now: Column | str, hours: int = 24, ts: str = "event_timestamp") -> DataFrame:
    moment = (F.lit(now) if isinstance(now, str) else now).cast("timestamp")
    return rt.where(F.col(ts) >= moment - F.expr(f"INTERVAL {int(hours)} HOURS"))


def gmv_5min(metrics: DataFrame, now: Column | str, hours: int = 24) -> DataFrame:
    recent = last_hours(metrics.where(F.col("metric_name") == "total_gmv"), now, hours, "window_start")
    return recent.select("window_start", F.col("metric_value").alias("gmv"))


def stream_today(rt: DataFrame, day: Column | str) -> DataFrame:
    """Figures of one day on the table reduced to the latest event per order."""
    date = (F.lit(day) if isinstance(day, str) else day).cast("date")
    latest = first_per(
        rt.select("order_id", "customer_id", "order_total", "event_timestamp"),
        ["order_id"],
        ["event_timestamp", "customer_id", "order_total"],
        ascending=False,
    )
    per_customer = (
        _on_day(latest, date)
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("orders"), F.sum("order_total").alias("gmv"), F.count("order_total").alias("n"))
    )
    return per_customer.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders_today"),
        money_sum(F.col("gmv")).alias("gmv_today"),
        F.try_divide(money_sum(F.col("gmv")), F.sum("n")).alias("avg_order_value"),
        F.count("customer_id").alias("unique_customers"),
    )


def metric_series(metrics: DataFrame, name: str, since: Column | str) -> DataFrame:
    start = (F.lit(since) if isinstance(since, str) else since).cast("timestamp")
    return (
        metrics.where((F.col("metric_name") == name) & (F.col("window_start") >= start))
        .select("window_start", "window_end", "metric_value")
        .orderBy(F.col("window_start").desc())
    )


def sla_violations(alerts: DataFrame, since: Column | str) -> DataFrame:
    """Late deliveries per day with the number of sellers behind them."""
    start = (F.lit(since) if isinstance(since, str) else since).cast("timestamp")
    per_seller = (
        alerts.where(F.col("is_late") & (F.col("created_at") >= start))
        .groupBy(F.to_date("created_at").alias("alert_date"), "seller_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("days_to_deliver").alias("days"))
    )
    return (
        per_seller.groupBy("alert_date")
        .agg(
            F.sum("n").alias("total_alerts"),
            (money_sum(F.col("days")) / F.sum("n")).alias("avg_late_days"),
            F.count("seller_id").alias("sellers_affected"),
        )
        .orderBy(F.col("alert_date").desc())
    )

