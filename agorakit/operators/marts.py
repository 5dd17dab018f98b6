"""Aggregate marts and the small aggregations built on facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from agorakit.functions import half_up, money_avg, money_sum, ratio_pct


def fct_daily_metrics(fct: DataFrame) -> DataFrame:
    """Business metrics per order day.

    The distinct customers come from a (day, customer) pre-aggregate that also
    carries every other measure: one exchange keyed by day and customer, no row
    expansion, and a busy day is spread over its customers.
    """
    status = F.col("order_status")
    per_customer = (
        fct.where(F.col("order_date").isNotNull())
        .groupBy("order_date", "customer_key")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("order_total").alias("gmv"),
            F.sum("item_count").alias("items"),
            F.count_if(status == "delivered").alias("delivered"),
            F.count_if(status == "canceled").alias("canceled"),
            F.sum("delivery_time_days").alias("days"),
            F.count("delivery_time_days").alias("timed"),
            F.count_if(F.col("is_late_delivery")).alias("late"),
            F.sum("payment_value").alias("paid"),
            F.sum("freight_value").alias("freight"),
        )
    )
    totals = per_customer.groupBy("order_date").agg(
        F.sum("orders").alias("orders"),
        money_sum(F.col("gmv")).alias("gmv"),
        F.sum("items").alias("items"),
        F.count("customer_key").alias("customers"),
        F.sum("delivered").alias("delivered"),
        F.sum("canceled").alias("canceled"),
        F.try_divide(F.sum("days"), F.sum("timed")).alias("days"),
        F.sum("late").alias("late"),
        money_sum(F.col("paid")).alias("paid"),
        money_sum(F.col("freight")).alias("freight"),
    )
    orders = F.col("orders")
    return totals.select(
        F.col("order_date").alias("date"),
        orders.alias("total_orders"),
        half_up(F.col("gmv"), 2).alias("total_gmv"),
        F.col("items").alias("total_items"),
        half_up(F.col("gmv") / orders, 2).alias("avg_order_value"),
        F.col("customers").alias("unique_customers"),
        F.col("delivered").alias("orders_delivered"),
        F.col("canceled").alias("orders_canceled"),
        half_up(F.col("days"), 2).alias("avg_delivery_time_days"),
        ratio_pct(F.col("late"), orders, 2).alias("late_delivery_rate"),
        half_up(F.col("paid"), 2).alias("total_revenue"),
        half_up(F.col("freight"), 2).alias("total_freight"),
        half_up(F.try_divide("items", "orders"), 2).alias("avg_items_per_order"),
    )


def fill_days(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """A zero row for every calendar day without orders."""
    keep_null = {"date", "avg_delivery_time_days"}
    return (
        dates.select("date")
        .join(daily, "date", "left")
        .select(
            *[
                F.col(c) if c in keep_null else F.coalesce(F.col(c), F.lit(0).cast(t)).alias(c)
                for c, t in daily.dtypes
            ]
        )
    )


def first_scores(reviews: DataFrame) -> DataFrame:
    """One score per order: that of its first review by time, then id."""
    return reviews.groupBy("order_id").agg(
        F.min_by("review_score", F.struct("review_creation_date", "review_id")).alias("review_score")
    )


def _per_order(items: DataFrame, key: str) -> DataFrame:
    """Totals per (key, order): the distinct orders of a key, and small enough to join orders' facts to."""
    return (
        items.where(F.col(key).isNotNull())
        .groupBy(key, "order_id")
        .agg(
            F.count(F.lit(1)).alias("units"),
            F.sum("price").alias("revenue"),
            F.sum("freight_value").alias("freight"),
        )
    )


def fct_product_performance(items: DataFrame, reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue, orders and reviews per product of the dimension.

    Item rows are reduced to (product, order) once and give every measure. The
    dimension (and with it the surrogate key) meets one row per product, so a
    product with a large share of the items is no hot join key, and nothing is
    hashed per item.
    """
    sold = (
        _per_order(items, "product_id")
        .join(first_scores(reviews), "order_id", "left")
        .groupBy("product_id")
        .agg(
            F.sum("units").alias("units_sold"),
            money_sum(F.col("revenue")).alias("total_revenue"),
            money_sum(F.col("freight")).alias("total_freight"),
            F.count("order_id").alias("order_count"),
            F.count("review_score").alias("num_reviews"),
            F.avg("review_score").alias("score"),
        )
    )
    named = products.select(
        "product_id", "product_key", "product_category_name_english", "product_category_group"
    ).distinct()
    return sold.join(named, "product_id").select(
        "product_key",
        "product_category_name_english",
        "product_category_group",
        "units_sold",
        half_up(F.col("total_revenue"), 2).alias("total_revenue"),
        "total_freight",
        half_up(F.col("total_revenue") / F.col("units_sold"), 2).alias("avg_price"),
        "order_count",
        "num_reviews",
        half_up(F.coalesce("score", F.lit(0.0)), 2).alias("avg_review_score"),
        half_up(F.col("num_reviews") / F.col("units_sold") * F.lit(100), 2).alias("review_rate"),
    )


def fct_seller_performance(items: DataFrame, orders: DataFrame, reviews: DataFrame, sellers: DataFrame) -> DataFrame:
    """Orders, revenue, delivery and reviews per seller of the dimension, from one (seller, order) reduction."""
    facts = orders.select("order_id", "delivery_time_days", "is_late")
    measured = (
        _per_order(items, "seller_id")
        .join(facts, "order_id", "left")
        .join(first_scores(reviews), "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.count("order_id").alias("total_orders_fulfilled"),
            money_sum(F.col("revenue")).alias("total_revenue"),
            money_sum(F.col("freight")).alias("total_freight"),
            F.sum("units").alias("total_items_sold"),
            F.avg("delivery_time_days").alias("days"),
            F.count_if(F.col("is_late")).alias("late"),
            F.count("is_late").alias("deliveries"),
            F.avg("review_score").alias("score"),
            F.count("review_score").alias("num_reviews"),
        )
    )
    attributes = sellers.select(
        "seller_id", "seller_key", "seller_city", "seller_state", "seller_region", "seller_tier"
    ).distinct()
    return measured.join(attributes, "seller_id").select(
        "seller_key",
        "seller_city",
        "seller_state",
        "seller_region",
        "seller_tier",
        "total_orders_fulfilled",
        half_up(F.col("total_revenue"), 2).alias("total_revenue"),
        "total_freight",
        "total_items_sold",
        half_up(F.col("days"), 2).alias("avg_delivery_time_days"),
        F.coalesce(ratio_pct(F.col("late"), F.col("deliveries"), 2), F.lit(0.0)).alias("late_delivery_rate"),
        half_up(F.coalesce("score", F.lit(0.0)), 2).alias("avg_review_score"),
        "num_reviews",
    )


def monthly_revenue(fct: DataFrame, start: str, end: str) -> DataFrame:
    return (
        fct.where(F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .groupBy(F.trunc("order_date", "MM").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            money_sum(F.col("order_total")).alias("total_revenue"),
            money_avg(F.col("order_total")).alias("avg_order_value"),
            F.count_if(F.col("is_late_delivery")).alias("late_deliveries"),
        )
        .orderBy("month")
    )


def status_breakdown(fct: DataFrame, start: str, end: str, statuses: Sequence[str] | None = None) -> DataFrame:
    kept = fct.where(F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if statuses:
        kept = kept.where(F.col("order_status").isin(list(statuses)))
    return kept.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum(F.col("order_total")).alias("total_revenue"),
        F.avg("delivery_time_days").alias("avg_delivery_days"),
    )


def mv_monthly_revenue(fct: DataFrame) -> DataFrame:
    return fct.groupBy(F.trunc("order_date", "MM").alias("month"), "order_status").agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum(F.col("order_total")).alias("total_revenue"),
        money_avg(F.col("order_total")).alias("avg_order_value"),
        money_sum(F.col("freight_value")).alias("total_freight"),
    )


def mv_seller_performance(fct_items: DataFrame) -> DataFrame:
    return fct_items.groupBy("seller_key").agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum(F.col("price")).alias("total_revenue"),
        money_avg(F.col("price")).alias("avg_item_price"),
    )


def approx_distinct(df: DataFrame, column: str, keys: Sequence[str] = (), rsd: float = 0.02) -> DataFrame:
    return df.groupBy(*keys).agg(F.approx_count_distinct(column, rsd).alias("approx_distinct"))


SKETCH_BITS = 12  # 4096 registers: a standard error of 1.6 %
_RANK_BITS = 52


def distinct_registers(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """HyperLogLog registers of a column for each group: (keys, register, rank), the highest rank of each register.

    A value's SHA-256 gives its register (12 bits) and its rank, the place of the first one in the next 52 bits. Registers of any cut of the
    rows merge by their maximum, so they are stored per partition and need no raw row again. Nulls are not counted.
    """
    digest = F.sha2(F.col(column).cast("string"), 256)
    rest = F.conv(F.substr(digest, F.lit(4), F.lit(_RANK_BITS // 4)), 16, 10).cast("long")
    rank = F.when(rest == 0, F.lit(_RANK_BITS + 1)).otherwise(F.lit(_RANK_BITS + 1) - F.length(F.bin(rest)))
    return (
        df.where(F.col(column).isNotNull())
        .select(*keys, F.conv(F.substr(digest, F.lit(1), F.lit(SKETCH_BITS // 4)), 16, 10).cast("int").alias("register"), rank.cast("int").alias("rank"))
        .groupBy(*keys, "register")
        .agg(F.max("rank").alias("rank"))
    )


def stored_sketches(registers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group: its registers as a map, at most 4096 entries."""
    entries = F.map_from_entries(F.collect_list(F.struct("register", "rank")))
    return registers.groupBy(*keys).agg(entries.alias("sketch"))


def distinct_from_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Estimated distinct values of groups of stored sketches, merged by ``keys``.

    Small counts by the empty registers (linear counting), as usual for HyperLogLog.
    """
    m = float(2**SKETCH_BITS)
    merged = sketches.select(*keys, F.explode("sketch").alias("register", "rank")).groupBy(*keys, "register").agg(F.max("rank").alias("rank"))
    sums = merged.groupBy(*keys).agg(
        F.sum(F.pow(F.lit(2.0), -F.col("rank"))).alias("_z"), F.count(F.lit(1)).cast("double").alias("_used")
    )
    empty = F.lit(m) - F.col("_used")
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (F.col("_z") + empty)
    small = (raw <= F.lit(2.5 * m)) & (empty > 0)
    linear = F.lit(m) * F.log(F.lit(m) / F.greatest(empty, F.lit(1.0)))
    return sums.select(*keys, F.floor(F.when(small, linear).otherwise(raw) + F.lit(0.5)).cast("long").alias("estimate"))


def daily_from_windows(metrics: DataFrame) -> DataFrame:
    """Long window metrics as one row per day."""
    value = F.col("metric_value")

    def total(name: str):
        return F.sum(F.when(F.col("metric_name") == name, value).otherwise(0.0))

    def only(name: str):
        return F.when(F.col("metric_name") == name, value)

    return metrics.groupBy(F.to_date("window_start").alias("metric_date")).agg(
        total("total_orders").cast("long").alias("total_orders"),
        half_up(total("total_gmv"), 4).alias("total_gmv"),
        F.try_divide(half_up(F.sum(only("avg_order_value")), 4), F.count(only("avg_order_value"))).alias(
            "avg_order_value"
        ),
        total("unique_sessions").cast("long").alias("unique_customers"),
    )


def order_rates(items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Items per order, review rate and mean score, as one row."""
    per_order = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    items_per_order = per_order.agg(half_up(F.avg("n"), 2))
    order_count = orders.agg(F.count(F.lit(1)))
    return reviews.agg(F.count(F.lit(1)).alias("total_reviews"), F.avg("review_score").alias("score")).select(
        items_per_order.scalar().alias("items_per_order"),
        "total_reviews",
        half_up(F.col("total_reviews") / F.greatest(order_count.scalar(), F.lit(1)) * F.lit(100), 1).alias(
            "review_rate"
        ),
        half_up(F.col("score"), 2).alias("avg_review_score"),
    )


def order_total_profile(wide: DataFrame) -> DataFrame:
    total = F.col("order_total")
    return wide.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(total == 0).alias("zero_total"),
        F.count_if(total.isNull()).alias("null_total"),
        F.count_if(total > 0).alias("positive_total"),
        F.min(F.to_date("order_purchase_timestamp")).alias("min_date"),
        F.max(F.to_date("order_purchase_timestamp")).alias("max_date"),
    )


def zero_total_sources(wide: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with a zero total and what their items add up to."""
    zero = wide.where(F.col("order_total") == 0).select("order_id", "order_total")
    sums = (
        items.join(zero.select("order_id"), "order_id", "left_semi")
        .groupBy("order_id")
        .agg(money_sum(F.col("price") + F.col("freight_value")).alias("items_total"))
    )
    return zero.join(sums, "order_id", "left").select(
        "order_id", "order_total", F.coalesce("items_total", F.lit(0.0)).alias("items_total")
    )
