"""Business questions over the wide order rows, items, products, reviews and the daily mart.

``wide`` is the output of ``load_orders``; ``daily`` that of ``fct_daily_metrics``.
Windows without a partition run on rows per calendar day or week only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from agorakit.functions import bucket, fixed, half_up, money_avg, money_sum, month_gap, ratio_pct


def _day():
    return F.to_date("order_purchase_timestamp")


def kpi_totals(wide: DataFrame) -> DataFrame:
    total = F.col("order_total")
    return wide.agg(
        F.coalesce(money_sum(total), F.lit(0.0)).alias("total_gmv"),
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(money_avg(total), F.lit(0.0)).alias("aov"),
    )


def kpi_mtd(wide: DataFrame, min_orders: int = 100) -> DataFrame:
    """Latest month with enough orders against the month before it.

    Orders are reduced to months once; the latest month is a scalar subquery on
    that small frame.
    """
    months = wide.groupBy(F.trunc(_day(), "MM").alias("m")).agg(
        money_sum(F.col("order_total")).alias("gmv"), F.count(F.lit(1)).alias("orders")
    )
    latest = months.where(F.col("orders") > min_orders).agg(F.max("m")).scalar()
    current, before = F.col("m") >= latest, F.col("m") == F.add_months(latest, -1)
    picked = months.agg(
        F.coalesce(half_up(F.sum(F.when(current, F.col("gmv"))), 4), F.lit(0.0)).alias("gmv_mtd"),
        F.coalesce(F.sum(F.when(current, F.col("orders"))), F.lit(0)).alias("orders_mtd"),
        F.coalesce(half_up(F.sum(F.when(before, F.col("gmv"))), 4), F.lit(0.0)).alias("prev_gmv"),
    )
    change = F.try_divide(F.col("gmv_mtd") - F.col("prev_gmv"), F.col("prev_gmv")) * F.lit(100)
    return picked.withColumn("gmv_growth_pct", F.coalesce(half_up(change, 1), F.lit(0.0)))


def kpi_delivery(daily: DataFrame, min_orders: int = 10) -> DataFrame:
    busy = daily.where(F.col("avg_delivery_time_days").isNotNull() & (F.col("total_orders") > min_orders))
    return busy.agg(
        half_up(money_avg(F.col("avg_delivery_time_days")), 1).alias("avg_delivery_days"),
        half_up(F.lit(100.0) - money_avg(F.col("late_delivery_rate")), 1).alias("on_time_delivery_pct"),
    )


def sparkline(daily: DataFrame, n: int = 14, min_orders: int = 10) -> DataFrame:
    """The last ``n`` busy days, oldest first."""
    return (
        daily.where((F.col("total_orders") > min_orders) & (F.col("total_gmv") > 0))
        .orderBy(F.col("date").desc())
        .limit(n)
        .select(
            F.col("date").alias("d"),
            F.col("total_gmv").alias("gmv"),
            F.col("total_orders").alias("orders"),
            F.col("avg_order_value").alias("aov"),
        )
        .orderBy("d")
    )


def repeat_rate(wide: DataFrame, customers: DataFrame) -> DataFrame:
    """Share of people with more than one order. Orders are counted per customer id before the join."""
    per_id = wide.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    per_person = (
        per_id.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.sum("n").alias("cnt"))
    )
    return per_person.agg(ratio_pct(F.count_if(F.col("cnt") > 1), F.count(F.lit(1)), 1).alias("repeat_rate"))


def daily_trends(wide: DataFrame, days: int = 90) -> DataFrame:
    """The last ``days`` days with a 7-row moving average of GMV and status counts.

    The cut comes before the moving average, so the first rows average fewer days.
    """
    status = F.col("order_status")
    daily = (
        wide.groupBy(_day().alias("date"))
        .agg(
            F.coalesce(money_sum(F.col("order_total")), F.lit(0.0)).alias("gmv"),
            F.count(F.lit(1)).alias("orders"),
            F.coalesce(money_avg(F.col("order_total")), F.lit(0.0)).alias("aov"),
            F.count_if(status == "delivered").alias("delivered"),
            F.count_if(status == "shipped").alias("shipped"),
            F.count_if(status == "canceled").alias("canceled"),
            F.count_if(~status.isin("delivered", "shipped", "canceled")).alias("processing"),
        )
        .orderBy(F.col("date").desc())
        .limit(days)
    )
    week = Window.orderBy("date").rowsBetween(-6, 0)
    average = half_up(F.sum("gmv").over(week), 4) / F.count("gmv").over(week)
    return daily.select(
        "date", "gmv", average.alias("gmv_ma7"), "orders", "aov", "delivered", "shipped", "processing", "canceled"
    ).orderBy("date")


def by_state(wide: DataFrame) -> DataFrame:
    return (
        wide.where(F.col("customer_state").isNotNull())
        .groupBy(F.col("customer_state").alias("state"))
        .agg(
            F.coalesce(money_sum(F.col("order_total")), F.lit(0.0)).alias("gmv"),
            F.count(F.lit(1)).alias("orders"),
            half_up(money_avg(F.col("order_total")), 2).alias("aov"),
        )
        .orderBy(F.col("gmv").desc(), "state")
    )


def _category(fallback: str | None = None):
    parts = [F.col("product_category_name_english"), F.col("product_category_name")]
    return F.coalesce(*parts, *([F.lit(fallback)] if fallback else []))


def _named(products: DataFrame, fallback: str | None = None) -> DataFrame:
    return products.where(F.col("product_category_name").isNotNull()).select(
        "product_id", _category(fallback).alias("category")
    )


def top_products(items: DataFrame, products: DataFrame, reviews: DataFrame, n: int = 15) -> DataFrame:
    """Top categories by revenue with mean price, mean score, rank and share of the rows returned.

    An item counts once per review of its order (a left join to reviews). The
    repetition is carried as a weight: items shrink to (order, product), reviews
    to one row per order, and hot products are summed before any name is joined.
    """
    lines = items.groupBy("order_id", "product_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("price").alias("price"), F.count("price").alias("priced")
    )
    scores = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_count"),
    )
    times = F.coalesce("reviews", F.lit(1))
    per_product = (
        lines.join(scores, "order_id", "left")
        .groupBy("product_id")
        .agg(
            F.sum(F.col("lines") * times).alias("units"),
            F.sum(F.col("price") * times).alias("revenue"),
            F.sum(F.col("priced") * times).alias("priced"),
            F.sum(F.col("lines") * F.col("score_sum")).alias("score_sum"),
            F.sum(F.col("lines") * F.col("score_count")).alias("score_count"),
        )
    )
    top = (
        per_product.join(_named(products, "other"), "product_id")
        .groupBy("category")
        .agg(
            F.sum("units").alias("units_sold"),
            F.coalesce(money_sum(F.col("revenue")), F.lit(0.0)).alias("revenue"),
            F.sum("priced").alias("priced"),
            F.try_divide(F.sum("score_sum"), F.sum("score_count")).alias("score"),
        )
        .orderBy(F.col("revenue").desc(), "category")
        .limit(n)
    )
    rows = Window.orderBy(F.col("revenue").desc(), "category")
    total = half_up(F.sum("revenue").over(Window.partitionBy()), 4)
    return top.select(
        "category",
        "units_sold",
        "revenue",
        half_up(F.try_divide("revenue", "priced"), 2).alias("avg_price"),
        F.coalesce(half_up(F.col("score"), 1), F.lit(0.0)).alias("review_score"),
        F.row_number().over(rows).alias("rank"),
        half_up(F.col("revenue") / F.greatest(total, F.lit(1.0)) * F.lit(100), 1).alias("share_pct"),
    )


def _product_revenue(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.sum("price").alias("revenue"), F.count(F.lit(1)).alias("items_sold"), F.count("price").alias("priced")
    )


def revenue_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _product_revenue(items)
        .join(_named(products), "product_id")
        .groupBy("category")
        .agg(F.coalesce(money_sum(F.col("revenue")), F.lit(0.0)).alias("revenue"))
        .orderBy(F.col("revenue").desc(), "category")
    )


def top_dimension_categories(fct_items: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    """Best-selling categories through the product key of the item fact."""
    sold = fct_items.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("items"), F.sum("price").alias("revenue"), F.count("price").alias("priced")
    )
    return (
        sold.join(products.select("product_key", "product_category_name"), "product_key")
        .groupBy("product_category_name")
        .agg(
            F.sum("items").alias("items_sold"),
            money_sum(F.col("revenue")).alias("total_revenue"),
            F.sum("priced").alias("priced"),
        )
        .select(
            "product_category_name",
            "items_sold",
            "total_revenue",
            F.try_divide("total_revenue", "priced").alias("avg_price"),
        )
        .orderBy(F.col("total_revenue").desc(), "product_category_name")
        .limit(n)
    )


def wow(wide: DataFrame, min_days: int = 6) -> DataFrame:
    """The latest two weeks (from Monday) with at least ``min_days`` active days, by weekday.

    Empty when there are no two such weeks.
    """
    daily = wide.groupBy(_day().alias("d")).agg(money_sum(F.col("order_total")).alias("gmv"))
    ranked = (
        daily.where(F.col("d").isNotNull())
        .withColumn("wk", F.to_date(F.date_trunc("week", "d")))
        .withColumn("active", F.count(F.lit(1)).over(Window.partitionBy("wk")))
        .where(F.col("active") >= min_days)
        .withColumn("age", F.dense_rank().over(Window.orderBy(F.col("wk").desc())))
        .where(F.col("age") <= 2)
        .withColumn("weeks", F.max("age").over(Window.partitionBy()))
        .where(F.col("weeks") == 2)
    )

    def week(age: int):
        return half_up(F.sum(F.when(F.col("age") == age, F.col("gmv")).otherwise(0.0)), 4)

    sums = ranked.groupBy(F.dayofweek("d").alias("dow")).agg(week(1).alias("this_week"), week(2).alias("last_week"))
    change = F.try_divide(F.col("this_week") - F.col("last_week"), F.col("last_week")) * F.lit(100)
    return sums.select(
        F.date_format(F.make_date(F.lit(2023), F.lit(1), F.col("dow")), "EEE").alias("day"),
        "dow",
        "this_week",
        "last_week",
        F.coalesce(half_up(change, 1), F.lit(0.0)).alias("delta_pct"),
    ).orderBy("dow")


def category_trends(items: DataFrame, orders: DataFrame, products: DataFrame, top: int = 6) -> DataFrame:
    """Weekly revenue (weeks from Sunday) of the best-selling categories, one row per week and category."""
    named = _named(products)
    best = (
        _product_revenue(items)
        .join(named, "product_id")
        .groupBy("category")
        .agg(money_sum(F.col("revenue")).alias("revenue"))
        .orderBy(F.col("revenue").desc(), "category")
        .limit(top)
        .select("category")
    )
    sunday = F.date_sub(_day(), F.dayofweek(_day()) - 1)
    weeks = orders.select("order_id", sunday.alias("week"))
    return (
        items.groupBy("order_id", "product_id")
        .agg(F.sum("price").alias("revenue"))
        .join(weeks, "order_id")
        .groupBy("week", "product_id")
        .agg(F.sum("revenue").alias("revenue"))
        .join(named.join(best, "category", "left_semi"), "product_id")
        .groupBy("week", "category")
        .agg(money_sum(F.col("revenue")).alias("revenue"))
    )


def category_trends_wide(trends: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One column per category, zero where a week has none; categories of ``trends`` not among those given follow by name."""
    names = list(categories)
    others = trends.where(F.col("category").isNotNull() & ~F.col("category").isin(names)).select("category").distinct()
    names += sorted(r.category for r in others.collect())
    return (
        trends.groupBy("week")
        .pivot("category", names)
        .agg(F.first("revenue"))
        .fillna(0.0, subset=[f"`{c}`" for c in names])
        .orderBy("week")
    )


def cohort_retention(wide: DataFrame, customers: DataFrame, min_size: int = 50, last: int = 8) -> DataFrame:
    """Share of each first-order month that ordered again n months later, n = 0..12.

    Orders are reduced to (person, month) before anything is compared, so the
    rows of one person are bounded by the months covered.
    """
    per_id = wide.groupBy("customer_id", F.trunc(_day(), "MM").alias("month")).agg(F.lit(1).alias("one"))
    active = (
        per_id.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .select("customer_unique_id", "month")
        .distinct()
    )
    first = F.min("month").over(Window.partitionBy("customer_unique_id"))
    aged = active.withColumn("first", first).select(
        F.date_format("first", "yyyy-MM").alias("cohort"), month_gap(F.col("month"), F.col("first")).alias("age")
    )
    users = (
        aged.where(F.col("age").between(0, 12)).groupBy("cohort").pivot("age", list(range(13))).agg(F.count(F.lit(1)))
    )
    size = F.col("cohort_size")
    return (
        users.withColumn("cohort_size", F.col("0"))
        .where(size >= min_size)
        .orderBy(F.col("cohort").desc())
        .limit(last)
        .select("cohort", "cohort_size", *[ratio_pct(F.col(str(i)), size, 1).alias(f"month_{i}") for i in range(13)])
        .orderBy("cohort")
    )


def aov_distribution(wide: DataFrame) -> DataFrame:
    """Orders per fixed amount bucket and their share; empty buckets are kept."""
    spark = wide.sparkSession
    names = spark.range(1).select(F.posexplode(F.array(*[F.lit(b) for b in fixed.AOV_LABELS])).alias("pos", "bucket"))
    label = F.coalesce(
        bucket(F.col("order_total"), fixed.AOV_EDGES, fixed.AOV_LABELS, closed="left"), F.lit(fixed.AOV_LABELS[-1])
    )
    counts = wide.groupBy(label.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    filled = names.join(counts, "bucket", "left").withColumn("count", F.coalesce("n", F.lit(0)))
    total = F.sum("count").over(Window.partitionBy())
    return filled.select(
        "pos", "bucket", "count", half_up(F.col("count") / F.greatest(total, F.lit(1)) * F.lit(100), 1).alias("pct")
    ).orderBy("pos")


def heatmap(wide: DataFrame) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    return (
        wide.groupBy(F.dayofweek(ts).alias("dow"), F.hour(ts).alias("hour"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .select(
            F.date_format(F.make_date(F.lit(2023), F.lit(1), F.col("dow")), "EEE").alias("day"), "dow", "hour", "orders"
        )
        .orderBy("dow", "hour")
    )


def rating_distribution(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("reviews")).orderBy("review_score")


def search_reviews(reviews: DataFrame, terms: Sequence[str], column: str = "review_comment_message") -> DataFrame:
    """Reviews whose text holds any of the terms as a word, whatever the case."""
    words = F.split(F.lower(column), r"[^\p{L}\p{N}]+")
    return reviews.where(F.arrays_overlap(words, F.array(*[F.lit(t.lower()) for t in terms])))
