"""Dimensions: one row per entity, hashed surrogate keys, overwritten on refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from agorakit.functions import bucket, fixed, half_up, lookup, money_sum, surrogate_key


def dim_dates(
    spark: SparkSession, start: str = "2016-09-01", end: str = "2018-08-31", holidays: Sequence[str] = fixed.HOLIDAYS
) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return dim_dates_between(bounds, holidays)


def dim_dates_between(bounds: DataFrame, holidays: Sequence[str] = fixed.HOLIDAYS) -> DataFrame:
    """Calendar from a one-row (start, end) frame, such as the min and max of a fact's dates."""
    day = F.col("date")
    weekday = F.weekday(day) + 1
    return bounds.select(F.explode(F.sequence("start", "end")).alias("date")).select(
        "date",
        surrogate_key("dt_", day).alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
        day.isin([F.lit(h).cast("date") for h in holidays]).alias("is_holiday"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
    )


def dim_geography(geo: DataFrame) -> DataFrame:
    return geo.select(
        "*",
        surrogate_key("geo_", F.col("geolocation_zip_code_prefix")).alias("geography_key"),
        lookup(F.upper("geolocation_state"), fixed.STATE_REGION, "Other").alias("region"),
    )


def dim_products(products: DataFrame, closed: str = "right") -> DataFrame:
    """``closed='left'`` gives the warehouse form of the size classes."""
    volume = F.coalesce("product_volume_cm3", F.lit(0.0))
    return products.select(
        "*",
        surrogate_key("prd_", F.col("product_id")).alias("product_key"),
        bucket(volume, *fixed.VOLUME, closed=closed).alias("product_size_category"),
        lookup(F.col("product_category_name_english"), fixed.CATEGORY_GROUP, "other").alias("product_category_group"),
    )


def dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with their delivered orders: count, spend, mean, first and last date, tier and value class."""
    bought = (
        orders.where(F.col("order_status") == "delivered")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            money_sum(F.col("order_total")).alias("total_spent"),
            F.min("order_purchase_timestamp").alias("first_order_date"),
            F.max("order_purchase_timestamp").alias("last_order_date"),
        )
    )
    count = F.coalesce("total_orders", F.lit(0))
    spent = F.coalesce("total_spent", F.lit(0.0))
    return customers.join(bought, "customer_id", "left").select(
        *customers.columns,
        count.alias("total_orders"),
        spent.alias("total_spent"),
        F.coalesce(F.try_divide("total_spent", "total_orders"), F.lit(0.0)).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        F.when(count > 10, "vip").when(count >= 2, "regular").otherwise("new").alias("customer_tier"),
        F.when(spent > 1000, "high").when(spent >= 100, "medium").otherwise("low").alias("customer_value"),
        surrogate_key("cust_", F.col("customer_id")).alias("customer_key"),
        lookup(F.upper("customer_state"), fixed.STATE_REGION, "Other").alias("customer_region"),
    )


def _tier(score):
    return F.when(score >= 4.5, "top").when(score >= 4, "good").when(score >= 3, "average").otherwise("poor")


def dim_sellers(sellers: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Sellers with distinct orders, mean review and mean delivery days.

    The item table is reduced to distinct (seller, order) pairs once; both means
    and the order count come from the pairs.
    """
    pairs = items.select("seller_id", "order_id").distinct()
    delivery = orders.where(F.col("delivery_time_days").isNotNull()).select("order_id", "delivery_time_days")
    # an order counts once per distinct score it was given
    scores = (
        reviews.select("order_id", "review_score")
        .distinct()
        .groupBy("order_id")
        .agg(F.sum("review_score").alias("score_sum"), F.count("review_score").alias("score_count"))
    )
    measured = (
        pairs.join(delivery, "order_id", "left")
        .join(scores, "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders_fulfilled"),
            F.try_divide(F.sum("score_sum"), F.sum("score_count")).alias("avg_review_score"),
            F.avg("delivery_time_days").alias("avg_delivery_time_days"),
        )
    )
    score = F.coalesce("avg_review_score", F.lit(0.0))
    return sellers.join(measured, "seller_id", "left").select(
        *sellers.columns,
        F.coalesce("total_orders_fulfilled", F.lit(0)).alias("total_orders_fulfilled"),
        score.alias("avg_review_score"),
        F.coalesce("avg_delivery_time_days", F.lit(0.0)).alias("avg_delivery_time_days"),
        _tier(score).alias("seller_tier"),
        surrogate_key("sell_", F.col("seller_id")).alias("seller_key"),
        lookup(F.upper("seller_state"), fixed.STATE_REGION, "Other").alias("seller_region"),
    )


def dim_sellers_by_item(items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Warehouse form: only sellers that sold, means weighted by items, calendar days.

    Items are counted per (seller, order) before any join, so the joins carry
    weights instead of item rows.
    """
    weights = items.groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("w"), money_sum(F.col("price")).alias("revenue")
    )
    scores = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"), F.count("review_score").alias("score_count")
    )
    days = orders.where(F.col("order_delivered_customer_date").isNotNull()).select(
        "order_id",
        F.datediff(F.to_date("order_delivered_customer_date"), F.to_date("order_purchase_timestamp")).alias("days"),
    )
    w = F.col("w")
    measured = (
        weights.join(scores, "order_id", "left")
        .join(days, "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders_fulfilled"),
            money_sum(F.col("revenue")).alias("total_revenue"),
            F.try_divide(F.sum(w * F.col("score_sum")), F.sum(w * F.col("score_count"))).alias("score"),
            F.try_divide(
                F.sum(w * F.col("days")), F.sum(F.when(F.col("days").isNotNull(), w))
            ).alias("days"),
        )
    )
    score = F.coalesce(half_up(F.col("score"), 2), F.lit(0.0))
    return measured.select(
        surrogate_key("sell_", F.col("seller_id")).alias("seller_key"),
        "seller_id",
        "total_orders_fulfilled",
        "total_revenue",
        score.alias("avg_review_score"),
        F.coalesce(half_up(F.col("days"), 1), F.lit(0.0)).alias("avg_delivery_time_days"),
        _tier(score).alias("seller_tier"),
    )
