"""Facts: one row per order, order item and review. All days at once unless one is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agorakit.functions import days_between_floor, fixed, half_up, money_sum, sentiment, surrogate_key

FCT_ORDERS_COLUMNS = [
    "fact_key",
    "order_id",
    "customer_key",
    "seller_key",
    "geography_key",
    "date_key",
    "order_date",
    "order_status",
    "order_total",
    "item_count",
    "payment_value",
    "freight_value",
    "profit_estimate",
    "avg_item_price",
    "delivery_time_days",
    "is_late_delivery",
    "payment_type",
    "payment_installments",
]


def order_item_totals(items: DataFrame) -> DataFrame:
    """Item totals and first seller per order, in one aggregate."""
    return items.groupBy("order_id").agg(
        money_sum(F.col("price")).alias("items_price"),
        money_sum(F.col("freight_value")).alias("items_freight"),
        F.count("order_item_id").alias("items_count"),
        # min() over a struct: first seller by item number, combined before the shuffle
        F.min(F.when(F.col("seller_id").isNotNull(), F.struct("order_item_id", "product_id", "seller_id")))[
            "seller_id"
        ].alias("seller_id"),
    )


def order_payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        money_sum(F.col("payment_value")).alias("paid"),
        F.min(F.struct("payment_sequential", "payment_type", "payment_installments")).alias("first_payment"),
    )


def fct_orders(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    dates: DataFrame,
    geography: DataFrame,
    day: str | None = None,
) -> DataFrame:
    """Order fact from the staging tables and dimensions.

    With ``day`` the orders are filtered first and the item and payment tables
    cut to those orders before they are aggregated.
    """
    if day is not None:
        orders = orders.where(F.col("order_date") == F.lit(day).cast("date"))
        wanted = orders.select("order_id")
        items = items.join(wanted, "order_id", "left_semi")
        payments = payments.join(wanted, "order_id", "left_semi")
    base = (
        orders.drop("order_total")
        .join(order_item_totals(items), "order_id", "left")
        .join(order_payment_totals(payments), "order_id", "left")
    )
    zips = geography.select(
        F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"), "geography_key"
    )
    located = customers.select("customer_id", "customer_key", "customer_zip_code_prefix").join(
        zips, "customer_zip_code_prefix", "left"
    )
    keyed = (
        base.join(located.drop("customer_zip_code_prefix"), "customer_id", "left")
        .join(sellers.select("seller_id", "seller_key"), "seller_id", "left")
        .join(dates.select(F.col("date").alias("order_date"), "date_key"), "order_date", "left")
    )
    freight = F.coalesce("items_freight", F.lit(0.0))
    count = F.coalesce("items_count", F.lit(0))
    total = half_up(F.coalesce(F.col("items_price") + freight, F.lit(0.0)), 4)
    delivered = F.col("order_delivered_customer_date")
    return keyed.select(
        surrogate_key("fct_", F.col("order_id")).alias("fact_key"),
        "order_id",
        "customer_key",
        "seller_key",
        "geography_key",
        "date_key",
        "order_date",
        F.lower(F.trim("order_status")).alias("order_status"),
        total.alias("order_total"),
        count.alias("item_count"),
        F.coalesce("paid", F.lit(0.0)).alias("payment_value"),
        freight.alias("freight_value"),
        half_up(total * F.lit(fixed.PROFIT_RATE), 2).alias("profit_estimate"),
        (total / F.greatest(count, F.lit(1))).alias("avg_item_price"),
        days_between_floor(delivered, F.col("order_purchase_timestamp")).alias("delivery_time_days"),
        F.coalesce(delivered > F.col("order_estimated_delivery_date"), F.lit(False)).alias("is_late_delivery"),
        F.lower(F.trim(F.coalesce("first_payment.payment_type", F.lit("")))).alias("payment_type"),
        F.coalesce("first_payment.payment_installments", F.lit(1)).alias("payment_installments"),
    )


def fct_order_items(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    return (
        items.join(products.select("product_id", "product_key").distinct(), "product_id", "left")
        .join(sellers.select("seller_id", "seller_key").distinct(), "seller_id", "left")
        .select(
            surrogate_key("fi_", F.col("order_id"), F.col("order_item_id")).alias("order_item_fact_key"),
            "order_id",
            surrogate_key("fct_", F.col("order_id")).alias("fact_key"),
            "order_item_id",
            "product_key",
            "seller_key",
            F.lit(1).alias("quantity"),
            F.coalesce("price", F.lit(0.0)).alias("price"),
            F.coalesce("freight_value", F.lit(0.0)).alias("freight_value"),
            (F.coalesce("price", F.lit(0.0)) + F.coalesce("freight_value", F.lit(0.0))).alias("item_total"),
        )
    )


def fct_reviews(reviews: DataFrame, day: str | None = None) -> DataFrame:
    if day is not None:
        reviews = reviews.where(F.to_date("review_creation_date") == F.lit(day).cast("date"))
    text = F.trim("review_comment_message")
    seconds = (F.unix_micros("review_answer_timestamp") - F.unix_micros("review_creation_date")) / F.lit(1_000_000.0)
    return reviews.select(
        surrogate_key("fr_", F.col("review_id")).alias("review_fact_key"),
        "review_id",
        "order_id",
        surrogate_key("fct_", F.col("order_id")).alias("fact_key"),
        "review_score",
        F.coalesce(F.length("review_comment_message"), F.lit(0)).alias("review_comment_length"),
        F.coalesce(half_up(seconds / F.lit(3600.0), 2), F.lit(0.0)).alias("response_time_hours"),
        sentiment(F.col("review_score")).alias("sentiment"),
        F.coalesce(text != "", F.lit(False)).alias("has_comment"),
        "review_creation_date",
    )


def fact_profile(fct: DataFrame) -> DataFrame:
    """Row count, missing keys and non-positive totals of delivered orders, in one pass."""
    return fct.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("customer_key").isNull()).alias("null_customer_key"),
        F.count_if(F.col("date_key").isNull()).alias("null_date_key"),
        F.count_if((F.col("order_status") == "delivered") & (F.col("order_total") <= 0)).alias(
            "negative_order_total_delivered"
        ),
    )


def review_profile(fct: DataFrame) -> DataFrame:
    return fct.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~F.col("review_score").between(1, 5)).alias("invalid_review_scores"),
        F.count_if(~F.col("sentiment").isin("positive", "neutral", "negative")).alias("invalid_sentiments"),
    )
