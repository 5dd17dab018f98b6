"""Cleaning of the raw tables: same grain, typed and normalised columns.

Missing text stays null (it never becomes the word ``nan``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agorakit.functions import (
    as_number,
    as_timestamp,
    bucket,
    days_between_floor,
    fixed,
    lookup,
    money_sum,
    sentiment,
    status_category,
    text_key,
)
from agorakit.functions.grouping import exact_median


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """Median position and first city/state per zip.

    The medians are exact and safe for a zip holding a large share of the rows
    (see :func:`exact_median`).
    """
    key = "geolocation_zip_code_prefix"
    named = raw.where(F.col(key).isNotNull()).withColumn(key, F.trim(F.col(key).cast("string")))
    places = named.groupBy(key).agg(F.min(F.struct("geolocation_city", "geolocation_state")).alias("p"))
    for column in ("geolocation_lat", "geolocation_lng"):
        places = places.join(exact_median(named, [key], column, column), key, "left")
    return places.select(
        key,
        "geolocation_lat",
        "geolocation_lng",
        F.col("p.geolocation_city").alias("geolocation_city"),
        F.col("p.geolocation_state").alias("geolocation_state"),
    )


def stg_orders(orders: DataFrame, items: DataFrame, include_freight: bool = False) -> DataFrame:
    """Orders with parsed and consistent times, a closed status set, totals and classes.

    Approval is never before purchase and delivery never before approval (or
    purchase where there is no approval). The total is the sum of prices unless
    ``include_freight``.
    """
    times = {
        c: as_timestamp(orders, c)
        for c in (
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        )
    }
    known = fixed.STATUS_COMPLETED + fixed.STATUS_IN_PROGRESS + fixed.STATUS_CANCELED
    status = F.lower(F.trim("order_status"))
    typed = orders.where(F.col("order_id").isNotNull()).select(
        text_key("order_id").alias("order_id"),
        text_key("customer_id").alias("customer_id"),
        F.when(status.isin(known), status).otherwise("unknown").alias("order_status"),
        *[t.alias(c) for c, t in times.items()],
    )
    purchase, approved, delivered = (
        F.col("order_purchase_timestamp"),
        F.col("order_approved_at"),
        F.col("order_delivered_customer_date"),
    )
    typed = typed.withColumn(
        "order_approved_at", F.when(approved.isNotNull(), F.greatest(approved, purchase))
    ).withColumn(
        "order_delivered_customer_date",
        # greatest() skips nulls, so a missing approval falls back to the purchase
        F.when(delivered.isNotNull(), F.greatest(delivered, F.coalesce(approved, purchase))),
    )
    price = as_number(items, "price")
    amount = price + as_number(items, "freight_value") if include_freight else price
    totals = items.groupBy(text_key("order_id").alias("order_id")).agg(money_sum(amount).alias("order_total"))
    days = days_between_floor(delivered, purchase)
    return (
        typed.join(totals, "order_id", "left")
        .withColumn("order_total", F.coalesce("order_total", F.lit(0.0)))
        .select(
            *typed.columns,
            F.to_date(purchase).alias("order_date"),
            F.hour(purchase).alias("order_hour"),
            days.alias("delivery_time_days"),
            days.alias("order_lifetime_days"),
            F.coalesce(delivered > F.col("order_estimated_delivery_date"), F.lit(False)).alias("is_late"),
            status_category(F.col("order_status")).alias("order_status_category"),
            "order_total",
            bucket(F.col("order_total"), *fixed.ORDER_SIZE).alias("order_size_category"),
        )
    )


def _position(geo: DataFrame, prefix: str) -> DataFrame:
    return geo.select(
        F.col("geolocation_zip_code_prefix").alias(f"{prefix}_zip_code_prefix"),
        F.col("geolocation_lat").alias(f"{prefix}_lat"),
        F.col("geolocation_lng").alias(f"{prefix}_lng"),
    )


def stg_customers(customers: DataFrame, geo: DataFrame) -> DataFrame:
    state = F.upper(F.trim("customer_state"))
    return (
        customers.where(F.col("customer_id").isNotNull())
        .select(
            text_key("customer_id").alias("customer_id"),
            text_key("customer_unique_id").alias("customer_unique_id"),
            text_key("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
            F.trim("customer_city").alias("customer_city"),
            state.alias("customer_state"),
            lookup(state, fixed.STATE_NAMES, state).alias("customer_state_name"),
        )
        .join(_position(geo, "customer"), "customer_zip_code_prefix", "left")
    )


def stg_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with English category, volume and weight class; missing sizes count as 0."""
    sides = ["product_length_cm", "product_height_cm", "product_width_cm"]
    weight = F.col("product_weight_g")
    typed = products.where(F.col("product_id").isNotNull()).select(
        text_key("product_id").alias("product_id"),
        "product_category_name",
        *[as_number(products, c).alias(c) for c in [*sides, "product_weight_g"]],
    )
    return typed.join(translation, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        F.coalesce("product_category_name_english", "product_category_name").alias("product_category_name_english"),
        *sides,
        "product_weight_g",
        (F.col(sides[0]) * F.col(sides[1]) * F.col(sides[2])).alias("product_volume_cm3"),
        bucket(weight, *fixed.WEIGHT).alias("product_weight_category"),
    )


def stg_order_items(items: DataFrame) -> DataFrame:
    price, freight = as_number(items, "price"), as_number(items, "freight_value")
    return items.where(F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull()).select(
        text_key("order_id").alias("order_id"),
        "order_item_id",
        text_key("product_id").alias("product_id"),
        text_key("seller_id").alias("seller_id"),
        as_timestamp(items, "shipping_limit_date").alias("shipping_limit_date"),
        price.alias("price"),
        freight.alias("freight_value"),
        (price + freight).alias("item_total"),
    )


def stg_payments(payments: DataFrame) -> DataFrame:
    return payments.where(F.col("order_id").isNotNull()).select(
        text_key("order_id").alias("order_id"),
        "payment_sequential",
        F.lower(F.trim("payment_type")).alias("payment_type"),
        as_number(payments, "payment_installments", 1).cast("int").alias("payment_installments"),
        as_number(payments, "payment_value").alias("payment_value"),
    )


def stg_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Reviews with sentiment and days since delivery. A missing score becomes 0 (and is flagged by the checks)."""
    score = as_number(reviews, "review_score", 0).cast("int")
    created = as_timestamp(reviews, "review_creation_date")
    texts = [c for c in ("review_comment_title", "review_comment_message") if c in reviews.columns]
    delivery = orders.select("order_id", "order_delivered_customer_date").distinct()
    typed = reviews.where(F.col("review_id").isNotNull() & F.col("order_id").isNotNull()).select(
        text_key("review_id").alias("review_id"),
        text_key("order_id").alias("order_id"),
        score.alias("review_score"),
        *[F.trim(c).alias(c) for c in texts],
        created.alias("review_creation_date"),
        as_timestamp(reviews, "review_answer_timestamp").alias("review_answer_timestamp"),
        sentiment(score).alias("review_sentiment"),
    )
    return (
        typed.join(delivery, "order_id", "left")
        .withColumn(
            "days_since_delivery",
            days_between_floor(F.col("review_creation_date"), F.col("order_delivered_customer_date")),
        )
        .drop("order_delivered_customer_date")
    )


def stg_sellers(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    return (
        sellers.where(F.col("seller_id").isNotNull())
        .select(
            text_key("seller_id").alias("seller_id"),
            text_key("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
            F.trim("seller_city").alias("seller_city"),
            F.upper(F.trim("seller_state")).alias("seller_state"),
        )
        .join(_position(geo, "seller"), "seller_zip_code_prefix", "left")
    )
