"""Nested documents built from raw tables, and the warehouse sync of stream tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from agorakit.functions import as_number, as_timestamp, fixed, lookup, text_key
from agorakit.functions.grouping import first_per


def _null_if_blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def lookup_customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """First row per customer id, with the first position of its zip."""
    ordered = [c for c in customers.columns if c != "customer_id"]
    first = first_per(customers, ["customer_id"], ordered)
    position = first_per(
        geolocation.select("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
        ["geolocation_zip_code_prefix"],
        ["geolocation_lat", "geolocation_lng"],
    ).select(
        F.trim("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("latitude"),
        F.col("geolocation_lng").alias("longitude"),
    )
    return first.select(
        text_key("customer_id").alias("customer_id"),
        text_key("customer_unique_id").alias("customer_unique_id"),
        F.trim("customer_zip_code_prefix").alias("zip_code_prefix"),
        F.trim("customer_city").alias("city"),
        F.trim("customer_state").alias("state"),
    ).join(position, "zip_code_prefix", "left")


def lookup_sellers(sellers: DataFrame) -> DataFrame:
    first = first_per(sellers, ["seller_id"], [c for c in sellers.columns if c != "seller_id"])
    return first.select(
        text_key("seller_id").alias("seller_id"),
        F.trim("seller_zip_code_prefix").alias("zip_code_prefix"),
        F.trim("seller_city").alias("city"),
        F.trim("seller_state").alias("state"),
    )


def product_docs(products: DataFrame) -> DataFrame:
    """Nested product document; unknown categories keep their name with blanks for underscores."""
    category = F.trim("product_category_name")

    def whole(*names: str) -> Column:
        present = [n for n in names if n in products.columns]
        # a zero in the first spelling falls through to the second
        values = [as_number(products, n, None).cast("int") for n in present]
        if not values:
            return F.lit(None).cast("int")
        return F.coalesce(*[F.nullif(v, F.lit(0)) for v in values[:-1]], values[-1])

    return products.select(
        text_key("product_id").alias("product_id"),
        lookup(category, fixed.DOCUMENT_CATEGORY, F.replace(category, F.lit("_"), F.lit(" "))).alias("category"),
        F.struct(
            whole("product_weight_g").alias("weight_g"),
            F.struct(
                *[
                    as_number(products, f"product_{side}_cm", None).alias(f"{side}_cm")
                    for side in ("length", "height", "width")
                ]
            ).alias("dimensions"),
            whole("product_photos_qty").alias("photos_qty"),
            whole("product_name_lenght", "product_name_length").alias("name_length"),
            whole("product_description_lenght", "product_description_length").alias("description_length"),
        ).alias("attributes"),
        F.struct(
            F.current_timestamp().alias("created_at"), F.current_timestamp().alias("last_updated")
        ).alias("metadata"),
    )


def first_product(items: DataFrame) -> DataFrame:
    """First product of each order (lowest item number)."""
    return items.groupBy(text_key("order_id").alias("order_id")).agg(
        F.min(F.struct("order_item_id", text_key("product_id").alias("product_id")))["product_id"].alias("product_id")
    )


def review_docs(reviews: DataFrame, items: DataFrame) -> DataFrame:
    """Nested review document, one per review id; an order without items stands for its product."""
    first = first_per(reviews, ["review_id"], [c for c in reviews.columns if c != "review_id"])
    order_id = text_key("order_id")

    def iso(name: str) -> Column:
        return F.date_format(as_timestamp(reviews, name), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    return (
        first.select(
            text_key("review_id").alias("review_id"),
            order_id.alias("order_id"),
            as_number(reviews, "review_score", None).cast("int").alias("rating"),
            F.struct(
                _null_if_blank(F.col("review_comment_title")).alias("title"),
                _null_if_blank(F.col("review_comment_message")).alias("message"),
                F.lit("pt").alias("language"),
            ).alias("comment"),
            F.struct(
                iso("review_creation_date").alias("created_at"), iso("review_answer_timestamp").alias("answered_at")
            ).alias("timestamps"),
            F.struct(F.lit(0).alias("helpful_votes"), F.lit(True).alias("verified_purchase")).alias("metadata"),
        )
        .join(first_product(items), "order_id", "left")
        .withColumn("product_id", F.coalesce("product_id", "order_id"))
    )


def experiment_docs(catalog: DataFrame) -> DataFrame:
    """Nested experiment document; variant names such as ``treatment_35`` become structs.

    The first arm takes the first share of ``split``, the others the rest; a
    purely numeric suffix overrides the share. A name holding 50 or 35 carries
    its first numeric part as the threshold parameter.
    """
    parts = F.split(F.coalesce("split", F.lit("50/50")), "/")
    first_share = F.when(F.size(parts) < 2, F.lit(50)).otherwise(F.trim(parts[0]).try_cast("int"))

    def variant(name: Column, position: Column) -> Column:
        share = F.when(position == 0, first_share).otherwise(F.lit(100) - first_share)
        suffix = F.regexp_extract(name, "^[^_]*_([0-9]+)$", 1).try_cast("int")
        threshold = F.when(
            name.contains("50") | name.contains("35"), F.regexp_extract(name, "(?:^|_)([0-9]+)(?:_|$)", 1).try_cast("int")
        )
        arm = F.when(name.contains("_"), F.substring_index(name, "_", 1)).otherwise(F.lower(name))
        return F.struct(
            arm.alias("variant_id"),
            F.initcap(F.replace(name, F.lit("_"), F.lit(" "))).alias("name"),
            F.concat(F.lit("Variant "), arm).alias("description"),
            F.coalesce(suffix, share).alias("allocation_percent"),
            F.struct(threshold.alias("threshold")).alias("parameters"),
        )

    arms = F.when(
        F.coalesce(F.size("variants"), F.lit(0)) > 0, F.col("variants")
    ).otherwise(F.array(F.lit("control"), F.lit("treatment")))
    return catalog.select(
        F.col("id").alias("experiment_id"),
        F.coalesce("name", "id").alias("name"),
        F.concat(F.lit("Experiment "), F.coalesce("name", "id")).alias("description"),
        F.concat(F.lit("Test impact on "), F.coalesce("primary_metric", F.lit("metric"))).alias("hypothesis"),
        F.lit("active").alias("status"),
        F.struct(
            F.lit("2024-02-01").alias("start_date"),
            F.lit("2024-03-01").alias("end_date"),
            F.lit("2024-01-15").alias("created_at"),
        ).alias("dates"),
        F.transform(arms, variant).alias("variants"),
        F.struct(
            F.coalesce("primary_metric", F.lit("conversion_rate")).alias("primary"),
            F.array(F.lit("aov"), F.lit("items_per_order")).alias("secondary"),
            F.col("guardrail_metrics").alias("guardrail"),
        ).alias("metrics"),
        F.struct(
            F.coalesce("sample_per_variant", F.lit(2500)).alias("required_per_variant"),
            F.lit(0).alias("achieved_control"),
            F.lit(0).alias("achieved_treatment"),
        ).alias("sample_size"),
    )


def assignment_docs(assignments: DataFrame) -> DataFrame:
    """Assignment document with its composite id and audit hash."""
    composite = F.concat_ws("|", text_key("customer_id"), text_key("experiment_id"))
    return assignments.select(
        composite.alias("_id"),
        text_key("customer_id").alias("customer_id"),
        text_key("experiment_id").alias("experiment_id"),
        F.trim("variant").alias("variant"),
        F.coalesce("assigned_at", F.lit("2024-02-01T00:00:00Z")).alias("assigned_at")
        if "assigned_at" in assignments.columns
        else F.lit("2024-02-01T00:00:00Z").alias("assigned_at"),
        F.sha2(composite, 256).alias("assignment_hash"),
    )


def sync_orders(rt: DataFrame, customers: DataFrame) -> DataFrame:
    """Stream orders in warehouse shape; a blank state is taken from the customer lookup.

    ``customers`` is the output of :func:`lookup_customers`.
    """
    states = customers.select(text_key("customer_id").alias("customer_id"), F.trim("state").alias("_state"))
    joined = rt.withColumn("customer_id", text_key("customer_id")).join(states, "customer_id", "left")
    return joined.select(
        text_key("order_id").alias("event_id"),
        text_key("order_id").alias("order_id"),
        "customer_id",
        F.coalesce(
            _null_if_blank(F.col("customer_state")), _null_if_blank(F.col("_state")), F.lit("unknown")
        ).alias("customer_state"),
        as_timestamp(rt, "event_timestamp").alias("event_timestamp"),
        as_number(rt, "order_total").alias("order_total"),
        F.coalesce(_null_if_blank(F.col("event_type")), F.lit("order_placed")).alias("event_type"),
        as_timestamp(rt, "processed_at").alias("created_at"),
    ).where(F.col("event_timestamp").isNotNull())


def sync_metrics(rt: DataFrame) -> DataFrame:
    """Stream window metrics in warehouse shape."""
    return rt.select(
        as_timestamp(rt, "window_start").alias("window_start"),
        as_timestamp(rt, "window_end").alias("window_end"),
        F.col("metric_name").cast("string").alias("metric_name"),
        as_number(rt, "metric_value").alias("metric_value"),
        F.current_timestamp().alias("_ingested_at"),
    ).where(F.col("window_start").isNotNull() & F.col("metric_name").isNotNull())
