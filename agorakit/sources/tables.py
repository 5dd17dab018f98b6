"""Batch scans: raw tables, the translation side table, the click log, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from agorakit.functions import half_up
from agorakit.sources import schemas


def read_table(spark: SparkSession, name: str, base: str, fmt: str = "csv", fallback: str | None = None) -> DataFrame:
    """One of the raw tables below ``base``; ``fallback`` is tried when it is not there."""
    schema = schemas.struct(schemas.RAW[name])

    def scan(root: str) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}.{fmt}"
        if fmt == "csv":
            # Text columns that hold numbers or times are typed by staging, so bad
            # values become nulls there instead of failing the scan. Only reviews hold line breaks;
            # the other tables can be read by many tasks.
            return spark.read.schema(schema).csv(path, header=True, multiLine=name == "order_reviews", escape='"')
        return spark.read.format(fmt).load(path)

    if fallback is None:
        return scan(base)
    try:
        return scan(base)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return scan(fallback)


def table_metadata(df: DataFrame, name: str) -> DataFrame:
    """Row count, column count and column types of a table, as one row."""
    dtypes = ", ".join(f"{c}:{t}" for c, t in df.dtypes)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(dtypes).alias("dtypes"),
    )


def read_translation(spark: SparkSession, path: str) -> DataFrame:
    """Category translation; an empty table where the file is missing."""
    schema = schemas.struct(schemas.TRANSLATION)
    try:
        return spark.read.schema(schema).csv(path, header=True)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Experiment catalog document, one row per experiment."""
    doc = spark.read.schema(schemas.struct(schemas.EXPERIMENT_CATALOG)).json(path, multiLine=True)
    return doc.select(F.explode("experiments").alias("e")).select("e.*")


def flatten_clickstream(events: DataFrame) -> DataFrame:
    """Flat click rows; rows with no usable timestamp are dropped, missing text is blank."""
    text = ["event_id", "event_type", "session_id", "customer_id", "experiment_id", "variant"]
    nested = ["device", "referrer", "page_url", "order_id"]

    def blank(c):
        return F.coalesce(c.cast("string"), F.lit(""))

    return (
        events.select(
            *[blank(F.col(c)).alias(c) for c in text],
            F.try_to_timestamp("timestamp").alias("event_timestamp"),
            *[blank(F.col(f"properties.{c}")).alias(c) for c in nested],
            F.current_timestamp().alias("_loaded_at"),
        )
        .where(F.col("event_timestamp").isNotNull())
        .select(*text[:2], "event_timestamp", *text[2:], *nested, "_loaded_at")
    )


def load_clickstream(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON click log; blank and invalid lines are skipped."""
    schema = schemas.struct(schemas.TOPICS["clickstream"] + ", _corrupt string")
    raw = spark.read.schema(schema).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
    return flatten_clickstream(raw.where(F.col("_corrupt").isNull()))


def snapshot(table: DataFrame, order_col: str) -> DataFrame:
    """Rows of a stream sink table, newest first."""
    return table.orderBy(F.col(order_col).desc_nulls_last())


def load_orders(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Wide order rows of the reporting mart: total incl. freight, item count, customer state.

    Unlike staging, the total here includes freight.
    """
    totals = items.groupBy("order_id").agg(
        half_up(F.sum(F.col("price") + F.col("freight_value")), 4).alias("order_total"),
        F.count("order_item_id").alias("item_count"),
    )
    states = customers.select("customer_id", "customer_state")
    return (
        orders.where(F.col("order_purchase_timestamp").isNotNull())
        .join(totals, "order_id", "left")
        .join(states, "customer_id", "left")
        .select(
            "order_id",
            "customer_id",
            F.coalesce("order_status", F.lit("")).alias("order_status"),
            F.coalesce("customer_state", F.lit("")).alias("customer_state"),
            "order_purchase_timestamp",
            half_up(F.coalesce("order_total", F.lit(0.0)), 2).alias("order_total"),
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
        )
    )


def load_staging_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order columns of the staging table with the total incl. freight."""
    totals = items.groupBy("order_id").agg(
        half_up(F.sum(F.col("price") + F.col("freight_value")), 4).alias("order_total")
    )
    return orders.join(totals, "order_id", "left").select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        F.coalesce("order_total", F.lit(0.0)).alias("order_total"),
    )


def load_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    return products.join(translation, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def load_reviews(reviews: DataFrame) -> DataFrame:
    """One score per review id; of repeated ids the smallest (order, score) is kept."""
    return (
        reviews.groupBy("review_id")
        .agg(F.min(F.struct("order_id", "review_score")).alias("r"))
        .select("review_id", "r.order_id", "r.review_score")
    )
