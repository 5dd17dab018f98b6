"""All tables of the model over one folder of given tables, built on first use."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from agorakit.functions import fixed
from agorakit.operators import assignment, dims, experiments, facts, marts, staging
from agorakit.session import materialize
from agorakit.sources import adapters, tables
from agorakit.streaming import messages, operators as streams


class Model:
    """Lazy frames from raw to marts; nothing runs until a query's result is read."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def _raw(self, make, *args) -> DataFrame:
        return make(self.spark, self.sf_dir, *args)

    # raw
    @cached_property
    def raw_orders(self) -> DataFrame:
        return self._raw(adapters.raw_orders)

    @cached_property
    def raw_items(self) -> DataFrame:
        return self._raw(adapters.raw_items)

    @cached_property
    def raw_payments(self) -> DataFrame:
        return self._raw(adapters.raw_payments)

    @cached_property
    def raw_reviews(self) -> DataFrame:
        return self._raw(adapters.raw_reviews)

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self._raw(adapters.raw_customers)

    @cached_property
    def raw_sellers(self) -> DataFrame:
        return self._raw(adapters.raw_sellers)

    @cached_property
    def raw_products(self) -> DataFrame:
        return self._raw(adapters.raw_products)

    @cached_property
    def translation(self) -> DataFrame:
        return self._raw(adapters.raw_translation)

    @cached_property
    def raw_geolocation(self) -> DataFrame:
        return self._raw(adapters.raw_geolocation)

    @cached_property
    def events(self) -> DataFrame:
        return adapters.table(self.spark, self.sf_dir, "events")

    # staging
    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.stg_geolocation(self.raw_geolocation)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw_orders, self.raw_items)

    @cached_property
    def stg_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw_items)

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw_payments)

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return staging.stg_reviews(self.raw_reviews, self.stg_orders)

    @cached_property
    def scores(self) -> DataFrame:
        """Reviews without their texts."""
        return staging.stg_reviews(self.scores_only, self.stg_orders)

    @cached_property
    def scores_only(self) -> DataFrame:
        """Reviews without texts and without the days since delivery, which need the orders."""
        return self._raw(adapters.raw_reviews, False)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw_customers, self.stg_geolocation)

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw_sellers, self.stg_geolocation)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw_products, self.translation)

    # dimensions
    @cached_property
    def dim_dates(self) -> DataFrame:
        orders = adapters.table(self.spark, self.sf_dir, "orders")
        day = F.to_date("o_orderdate")
        return dims.dim_dates_between(orders.agg(F.min(day).alias("start"), F.max(day).alias("end")))

    @cached_property
    def dim_geography(self) -> DataFrame:
        return dims.dim_geography(self.stg_geolocation)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dims.dim_products(self.stg_products)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dims.dim_customers(self.stg_customers, self.stg_orders)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return dims.dim_sellers(self.stg_sellers, self.stg_items, self.stg_orders, self.scores_only)

    # facts and marts
    @cached_property
    def fct_orders(self) -> DataFrame:
        return facts.fct_orders(
            self.stg_orders,
            self.stg_items,
            self.stg_payments,
            self.customer_keys,
            self.seller_keys,
            self.dim_dates,
            self.geography_keys,
        )

    @cached_property
    def geography_keys(self) -> DataFrame:
        """Zips with their keys; the key needs no positions."""
        zips = self.raw_geolocation.select(F.trim("geolocation_zip_code_prefix").alias("geolocation_zip_code_prefix"))
        return zips.distinct().select(
            "*", dims.surrogate_key("geo_", F.col("geolocation_zip_code_prefix")).alias("geography_key")
        )

    @cached_property
    def customer_keys(self) -> DataFrame:
        """The part of the customer dimension facts look up; it needs no orders."""
        return self.raw_customers.select(
            F.trim("customer_id").alias("customer_id"),
            dims.surrogate_key("cust_", F.col("customer_id")).alias("customer_key"),
            F.trim("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        )

    @cached_property
    def seller_keys(self) -> DataFrame:
        return self.raw_sellers.select(
            F.trim("seller_id").alias("seller_id"), dims.surrogate_key("sell_", F.col("seller_id")).alias("seller_key")
        )

    @cached_property
    def fct_items(self) -> DataFrame:
        products = self.raw_products.select(
            F.trim("product_id").alias("product_id"), dims.surrogate_key("prd_", F.col("product_id")).alias("product_key")
        )
        return facts.fct_order_items(self.stg_items, products, self.seller_keys)

    @cached_property
    def daily(self) -> DataFrame:
        return marts.fct_daily_metrics(self.fct_orders)

    @cached_property
    def daily_table(self) -> DataFrame:
        """The daily mart as a written table, for questions that read it more than once."""
        return materialize(self.daily, "daily")

    @cached_property
    def wide(self) -> DataFrame:
        """Wide order rows of the reporting mart."""
        return tables.load_orders(self._raw(adapters.raw_orders, False), self.raw_items, self.raw_customers)

    # streams
    @cached_property
    def clicks(self) -> DataFrame:
        return adapters.clicks_of(self.events)

    @cached_property
    def rt(self) -> DataFrame:
        return self._raw(adapters.realtime_orders)

    @cached_property
    def stream(self) -> DataFrame:
        return adapters.stream_messages(self.events)

    @cached_property
    def metrics(self) -> DataFrame:
        return streams.window_metrics(self.stream)

    @cached_property
    def counters(self) -> DataFrame:
        return streams.experiment_counters(self.stream)

    @cached_property
    def deliveries(self) -> DataFrame:
        """Delivery events of all orders with the first seller of the order."""
        sellers = self.raw_items.groupBy("order_id").agg(
            F.min(F.struct("order_item_id", "product_id", "seller_id"))["seller_id"].alias("seller_id")
        )
        return (
            messages.delivery_events(self.stg_orders)
            .withColumnRenamed("event_time", "event_timestamp")
            .join(sellers, "order_id", "left")
        )

    @cached_property
    def alerts(self) -> DataFrame:
        return streams.delivery_alerts(self.deliveries)

    @cached_property
    def offsets(self) -> DataFrame:
        return self._raw(adapters.consumer_offsets)

    # experiments
    @cached_property
    def catalog(self) -> DataFrame:
        return adapters.experiment_catalog(self.spark)

    @cached_property
    def assignments(self) -> DataFrame:
        names = F.create_map(*[F.lit(x) for e in fixed.EXPERIMENTS for x in e[:2]])
        return assignment.assign(
            self.raw_customers.select("customer_id", "customer_state"), fixed.EXPERIMENT_IDS
        ).withColumn("experiment_name", F.element_at(names, F.col("experiment_id")))

    @cached_property
    def results(self) -> DataFrame:
        return experiments.fct_experiment_results(self.assignments, self.stg_orders)

    @cached_property
    def frame(self) -> DataFrame:
        """Analysis frame with conversion by the keyed threshold of the catalog."""
        rates = F.create_map(*[F.lit(x) for e in fixed.EXPERIMENTS for x in (e[0], e[6])])
        lifts = F.create_map(*[F.lit(x) for e in fixed.EXPERIMENTS for x in (e[0], e[3])])
        converted = experiments.keyed_threshold(
            F.element_at(rates, F.col("experiment_id")), F.element_at(lifts, F.col("experiment_id"))
        )
        return experiments.experiment_frame(
            self.assignments,
            self._raw(adapters.raw_orders, False),
            self.raw_items,
            self.scores_only,
            converted,
        )

    @cached_property
    def frame_table(self) -> DataFrame:
        """The analysis frame as a written table, for statistics that need several passes."""
        columns = ["experiment_id", "customer_id", "customer_state", "variant", "converted"]
        return materialize(self.frame.select(*columns, "order_total", "item_count", "review_score"), "frame")
