"""The given star-schema tables in the shape of the marketplace tables.

Each function reads only the parquet tables it needs and derives the columns the
operators expect. Some derivations add the defects real data has (approval before
purchase, unknown statuses, repeated review ids, blank devices).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agorakit.functions import fixed
from agorakit.operators.assignment import arm_of

STATE_CODES = sorted(fixed.STATE_NAMES)

CATEGORY_OF_TYPE = {
    "economy": "health_beauty",
    "large": "furniture_decor",
    "medium": "telephony",
    "small": "toys",
    "standard": "auto",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shift(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("long") * F.lit(1_000_000))


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def state_code(nation: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATE_CODES]), nation + 1)


def zip_prefix(nation: Column) -> Column:
    return F.lpad(nation.cast("string"), 5, "0")


def raw_orders(spark: SparkSession, sf_dir: str, deliveries: bool = True) -> DataFrame:
    """Orders. ``deliveries=False`` leaves the delivery time null and skips the scan it needs."""
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("timestamp")
    purchase = shift(day, key * 7919 % 86400)
    pending = (
        F.when(F.col("o_orderpriority") == "5-LOW", "canceled")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "created")
        .otherwise("processing")
    )
    delivered = F.col("o_orderstatus") == "F"
    orders = table(spark, sf_dir, "orders")
    if deliveries:
        shipped = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.max("l_shipdate").cast("timestamp").alias("last_ship"))
        )
        orders = orders.join(shipped, "o_orderkey", "left")
    else:
        orders = orders.withColumn("last_ship", F.lit(None).cast("timestamp"))
    return orders.select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        F.when(delivered, "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise(pending)
        .alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        F.when(key % 500 != 0, shift(purchase, (key % 7 - 1) * 3600)).alias("order_approved_at"),
        F.when(F.col("o_orderstatus").isin("F", "O"), shift(purchase, F.lit(2 * 86400))).alias(
            "order_delivered_carrier_date"
        ),
        F.when(delivered, F.col("last_ship")).alias("order_delivered_customer_date"),
        shift(day, F.lit(30 * 86400)).alias("order_estimated_delivery_date"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order, and a voucher of 10 on every seventh."""
    key = F.col("o_orderkey")
    kind = (
        F.when(F.col("o_orderpriority") == "2-HIGH", "Boleto")
        .when(F.col("o_orderpriority") == "3-MEDIUM", " voucher ")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "debit_card")
        .otherwise("credit_card")
    )

    def payment(seq, what, installments, value):
        return F.struct(
            F.lit(seq).alias("payment_sequential"),
            what.alias("payment_type"),
            installments.cast("int").alias("payment_installments"),
            value.alias("payment_value"),
        )

    main = payment(1, kind, key % 10 + 1, F.col("o_totalprice"))
    voucher = payment(2, F.lit("voucher"), F.lit(1), F.lit(10.0))
    rows = F.when(key % 7 == 0, F.array(main, voucher)).otherwise(F.array(main))
    return (
        table(spark, sf_dir, "orders")
        .select(_text("o_orderkey").alias("order_id"), F.explode(rows).alias("p"))
        .select("order_id", "p.*")
    )


def raw_reviews(spark: SparkSession, sf_dir: str, text: bool = True) -> DataFrame:
    """Reviews: the documents as texts, their labels as scores, document n on order n."""
    doc = F.col("doc_id")
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", "source") if text else docs.select("doc_id")
    score = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 5)
        .when(F.col("quality") == 1, 4)
        .when((F.col("quality") == 0) & (F.col("toxic") == 0), 2)
        .when(F.col("quality") == 0, 1)
        .otherwise(3)
    )
    created = shift(F.lit("1996-01-01 00:00:00").cast("timestamp"), doc * 3571 % 129_600_000)
    columns = [
        F.concat(F.lit("r"), (doc - F.when(doc % 97 == 1, 1).otherwise(0)).cast("string")).alias("review_id"),
        _text("doc_id").alias("order_id"),
        score.alias("review_score"),
        created.alias("review_creation_date"),
        F.when(doc % 11 != 0, shift(created, doc % 100 * 1800)).alias("review_answer_timestamp"),
    ]
    if text:
        columns += [
            F.when(doc % 8 == 0, F.col("source")).alias("review_comment_title"),
            F.when(doc % 5 >= 3, F.col("text")).alias("review_comment_message"),
        ]
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left").select(*columns)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            _text("c_custkey").alias("customer_id"),
            _text("c_custkey").alias("customer_unique_id"),
            zip_prefix(F.col("c_nationkey")).alias("customer_zip_code_prefix"),
            F.col("n_name").alias("customer_city"),
            F.lower(state_code(F.col("c_nationkey"))).alias("customer_state"),
        )
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            _text("s_suppkey").alias("seller_id"),
            zip_prefix(F.col("s_nationkey")).alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.lower(state_code(F.col("s_nationkey"))).alias("seller_state"),
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        F.lower("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (size * 3).alias("product_description_lenght"),
        (size % 5).alias("product_photos_qty"),
        (size * 100).cast("double").alias("product_weight_g"),
        (size * 2).cast("double").alias("product_length_cm"),
        size.cast("double").alias("product_height_cm"),
        F.when(size % 25 != 0, size.cast("double")).alias("product_width_cm"),
    )


def raw_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English names for the product types that have one."""
    names = F.create_map(*[F.lit(x) for pair in CATEGORY_OF_TYPE.items() for x in pair])
    kinds = table(spark, sf_dir, "part").select(F.lower("p_type").alias("product_category_name")).distinct()
    return kinds.withColumn("product_category_name_english", F.element_at(names, F.col("product_category_name"))).where(
        F.col("product_category_name_english").isNotNull()
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many positions per zip, one for each customer living there."""
    key = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            zip_prefix(F.col("c_nationkey")).alias("geolocation_zip_code_prefix"),
            ((key * 37 % 1800) / F.lit(10.0) - F.lit(90.0)).alias("geolocation_lat"),
            ((key * 53 % 3600) / F.lit(10.0) - F.lit(180.0)).alias("geolocation_lng"),
            F.col("n_name").alias("geolocation_city"),
            state_code(F.col("c_nationkey")).alias("geolocation_state"),
        )
    )


def clicks_of(events: DataFrame) -> DataFrame:
    """Click log: one session per user and day, attributes from the event properties."""
    kind = (
        F.when(F.col("event_type") == "view", "product_view")
        .when(F.col("event_type") == "click", "add_to_cart")
        .when(F.col("event_type") == "signup", "checkout_start")
        .when(F.col("event_type") == "purchase", "checkout_complete")
        .otherwise("session_start")
    )
    k = F.get_json_object("props", "$.k").cast("int")
    ts = F.col("ts").cast("timestamp")
    device = F.when(k % 3 == 0, "mobile").when(k % 3 == 1, "desktop").otherwise("tablet")
    referrer = (
        F.when(k % 4 == 0, "google").when(k % 4 == 1, "direct").when(k % 4 == 2, "email").otherwise("social")
    )
    customer = _text("user_id")
    return events.select(
        _text("event_id").alias("event_id"),
        kind.alias("event_type"),
        ts.alias("event_timestamp"),
        F.concat_ws("-", customer, F.date_format(ts, "yyyyMMdd")).alias("session_id"),
        customer.alias("customer_id"),
        F.lit("exp_001").alias("experiment_id"),
        arm_of(customer, F.lit("exp_001")).alias("variant"),
        F.when(k % 10 == 0, "").otherwise(device).alias("device"),
        F.when(k % 7 != 0, referrer).alias("referrer"),
        F.concat(F.lit("/p/"), k.cast("string")).alias("page_url"),
        F.when(F.col("event_type") == "purchase", _text("event_id")).otherwise("").alias("order_id"),
        F.col("value").alias("value"),
    )


def order_messages_of(events: DataFrame) -> DataFrame:
    """Order messages as they arrive on the stream."""
    kind = (
        F.when(F.col("event_type") == "view", "order_shipped")
        .when(F.col("event_type") == "signup", "order_delivered")
        .when(F.col("event_type") == "error", "order_canceled")
        .otherwise("order_placed")
    )
    ts = F.col("ts").cast("timestamp")
    customer = _text("user_id")
    return events.select(
        _text("event_id").alias("event_id"),
        _text("event_id").alias("order_id"),
        customer.alias("customer_id"),
        kind.alias("event_type"),
        F.substring_index(kind, "_", -1).alias("order_status"),
        ts.alias("event_timestamp"),
        F.col("value").alias("order_total"),
        F.lit("exp_001").alias("experiment_id"),
        arm_of(customer, F.lit("exp_001")).alias("variant"),
    )


def realtime_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream order table after enrichment with the customer state."""
    states = table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("customer_id"), state_code(F.col("c_nationkey")).alias("customer_state")
    )
    return (
        order_messages_of(table(spark, sf_dir, "events"))
        .join(states, "customer_id", "left")
        .select(
            "event_id",
            "order_id",
            "customer_id",
            "customer_state",
            "event_timestamp",
            "order_total",
            "event_type",
            shift(F.col("event_timestamp"), F.lit(5)).alias("created_at"),
        )
    )


def stream_messages(events: DataFrame) -> DataFrame:
    """Orders and clicks on one topic, as the window aggregator reads them.

    Purchases arrive as ``order_placed`` without a session, all else as clicks.
    """
    clicks = clicks_of(events)
    bought = F.col("event_type") == "checkout_complete"
    return clicks.select(
        "event_id",
        F.when(bought, "order_placed").otherwise(F.col("event_type")).alias("event_type"),
        F.col("event_timestamp"),
        F.when(~bought, F.col("session_id")).alias("session_id"),
        "customer_id",
        "experiment_id",
        "variant",
        F.when(bought, F.col("value")).otherwise(0.0).alias("order_total"),
    )


def consumer_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly head and committed offsets of one consumer group per event type and five partitions.

    The head is the number of events so far in the partition; what was committed
    trails it by the value of the events of that hour.
    """
    events = table(spark, sf_dir, "events")
    hourly = events.groupBy(
        F.concat(F.lit("group-"), F.col("event_type")).alias("consumer_group"),
        F.concat(F.col("event_type"), F.lit("-stream")).alias("topic"),
        (F.col("user_id") % 5).cast("int").alias("partition"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("measured_at"),
    ).agg(F.max("event_id").alias("head"), F.sum(F.floor(F.col("value") * 10)).alias("behind"))
    return hourly.select(
        "consumer_group",
        "topic",
        "partition",
        "head",
        (F.col("head") - F.col("behind") + 40).alias("committed"),
        "measured_at",
    )


def experiment_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fixed.EXPERIMENTS,
        "experiment_id string, experiment_name string, primary_metric string, mde_percent double, "
        "test_type string, sample_per_variant int, baseline_rate double",
    )
