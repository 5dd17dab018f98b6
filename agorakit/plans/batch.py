"""Sources, staging, dimensions, facts and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from agorakit.functions import fixed, half_up
from agorakit.operators import dims, facts, marts
from agorakit.plans.oracle import SENTIMENT, TIER, bucket, case, key, mavg, msum, pct, r, sql
from agorakit.plans.registry import register
from agorakit.session import shared_dir
from agorakit.sources import adapters, documents, tables, topics
from agorakit.sources.schemas import TOPICS

START, END = "1996-01-01", "1998-12-31"

# --- sources ---------------------------------------------------------------------------------------------------

register(
    "order_table_metadata",
    lambda m: tables.table_metadata(m.raw_orders, "orders"),
    sql(
        "SELECT 'orders' AS table_name, count(*) AS row_count, 8 AS column_count, "
        "'order_id:string, customer_id:string, order_status:string, order_purchase_timestamp:timestamp, "
        "order_approved_at:timestamp, order_delivered_carrier_date:timestamp, "
        "order_delivered_customer_date:timestamp, order_estimated_delivery_date:timestamp' AS dtypes FROM raw_orders"
    ),
)
register(
    "category_translation",
    lambda m: m.translation,
    "SELECT DISTINCT lower(p_type) AS product_category_name, "
    f"{case('lower(p_type)', adapters.CATEGORY_OF_TYPE)} AS product_category_name_english FROM part "
    f"WHERE lower(p_type) IN ({', '.join(repr(k) for k in adapters.CATEGORY_OF_TYPE)})",
)


def _click_lines(m):
    """Click events as JSON lines; every 37th line is broken and every 41st has no time."""
    c = m.clicks
    n = F.col("event_id").cast("long")
    stamp = F.when(n % 41 != 0, F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    body = F.to_json(
        F.struct(
            *[F.col(x) for x in ("event_id", "event_type", "session_id", "customer_id", "experiment_id", "variant")],
            stamp.alias("timestamp"),
            F.struct("device", "referrer", "page_url", "order_id").alias("properties"),
            F.lit(1).alias("unknown_field"),
        )
    )
    return c.select(F.when(n % 37 == 0, F.substring(body, 1, 40)).otherwise(body).alias("value"))


def _parsed_clicks(m):
    parsed = topics.parse_messages(_click_lines(m), TOPICS["clickstream"])
    whole = parsed.where(F.col("event_id").isNotNull() & F.col("properties").isNotNull())
    return tables.flatten_clickstream(whole).drop("_loaded_at")


register(
    "clickstream_json_scan",
    _parsed_clicks,
    sql(
        "SELECT event_id, event_type, event_timestamp, session_id, customer_id, experiment_id, variant, device, "
        "coalesce(referrer, '') AS referrer, page_url, order_id FROM clicks WHERE seq % 37 <> 0 AND seq % 41 <> 0"
    ),
)
register(
    "realtime_snapshot",
    lambda m: tables.snapshot(m.rt.drop("event_id"), "created_at"),
    sql("SELECT * FROM rt ORDER BY created_at DESC"),
)
register(
    "lookup_customers",
    lambda m: documents.lookup_customers(m.raw_customers, m.raw_geolocation),
    sql(
        "SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix, customer_city AS city, "
        "customer_state AS state, lat AS latitude, lng AS longitude FROM raw_customers JOIN first_geo "
        "ON zip = customer_zip_code_prefix",
        first_geo="SELECT zip, lat, lng FROM raw_geo QUALIFY row_number() OVER (PARTITION BY zip ORDER BY lat, lng) = 1",
    ),
)
register(
    "lookup_sellers",
    lambda m: documents.lookup_sellers(m.raw_sellers),
    sql(
        "SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix, seller_city AS city, lower(seller_state) AS state "
        "FROM raw_sellers"
    ),
)


def _product_docs(m):
    d = documents.product_docs(m.raw_products)
    a = "attributes"
    return d.select(
        "product_id",
        "category",
        f"{a}.weight_g",
        f"{a}.dimensions.length_cm",
        f"{a}.dimensions.height_cm",
        f"{a}.dimensions.width_cm",
        f"{a}.photos_qty",
        f"{a}.name_length",
        f"{a}.description_length",
    )


register(
    "product_documents",
    _product_docs,
    "SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS category, p_size * 100 AS weight_g, "
    "(p_size * 2)::DOUBLE AS length_cm, p_size::DOUBLE AS height_cm, "
    "CASE WHEN p_size % 25 <> 0 THEN p_size::DOUBLE END AS width_cm, p_size % 5 AS photos_qty, "
    "CAST(length(p_name) AS INTEGER) AS name_length, p_size * 3 AS description_length FROM part",
)


def _review_docs(m):
    d = documents.review_docs(m.raw_reviews, m.raw_items)
    return d.select(
        "review_id",
        "order_id",
        "product_id",
        "rating",
        "comment.title",
        F.length("comment.message").cast("long").alias("message_length"),
        "comment.language",
        "timestamps.created_at",
        "timestamps.answered_at",
    )


register(
    "review_documents",
    _review_docs,
    sql(
        "SELECT v.review_id, v.order_id, coalesce(f.product_id, v.order_id) AS product_id, review_score AS rating, "
        "nullif(trim(review_comment_title, ' '), '') AS title, "
        "length(nullif(trim(review_comment_message, ' '), '')) AS message_length, "
        "'pt' AS language, strftime(review_creation_date, '%Y-%m-%dT%H:%M:%SZ') AS created_at, "
        "strftime(review_answer_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS answered_at FROM first_review v "
        "LEFT JOIN first_item f ON v.order_id = f.order_id",
        first_review="SELECT * FROM raw_reviews QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY order_id) = 1",
        first_item="SELECT order_id, product_id FROM raw_items QUALIFY row_number() OVER "
        "(PARTITION BY order_id ORDER BY order_item_id, product_id) = 1",
    ),
)
register(
    "assignment_documents",
    lambda m: documents.assignment_docs(m.assignments),
    sql(
        "SELECT customer_id || '|' || experiment_id AS _id, customer_id, experiment_id, variant, "
        "'2024-02-01T00:00:00Z' AS assigned_at, sha256(customer_id || '|' || experiment_id) AS assignment_hash "
        "FROM assignments"
    ),
)


def _sync_orders(m):
    rt = m.rt.select(
        "order_id",
        "customer_id",
        F.when(F.col("order_id").cast("long") % 3 != 0, F.col("customer_state")).otherwise(" ").alias("customer_state"),
        F.when(F.col("order_id").cast("long") % 29 != 0, F.col("event_timestamp")).alias("event_timestamp"),
        F.when(F.col("order_id").cast("long") % 31 == 0, "n/a")
        .otherwise(F.col("order_total").cast("string"))
        .alias("order_total"),
        F.when(F.col("order_id").cast("long") % 7 != 0, F.col("event_type")).alias("event_type"),
        F.col("created_at").alias("processed_at"),
    )
    lookup = documents.lookup_customers(m.raw_customers, m.raw_geolocation)
    return documents.sync_orders(rt, lookup)


register(
    "sync_realtime_orders",
    _sync_orders,
    sql(
        "SELECT order_id AS event_id, order_id, customer_id, CASE WHEN n % 3 <> 0 THEN customer_state "
        "ELSE lower(customer_state) END AS customer_state, event_timestamp, "
        "CASE WHEN n % 31 = 0 THEN 0::DOUBLE ELSE order_total END AS order_total, "
        "CASE WHEN n % 7 = 0 THEN 'order_placed' ELSE event_type END AS event_type, created_at "
        "FROM (SELECT *, CAST(order_id AS BIGINT) AS n FROM rt) WHERE n % 29 <> 0"
    ),
)


def _sync_metrics(m):
    text = m.metrics.select(
        F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("window_start"),
        F.date_format("window_end", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("window_end"),
        "metric_name",
        F.when(F.col("metric_name") == "total_clicks", "?").otherwise(F.col("metric_value").cast("string")).alias(
            "metric_value"
        ),
    )
    return documents.sync_metrics(text).drop("_ingested_at")


register(
    "sync_realtime_metrics",
    _sync_metrics,
    sql(
        "SELECT window_start, window_end, metric_name, "
        "CASE WHEN metric_name = 'total_clicks' THEN 0 ELSE metric_value END AS metric_value FROM metrics"
    ),
)

# --- staging ---------------------------------------------------------------------------------------------------

register("stg_geolocation", lambda m: m.stg_geolocation, sql("SELECT * FROM stg_geo"))
register("stg_orders", lambda m: m.stg_orders, sql("SELECT * FROM stg_orders"))
register(
    "stg_customers",
    lambda m: m.stg_customers,
    sql(
        "SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, "
        f"upper(customer_state) AS customer_state, {case('upper(customer_state)', fixed.STATE_NAMES)} "
        "AS customer_state_name, geolocation_lat AS customer_lat, geolocation_lng AS customer_lng "
        "FROM raw_customers LEFT JOIN stg_geo ON geolocation_zip_code_prefix = customer_zip_code_prefix"
    ),
)
_VOLUME = "product_length_cm * product_height_cm * product_width_cm"
register(
    "stg_products",
    lambda m: m.stg_products,
    sql(
        f"SELECT *, {_VOLUME} AS product_volume_cm3, {bucket('product_weight_g', *fixed.WEIGHT)} "
        "AS product_weight_category FROM stg_products"
    ),
)
register("stg_order_items", lambda m: m.stg_items, sql("SELECT * FROM raw_items"))
register("stg_payments", lambda m: m.stg_payments, sql("SELECT * FROM raw_payments"))
register("stg_reviews", lambda m: m.stg_reviews, sql("SELECT * FROM stg_reviews"))
register(
    "stg_sellers",
    lambda m: m.stg_sellers,
    sql(
        "SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state, geolocation_lat AS seller_lat, "
        "geolocation_lng AS seller_lng FROM raw_sellers LEFT JOIN stg_geo "
        "ON geolocation_zip_code_prefix = seller_zip_code_prefix"
    ),
)
register(
    "load_wide_orders",
    lambda m: m.wide,
    sql(
        "SELECT order_id, customer_id, order_status, customer_state, order_purchase_timestamp, order_total, item_count "
        "FROM wide"
    ),
)
register(
    "load_staging_orders",
    lambda m: tables.load_staging_orders(m.raw_orders, m.raw_items),
    sql(
        "SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
        "order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date, "
        "coalesce(t, 0) AS order_total FROM raw_orders LEFT JOIN "
        f"(SELECT order_id, {r('sum(price + freight_value)', 4)} AS t FROM raw_items GROUP BY order_id) USING (order_id)"
    ),
)
register(
    "load_reviews_dedup",
    lambda m: tables.load_reviews(m.raw_reviews),
    sql(
        "SELECT review_id, order_id, review_score FROM raw_reviews "
        "QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY order_id, review_score) = 1"
    ),
)

# --- dimensions ------------------------------------------------------------------------------------------------

register(
    "dim_dates",
    lambda m: m.dim_dates,
    sql(
        f"SELECT date, {key('dt_', 'date')} AS date_key, CAST(year(date) AS INTEGER) AS year, "
        "CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name, "
        "CAST(weekofyear(date) AS INTEGER) AS week_of_year, CAST(isodow(date) AS INTEGER) AS day_of_week, "
        "dayname(date) AS day_name, isodow(date) >= 6 AS is_weekend, "
        f"date IN ({', '.join(f'DATE {h!r}' for h in fixed.HOLIDAYS)}) AS is_holiday, "
        "CAST(year(date) AS INTEGER) AS fiscal_year, CAST(quarter(date) AS INTEGER) AS fiscal_quarter FROM dates"
    ),
)
register(
    "dim_geography",
    lambda m: m.dim_geography,
    sql(
        f"SELECT *, {key('geo_', 'geolocation_zip_code_prefix')} AS geography_key, "
        f"{case('geolocation_state', fixed.STATE_REGION)} AS region FROM stg_geo"
    ),
)


def _dim_products_sql(op: str) -> str:
    return sql(
        f"SELECT *, {bucket('product_weight_g', *fixed.WEIGHT)} AS product_weight_category, "
        f"{key('prd_', 'product_id')} AS product_key, "
        f"{bucket('product_volume_cm3', *fixed.VOLUME, op=op)} AS product_size_category, "
        f"{case('product_category_name_english', fixed.CATEGORY_GROUP, repr('other'))} AS product_category_group "
        f"FROM (SELECT *, {_VOLUME} AS product_volume_cm3 FROM stg_products)"
    )


register("dim_products", lambda m: m.dim_products, _dim_products_sql("<="))
register("dim_products_left_closed", lambda m: dims.dim_products(m.stg_products, "left"), _dim_products_sql("<"))

_REGION = case("customer_state", fixed.STATE_REGION, "'Other'")
register(
    "dim_customers",
    lambda m: m.dim_customers.drop("customer_lat", "customer_lng"),
    sql(
        "SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, "
        f"{case('customer_state', fixed.STATE_NAMES)} AS customer_state_name, coalesce(n, 0) AS total_orders, "
        "coalesce(s, 0::DOUBLE) AS total_spent, coalesce(s / n, 0::DOUBLE) AS avg_order_value, first_order_date, "
        "last_order_date, CASE WHEN coalesce(n, 0) > 10 THEN 'vip' WHEN coalesce(n, 0) >= 2 THEN 'regular' "
        "ELSE 'new' END AS customer_tier, CASE WHEN coalesce(s, 0) > 1000 THEN 'high' WHEN coalesce(s, 0) >= 100 "
        f"THEN 'medium' ELSE 'low' END AS customer_value, {key('cust_', 'customer_id')} AS customer_key, "
        f"{_REGION} AS customer_region FROM (SELECT * REPLACE (upper(customer_state) AS customer_state) "
        f"FROM raw_customers) LEFT JOIN (SELECT customer_id, count(*) AS n, {msum('order_total')} AS s, "
        "min(order_purchase_timestamp) AS first_order_date, max(order_purchase_timestamp) AS last_order_date "
        "FROM stg_orders WHERE order_status = 'delivered' GROUP BY customer_id) USING (customer_id)"
    ),
)
register(
    "dim_sellers",
    lambda m: m.dim_sellers.drop("seller_lat", "seller_lng"),
    sql(
        "SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state, coalesce(n, 0) AS total_orders_fulfilled, "
        "coalesce(score, 0) AS avg_review_score, coalesce(d, 0) AS avg_delivery_time_days, "
        f"{TIER.format('coalesce(score, 0)')} AS seller_tier, {key('sell_', 'seller_id')} AS seller_key, "
        f"{case('seller_state', fixed.STATE_REGION, repr('Other'))} AS seller_region FROM raw_sellers "
        "LEFT JOIN (SELECT seller_id, count(*) AS n FROM pairs GROUP BY seller_id) USING (seller_id) "
        "LEFT JOIN (SELECT seller_id, avg(review_score) AS score FROM pairs JOIN "
        "(SELECT DISTINCT order_id, review_score FROM raw_reviews) USING (order_id) GROUP BY seller_id) USING (seller_id) "
        "LEFT JOIN (SELECT seller_id, avg(delivery_time_days) AS d FROM pairs JOIN stg_orders USING (order_id) "
        "GROUP BY seller_id) USING (seller_id)",
        pairs="SELECT DISTINCT seller_id, order_id FROM raw_items",
    ),
)
register(
    "dim_sellers_by_item",
    lambda m: dims.dim_sellers_by_item(m.stg_items, m.stg_orders, m.scores_only),
    sql(
        f"SELECT {key('sell_', 'seller_id')} AS seller_key, seller_id, n AS total_orders_fulfilled, "
        "revenue AS total_revenue, coalesce(score, 0) AS avg_review_score, coalesce(d, 0) AS avg_delivery_time_days, "
        f"{TIER.format('coalesce(score, 0)')} AS seller_tier FROM (SELECT seller_id, count(DISTINCT order_id) AS n, "
        f"{msum('price')} AS revenue FROM raw_items GROUP BY seller_id) LEFT JOIN (SELECT seller_id, "
        f"{r('avg(review_score)')} AS score FROM raw_items JOIN raw_reviews USING (order_id) GROUP BY seller_id) "
        f"USING (seller_id) LEFT JOIN (SELECT seller_id, {r('avg(dd)', 1)} AS d FROM raw_items JOIN (SELECT order_id, "
        "date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_delivered_customer_date AS DATE)) AS dd "
        "FROM stg_orders WHERE order_delivered_customer_date IS NOT NULL) USING (order_id) GROUP BY seller_id) "
        "USING (seller_id)"
    ),
)

# --- facts -----------------------------------------------------------------------------------------------------

register("fct_orders", lambda m: m.fct_orders, sql("SELECT * FROM fct_orders"))


def _fct_day(m):
    return facts.fct_orders(
        m.stg_orders, m.stg_items, m.stg_payments, m.customer_keys, m.seller_keys, m.dim_dates, m.dim_geography,
        "1997-05-28",
    )


register("fct_orders_one_day", _fct_day, sql("SELECT * FROM fct_orders WHERE order_date = DATE '1997-05-28'"))
register("fct_order_items", lambda m: m.fct_items, sql("SELECT * FROM fct_items"))
_FCT_REVIEWS = sql(
    f"SELECT {key('fr_', 'review_id')} AS review_fact_key, review_id, order_id, {key('fct_', 'order_id')} AS fact_key, "
    "review_score, CAST(coalesce(length(review_comment_message), 0) AS INTEGER) AS review_comment_length, "
    f"coalesce({r('(epoch_us(review_answer_timestamp) - epoch_us(review_creation_date)) / 1000000 / 3600')}, 0) "
    f"AS response_time_hours, {SENTIMENT} AS sentiment, coalesce(review_comment_message <> '', false) AS has_comment, "
    "review_creation_date FROM stg_reviews"
)
register("fct_reviews", lambda m: facts.fct_reviews(m.stg_reviews), _FCT_REVIEWS)
register(
    "fct_orders_profile",
    lambda m: facts.fact_profile(m.fct_orders),
    sql(
        "SELECT count(*) AS row_count, count(*) FILTER (customer_key IS NULL) AS null_customer_key, "
        "count(*) FILTER (date_key IS NULL) AS null_date_key, "
        "count(*) FILTER (order_status = 'delivered' AND order_total <= 0) AS negative_order_total_delivered "
        "FROM fct_orders"
    ),
)
register(
    "fct_reviews_profile",
    lambda m: facts.review_profile(facts.fct_reviews(m.stg_reviews)),
    sql(
        "SELECT count(*) AS row_count, count(*) FILTER (review_score NOT BETWEEN 1 AND 5) AS invalid_review_scores, "
        "0::BIGINT AS invalid_sentiments FROM raw_reviews"
    ),
)

# --- marts -----------------------------------------------------------------------------------------------------

register("fct_daily_metrics", lambda m: m.daily, sql("SELECT * FROM daily"))


_DAILY_COLUMNS = {
    "total_orders": "0",
    "total_gmv": "0",
    "total_items": "0",
    "avg_order_value": "0",
    "unique_customers": "0",
    "orders_delivered": "0",
    "orders_canceled": "0",
    "avg_delivery_time_days": "NULL",
    "late_delivery_rate": "0",
    "total_revenue": "0",
    "total_freight": "0",
    "avg_items_per_order": "0",
}
register(
    "daily_metrics_filled",
    lambda m: marts.fill_days(m.daily, m.dim_dates),
    sql(
        "SELECT dates.date, "
        + ", ".join(f"coalesce({c}, {z}) AS {c}" for c, z in _DAILY_COLUMNS.items())
        + " FROM dates LEFT JOIN daily x ON x.date = dates.date"
    ),
)
register(
    "fct_product_performance",
    lambda m: marts.fct_product_performance(m.stg_items, m.scores_only, m.dim_products),
    sql(
        "SELECT i.product_key, product_category_name_english, "
        f"{case('product_category_name_english', fixed.CATEGORY_GROUP, repr('other'))} AS product_category_group, "
        f"units AS units_sold, {r('revenue')} AS total_revenue, freight AS total_freight, {r('revenue / units')} "
        "AS avg_price, orders_n AS order_count, coalesce(num_reviews, 0) AS num_reviews, "
        f"{r('coalesce(score, 0)')} AS avg_review_score, "
        f"{r('coalesce(num_reviews, 0) / greatest(units, 1) * 100')} AS review_rate "
        f"FROM (SELECT product_key, CAST(sum(quantity) AS BIGINT) AS units, {msum('price')} AS revenue, "
        f"{msum('freight_value')} AS freight, count(DISTINCT order_id) AS orders_n FROM fct_items GROUP BY 1) i "
        f"JOIN (SELECT *, {key('prd_', 'product_id')} AS product_key FROM stg_products) p USING (product_key) "
        "LEFT JOIN (SELECT product_id, count(review_score) AS num_reviews, avg(review_score) AS score FROM "
        "(SELECT DISTINCT order_id, product_id FROM raw_items) JOIN first_scores USING (order_id) GROUP BY 1) v "
        "USING (product_id)"
    ),
)
register(
    "fct_seller_performance",
    lambda m: marts.fct_seller_performance(m.stg_items, m.stg_orders, m.scores_only, m.dim_sellers),
    sql(
        "SELECT x.seller_key, seller_city, seller_state, "
        f"{case('seller_state', fixed.STATE_REGION, repr('Other'))} AS seller_region, "
        f"{TIER.format('coalesce(tier_score, 0)')} AS seller_tier, n AS total_orders_fulfilled, {r('revenue')} "
        "AS total_revenue, freight AS total_freight, items AS total_items_sold, "
        f"{r('d')} AS avg_delivery_time_days, coalesce({pct('late', 'n')}, 0) AS late_delivery_rate, "
        f"{r('coalesce(score, 0)')} AS avg_review_score, num_reviews FROM (SELECT seller_key, count(*) AS n, "
        "avg(delivery_time_days) AS d, count(*) FILTER (is_late) AS late, avg(review_score) AS score, "
        "count(review_score) AS num_reviews FROM pairs LEFT JOIN stg_orders USING (order_id) "
        "LEFT JOIN first_scores USING (order_id) GROUP BY 1) x JOIN (SELECT seller_key, "
        f"{msum('price')} AS revenue, {msum('freight_value')} AS freight, CAST(sum(quantity) AS BIGINT) AS items "
        "FROM fct_items GROUP BY 1) USING (seller_key) "
        f"JOIN (SELECT *, {key('sell_', 'seller_id')} AS seller_key FROM raw_sellers) USING (seller_key) "
        "LEFT JOIN (SELECT seller_key, avg(review_score) AS tier_score FROM pairs JOIN "
        "(SELECT DISTINCT order_id, review_score FROM raw_reviews) USING (order_id) GROUP BY 1) USING (seller_key)",
        pairs="SELECT DISTINCT seller_key, order_id FROM fct_items",
    ),
)
_RANGE = f"order_date BETWEEN DATE '{START}' AND DATE '{END}'"
register(
    "monthly_revenue",
    lambda m: marts.monthly_revenue(m.fct_orders, START, END),
    sql(
        "SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS total_orders, "
        f"{msum('order_total')} AS total_revenue, {mavg('order_total')} AS avg_order_value, "
        f"count(*) FILTER (is_late_delivery) AS late_deliveries FROM fct_orders WHERE {_RANGE} GROUP BY 1"
    ),
)
register(
    "status_breakdown",
    lambda m: marts.status_breakdown(m.fct_orders, START, END, ["delivered", "shipped"]),
    sql(
        f"SELECT order_status, count(*) AS order_count, {msum('order_total')} AS total_revenue, "
        f"avg(delivery_time_days) AS avg_delivery_days FROM fct_orders WHERE {_RANGE} "
        "AND order_status IN ('delivered', 'shipped') GROUP BY 1"
    ),
)
register(
    "mv_monthly_revenue",
    lambda m: marts.mv_monthly_revenue(m.fct_orders),
    sql(
        "SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, order_status, count(*) AS total_orders, "
        f"{msum('order_total')} AS total_revenue, {mavg('order_total')} AS avg_order_value, "
        f"{msum('freight_value')} AS total_freight FROM fct_orders GROUP BY 1, 2"
    ),
)
register(
    "mv_seller_performance",
    lambda m: marts.mv_seller_performance(m.fct_items),
    sql(
        f"SELECT seller_key, count(*) AS total_orders, {msum('price')} AS total_revenue, {mavg('price')} "
        "AS avg_item_price FROM fct_items GROUP BY 1"
    ),
)


def _approx(m):
    """Approximate distinct customers per status, and whether they are within 10 % of the exact count."""
    approx = marts.approx_distinct(m.fct_orders, "customer_key", ["order_status"])
    exact = m.fct_orders.groupBy("order_status").agg(F.count_distinct("customer_key").alias("exact"))
    close = F.abs(F.col("approx_distinct") - F.col("exact")) <= F.col("exact") * 0.1
    return approx.join(exact, "order_status").select("order_status", "exact", close.alias("within_tolerance"))


register(
    "approx_distinct_customers",
    _approx,
    sql(
        "SELECT order_status, count(DISTINCT customer_key) AS exact, true AS within_tolerance FROM fct_orders GROUP BY 1"
    ),
)
_SKETCHED_FROM = "1995-01-01"


def _sketched(m):
    """Distinct customers per status since a day, from sketches stored by day, against the exact count.

    One sketch for each day and status, sorted by day in a folder for each month, so a range of days opens its months.
    """
    path = shared_dir(m.spark, "sketches")
    orders = m.fct_orders.select(F.col("order_date").alias("day"), "order_status", "customer_key")
    keys = ["day", "order_status"]
    sketches = marts.stored_sketches(marts.distinct_registers(orders, "customer_key", keys), keys)
    by_month = sketches.withColumn("month", F.date_format("day", "yyyy-MM"))
    by_month.repartition("month").sortWithinPartitions("month", "day").write.partitionBy("month").parquet(f"{path}/table")
    since = F.col("day") >= F.lit(_SKETCHED_FROM).cast("date")
    days = m.spark.read.schema(by_month.schema).parquet(f"{path}/table").where((F.col("month") >= _SKETCHED_FROM[:7]) & since)
    exact = orders.where(since).groupBy("order_status").agg(F.count_distinct("customer_key").alias("exact"))
    found = marts.distinct_from_sketches(days, ["order_status"]).join(exact, "order_status")
    error = (F.col("estimate") - F.col("exact")) / F.col("exact") * F.lit(100.0)
    return found.select("order_status", "estimate", "exact", half_up(error, 4).alias("error_pct"))


_M = 2**marts.SKETCH_BITS
register(
    "distinct_customers_from_sketches",
    _sketched,
    sql(
        f"SELECT order_status, estimate, exact, {r('(estimate - exact) / exact::DOUBLE * 100', 4)} AS error_pct FROM (SELECT order_status, CAST(floor(CASE WHEN raw <= {2.5 * _M} AND "
        f"used < {_M} THEN {_M} * ln({_M} / ({_M} - used)) ELSE raw END + 0.5) AS BIGINT) AS estimate FROM (SELECT order_status, "
        f"{0.7213 / (1 + 1.079 / _M) * _M * _M}::DOUBLE / (sum(pow(2.0::DOUBLE, -rank)) + {_M} - count(*)) AS raw, count(*)::DOUBLE AS used FROM "
        "(SELECT order_status, register, max(CASE WHEN x = 0 THEN 53 ELSE 53 - length(bin(x)) END) AS rank FROM (SELECT order_status, "
        "substr(h, 1, 3) AS register, ('0x' || substr(h, 4, 13))::BIGINT AS x FROM (SELECT order_status, sha256(customer_key) AS h FROM since)) "
        "GROUP BY 1, 2) GROUP BY 1)) JOIN (SELECT order_status, count(DISTINCT customer_key) AS exact FROM since GROUP BY 1) USING (order_status)",
        since=f"SELECT * FROM fct_orders WHERE order_date >= DATE '{_SKETCHED_FROM}'",
    ),
)
_DAILY_STREAM = (
    "SELECT CAST(window_start AS DATE) AS metric_date, "
    "CAST(sum(metric_value) FILTER (metric_name = 'total_orders') AS BIGINT) AS total_orders, "
    + r("sum(metric_value) FILTER (metric_name = 'total_gmv')", 4)
    + " AS total_gmv, "
    + r("sum(metric_value) FILTER (metric_name = 'avg_order_value')", 4)
    + " / count(*) FILTER (metric_name = 'avg_order_value') AS avg_order_value, "
    "CAST(sum(metric_value) FILTER (metric_name = 'unique_sessions') AS BIGINT) AS unique_customers "
    "FROM metrics GROUP BY 1"
)
register("daily_from_windows", lambda m: marts.daily_from_windows(m.metrics), sql(_DAILY_STREAM))
register(
    "order_rates",
    lambda m: marts.order_rates(m.stg_items, m.raw_orders, m.scores_only),
    sql(
        f"SELECT (SELECT {r('avg(n)')} FROM (SELECT count(*) AS n FROM raw_items GROUP BY order_id)) AS items_per_order, "
        f"count(*) AS total_reviews, {r('count(*) / (SELECT count(*) FROM orders) * 100', 1)} AS review_rate, "
        f"{r('avg(review_score)')} AS avg_review_score FROM raw_reviews"
    ),
)
register(
    "order_total_profile",
    lambda m: marts.order_total_profile(m.wide),
    sql(
        "SELECT count(*) AS total, count(*) FILTER (order_total = 0) AS zero_total, "
        "count(*) FILTER (order_total IS NULL) AS null_total, count(*) FILTER (order_total > 0) AS positive_total, "
        "min(d) AS min_date, max(d) AS max_date FROM wide"
    ),
)
register(
    "zero_total_sources",
    lambda m: marts.zero_total_sources(m.wide, m.raw_items),
    sql(
        f"SELECT w.order_id, w.order_total, coalesce({msum('price + freight_value')}, 0) AS items_total FROM wide w "
        "LEFT JOIN raw_items i ON i.order_id = w.order_id WHERE w.order_total = 0 GROUP BY 1, 2"
    ),
)

