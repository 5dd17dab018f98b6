"""Checks, profiles, stream health, freshness and anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from agorakit.operators import quality, serving
from agorakit.plans import batch  # noqa: F401  its queries are checked here
from agorakit.plans.oracle import msum, pct, r, sql
from agorakit.plans.registry import QUERIES, SQL, register
from agorakit.plans.realtime import _RECON, _reconcile
from agorakit.sources import adapters

NOW = "2024-01-31 00:00:00"


def _all_checks(m):
    """The standard checks over every table of the model."""
    checks = quality.standard_checks()
    frames = {
        "stg_orders": m.stg_orders,
        "stg_payments": m.stg_payments,
        "stg_customers": m.stg_customers,
        "stg_products": m.stg_products,
        "stg_reviews": m.stg_reviews,
        "stg_order_items": m.stg_items,
        "fct_order_items": m.fct_items,
        "realtime_orders": m.rt,
        "realtime_metrics": m.metrics,
        "experiments_realtime": m.counters,
        "unified_orders": serving.unified_orders(m.wide, m.rt),
    }
    out = None
    for name, frame in frames.items():
        one = quality.run_checks(frame, checks[name], name)
        out = one if out is None else out.unionByName(one)
    return out


def _check_rows(*rows: tuple[str, str, str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS check_name, '{s}' AS severity, ({v}) = 0 AS passed, "
        f"CAST(({v}) AS BIGINT) AS violations, (SELECT count(*) FROM {src}) AS total"
        for t, c, s, v, src in rows
    )


_NONE = "0"
register(
    "standard_checks",
    _all_checks,
    sql(
        _check_rows(
            ("stg_orders", "not_null:order_id", "error", _NONE, "orders"),
            ("stg_orders", "accepted:order_status", "error", _NONE, "orders"),
            ("stg_orders", "timestamps", "error", _NONE, "orders"),
            ("stg_payments", "not_null:order_id", "error", _NONE, "raw_payments"),
            ("stg_customers", "not_null:customer_id", "error", _NONE, "customer"),
            ("stg_products", "non_negative:dimensions", "error", _NONE, "part"),
            (
                "stg_reviews",
                "range:review_score",
                "error",
                "SELECT count(*) FROM raw_reviews WHERE review_score NOT BETWEEN 1 AND 5",
                "documents",
            ),
            ("stg_order_items", "non_negative:price", "error", "SELECT count(*) FROM raw_items WHERE price < 0", "lineitem"),
            ("fct_order_items", "has_rows", "warning", _NONE, "lineitem"),
            ("fct_order_items", "identity:item_total", "error", _NONE, "lineitem"),
            ("realtime_orders", "has_rows", "warning", _NONE, "events"),
            ("realtime_orders", "non_negative:order_total", "error", "SELECT count(*) FROM rt WHERE order_total < 0", "events"),
            ("realtime_metrics", "has_rows", "warning", _NONE, "metrics"),
            (
                "experiments_realtime",
                "range:conversion_rate",
                "error",
                "SELECT count(*) FROM counters WHERE conversion_rate NOT BETWEEN 0 AND 100",
                "counters",
            ),
            ("unified_orders", "has_rows", "warning", _NONE, "both_ids"),
            (
                "unified_orders",
                "unique:order_id",
                "error",
                "SELECT count(*) - count(DISTINCT order_id) FROM both_ids",
                "both_ids",
            ),
            ("unified_orders", "has_values:_source_layer", "warning", _NONE, "both_ids"),
        ),
        both_ids="SELECT order_id FROM raw_orders UNION ALL SELECT order_id FROM rt",
    ),
)
register(
    "mart_checks",
    lambda m: quality.run_checks(m.dim_customers, quality.standard_checks()["dim_customers"], "dim_customers")
    .unionByName(quality.run_checks(m.daily, [quality.has_rows(), quality.in_range("late_delivery_rate", 0, 100)], "daily"))
    .unionByName(quality.run_checks(m.results, quality.standard_checks()["fct_experiment_results"], "results")),
    sql(
        _check_rows(
            ("dim_customers", "unique:customer_id", "error", _NONE, "customer"),
            ("daily", "has_rows", "warning", _NONE, "daily"),
            ("daily", "range:late_delivery_rate", "error", _NONE, "daily"),
            ("results", "has_rows", "warning", _NONE, "results"),
        )
    ),
)
# the check sets of marts and merged tables, each over the registered query of the table
_CHECKED = {
    "dim_sellers": "dim_sellers",
    "fct_product_performance": "fct_product_performance",
    "fct_seller_performance": "fct_seller_performance",
    "unified_daily": "unified_daily_metrics",
    "unified_experiments": "unified_experiments_stream_wins",
}


def _mart_sets(m):
    checks = quality.standard_checks()
    out = None
    for table, query in _CHECKED.items():
        one = quality.run_checks(QUERIES[query](m.spark, m.sf_dir), checks[table], table)
        out = one if out is None else out.unionByName(one)
    return out


def _mart_set_sql() -> str:
    of = {table: f"({SQL[query]}) AS t" for table, query in _CHECKED.items()}
    has_rows = lambda table: (table, "has_rows", "warning", f"SELECT CASE WHEN count(*) > 0 THEN 0 ELSE 1 END FROM {of[table]}", of[table])
    count = lambda table, name, condition: (table, name, "error", f"SELECT count(*) FROM {of[table]} WHERE {condition}", of[table])
    return _check_rows(
        ("dim_sellers", "unique:seller_id", "error", f"SELECT count(*) - count(DISTINCT seller_id) FROM {of['dim_sellers']}", of["dim_sellers"]),
        has_rows("fct_product_performance"),
        count("fct_product_performance", "non_negative:total_revenue", "total_revenue < 0"),
        has_rows("fct_seller_performance"),
        count("fct_seller_performance", "range:late_delivery_rate", "late_delivery_rate NOT BETWEEN 0 AND 100"),
        has_rows("unified_daily"),
        has_rows("unified_experiments"),
    )


register("mart_check_sets", _mart_sets, _mart_set_sql())
register(
    "layer_count_drift",
    lambda m: quality.count_drift(adapters.raw_orders(m.spark, m.sf_dir, False), m.rt),
    sql(
        f"SELECT a AS count_a, b AS count_b, {r('abs(a - b) / greatest(a, 1) * 100')} AS diff_pct, "
        "abs(a - b) / greatest(a, 1) * 100 <= 5 AS passed FROM (SELECT (SELECT count(*) FROM raw_orders) AS a, "
        "(SELECT count(*) FROM rt) AS b)"
    ),
)
register(
    "stream_only_drift",
    lambda m: quality.stream_drift(_reconcile(m)),
    f"SELECT s AS stream_only_orders, s + o AS stream_total, {r('s / greatest(s + o, 1) * 100', 1)} AS drift_pct, "
    "s / greatest(s + o, 1) * 100 < 50 AS passed FROM (SELECT max(order_count) FILTER (category = 'stream_only') AS s, "
    f"max(order_count) FILTER (category = 'overlap') AS o FROM ({_RECON}))",
)


def _log(m):
    """The click log with purchase totals: those of orders ending in 7 are off by one."""
    expected = m.raw_items.groupBy("order_id").agg(F.round(F.sum("price"), 2).alias("t"))
    off = F.when(F.col("order_id").endswith("7"), 1.0).otherwise(0.0)
    return m.clicks.join(expected, "order_id", "left").withColumn(
        "total", F.when(F.col("order_id") != "", F.coalesce("t", F.lit(0.0)) + off)
    )


def _validated(m):
    orders = adapters.raw_orders(m.spark, m.sf_dir, False)
    # arrival order is the reverse of the event id for one customer in ten
    log = _log(m).withColumn(
        "arrival",
        F.when(F.col("customer_id").cast("long") % 10 == 0, -F.col("event_id").cast("long")).otherwise(
            F.col("event_id").cast("long")
        ),
    )
    return quality.validate_events(
        log, orders, m.raw_customers, None, m.raw_items, m.assignments, NOW, arrival="arrival"
    )


_VALID = sql(
    "SELECT check_name, passed, violations FROM ("
    "SELECT 'all_orders_have_events' AS check_name, v = 0 AS passed, v AS violations FROM (SELECT count(*) AS v FROM "
    "orders WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT order_id FROM clicks WHERE order_id <> '')) UNION ALL "
    "SELECT 'all_customers_known', v = 0, v FROM (SELECT count(DISTINCT user_id) AS v FROM events WHERE user_id NOT IN "
    "(SELECT c_custkey FROM customer)) UNION ALL "
    "SELECT 'all_customers_have_assignments', true, 0 UNION ALL "
    "SELECT 'timestamps_chronological', v = 0, v FROM (SELECT count(*) AS v FROM (SELECT session_id FROM clicks "
    "WHERE CAST(customer_id AS BIGINT) % 10 = 0 GROUP BY 1 HAVING count(*) > 1)) UNION ALL "
    "SELECT 'order_totals_match', v = 0, v FROM (SELECT count(*) AS v FROM clicks WHERE order_id LIKE '%7') UNION ALL "
    "SELECT 'events_per_order_reasonable', ok, CAST(NOT ok AS BIGINT) FROM (SELECT count(*) / "
    "count(DISTINCT nullif(order_id, '')) BETWEEN 8 AND 15 AS ok FROM clicks) UNION ALL "
    "SELECT 'session_duration_realistic', ok, CAST(NOT ok AS BIGINT) FROM (SELECT avg(mins) BETWEEN 5 AND 90 AS ok FROM "
    "(SELECT (epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) / 60000000 AS mins FROM clicks "
    "GROUP BY session_id)) UNION ALL "
    f"SELECT 'no_future_timestamps', v = 0, v FROM (SELECT count(*) AS v FROM events WHERE ts > TIMESTAMP '{NOW}') "
    "UNION ALL SELECT 'schema_valid', true, 0 UNION ALL "
    "SELECT 'funnel_makes_sense', ok, CAST(NOT ok AS BIGINT) FROM (SELECT count(*) FILTER (event_type = 'page_view') >= "
    "count(*) FILTER (event_type = 'checkout_complete') AS ok FROM clicks) UNION ALL "
    "SELECT 'experiment_50_50_split', ok, CAST(NOT ok AS BIGINT) FROM (SELECT avg(CASE variant WHEN 'control' THEN 100.0 "
    "ELSE 0 END) BETWEEN 49 AND 51 AS ok FROM assignments WHERE experiment_id = 'exp_001') UNION ALL "
    "SELECT 'no_customer_in_both_variants', true, 0)"
)
register("event_log_validation", _validated, _VALID)
register(
    "events_per_type",
    lambda m: quality.event_stats(m.clicks),
    sql("SELECT event_type, count(*) AS events FROM clicks GROUP BY 1"),
)


def _spoiled(m):
    """Click messages with defects in every 11th, 19th, 23rd and 29th."""
    n = F.col("event_id").cast("long")
    iso = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return m.clicks.select(
        "event_id",
        "event_type",
        F.when(n % 11 != 0, F.col("customer_id")).alias("customer_id"),
        F.when(n % 19 == 0, "").otherwise(F.col("session_id")).alias("session_id"),
        "experiment_id",
        F.when(n % 23 == 0, "both").otherwise(F.col("variant")).alias("variant"),
        F.when(n % 29 == 0, "soon").otherwise(iso).alias("timestamp"),
    )


register(
    "message_issues",
    lambda m: quality.message_issue_counts(quality.check_messages(_spoiled(m), "clickstream", NOW)),
    " UNION ALL ".join(
        f"SELECT '{issue}' AS issue, count(*) AS messages FROM events WHERE event_id % {n} = 0"
        for n, issue in (
            (11, "Missing customer_id"),
            (19, "Empty session_id"),
            (23, "Invalid variant: both"),
            (29, "Invalid timestamp format"),
        )
    ),
)
register(
    "arrival_order_per_session",
    lambda m: quality.check_order(
        m.clicks.withColumn("seq", F.col("event_id").cast("long")).withColumn(
            "t", F.when(F.col("seq") % 20 == 0, F.col("event_timestamp") - F.expr("INTERVAL 12 HOURS")).otherwise(
                F.col("event_timestamp")
            )
        ),
        "session_id",
        "seq",
        "t",
    ),
    sql(
        "SELECT session_id, count(*) AS events, count(*) FILTER (t < p) AS out_of_order FROM (SELECT session_id, t, "
        "lag(t) OVER (PARTITION BY session_id ORDER BY seq) AS p FROM (SELECT session_id, seq, event_timestamp - "
        "CASE WHEN seq % 20 = 0 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS t FROM clicks)) GROUP BY 1"
    ),
)


def _stats(m):
    return quality.table_stats(
        {
            "clicks": (m.clicks, "event_timestamp"),
            "realtime_orders": (m.rt, "created_at"),
            "fct_orders": (adapters.raw_orders(m.spark, m.sf_dir, False), "order_purchase_timestamp"),
        },
        NOW,
    )


_STATS = (
    f"SELECT label AS collection, label, document_count, newest_timestamp, TIMESTAMP '{NOW}' AS measured_at FROM ("
    "SELECT 'clicks' AS label, count(*) AS document_count, max(event_timestamp) AS newest_timestamp FROM clicks UNION ALL "
    "SELECT 'realtime_orders', count(*), max(created_at) FROM rt UNION ALL "
    "SELECT 'fct_orders', count(*), max(order_purchase_timestamp) FROM raw_orders)"
)
register(
    "consumer_health",
    lambda m: quality.consumer_health(m.offsets, _stats(m)),
    sql(
        "SELECT consumer_group, measured_at, topics, total_lag, partitions, status, 'kafka' AS source, "
        "NULL AS collection, NULL AS label, NULL::BIGINT AS document_count, NULL::TIMESTAMP AS newest_timestamp "
        "FROM health UNION ALL SELECT NULL, measured_at, NULL, NULL, NULL, NULL, 'table', collection, label, "
        "document_count, newest_timestamp FROM table_rows",
        table_rows=_STATS,
    ),
)


def _health(m):
    return quality.consumer_lag(m.offsets)


register("latest_consumer_health", lambda m: quality.latest_health(_health(m)), sql("SELECT * FROM latest_health"))
register(
    "consumer_health_check",
    lambda m: quality.health_check(quality.latest_health(_health(m))),
    sql(
        "SELECT count(*) AS total_groups, count(*) FILTER (status = 'critical') AS critical_groups, "
        "count(*) FILTER (status = 'critical') = 0 AS passed FROM latest_health"
    ),
)
register(
    "lag_history",
    lambda m: quality.lag_history(_health(m)),
    sql(
        "SELECT measured_at AS timestamp, consumer_group, max(total_lag) AS total_lag FROM health WHERE measured_at >= "
        "(SELECT max(measured_at) FROM health) - INTERVAL 24 HOUR AND consumer_group IS NOT NULL GROUP BY 1, 2"
    ),
)
register(
    "hourly_throughput",
    lambda m: quality.throughput(m.metrics),
    sql(
        "SELECT date_trunc('hour', window_start) AS timestamp, "
        + ", ".join(
            r(f"coalesce({msum(f'CASE WHEN metric_name = {n!r} THEN metric_value END')}, 0)", 1) + f" AS {c}"
            for n, c in (("total_orders", "orders_stream"), ("total_clicks", "clickstream"), ("total_gmv", "deliveries_stream"))
        )
        + " FROM metrics WHERE window_start >= (SELECT max(window_start) FROM metrics) - INTERVAL 24 HOUR GROUP BY 1"
    ),
)
_CALENDAR = (
    "SELECT date, gap <= 1 AS sla_met, CAST(gap * 1440 AS INTEGER) AS duration_min, 1440 AS sla_target_min FROM "
    "(SELECT date, CAST(date - lag(date) OVER (ORDER BY date) AS INTEGER) AS gap FROM daily) WHERE gap IS NOT NULL "
    "ORDER BY date DESC LIMIT 30"
)
register("sla_calendar", lambda m: quality.sla_calendar(m.daily), sql(_CALENDAR))
register(
    "sla_days_met",
    lambda m: quality.sla_days_met(quality.sla_calendar(m.daily)),
    sql("SELECT count(*) FILTER (sla_met) AS days_met, count(*) AS days FROM cal", cal=_CALENDAR),
)
_ALERTS = (
    "SELECT created_at AS timestamp, 'Delivery SLA' AS type, alert_severity AS severity, 'Order ' || order_id || "
    "' — ' || CAST(CAST(floor(days_to_deliver) AS BIGINT) AS VARCHAR) || ' days to deliver' AS message, "
    "CASE WHEN is_late THEN 'open' ELSE 'resolved' END AS status FROM alerts ORDER BY created_at DESC, order_id LIMIT 20"
)
register("recent_alerts", lambda m: quality.recent_alerts(m.alerts), sql(_ALERTS))
register(
    "health_score",
    lambda m: quality.health_score(quality.latest_health(_health(m)), quality.recent_alerts(m.alerts)),
    sql(
        "SELECT score, healthy_consumers, total_consumers, open_alerts, CASE WHEN score >= 90 THEN 'excellent' "
        "WHEN score >= 70 THEN 'warning' ELSE 'critical' END AS status FROM (SELECT CAST(greatest(0, "
        "floor(healthy_consumers / total_consumers * 100) - open_alerts * 5) AS INTEGER) AS score, * FROM (SELECT "
        "count(*) FILTER (status = 'healthy') AS healthy_consumers, count(*) AS total_consumers, "
        f"(SELECT count(*) FILTER (status = 'open') FROM ({_ALERTS})) AS open_alerts FROM latest_health))"
    ),
)
register(
    "data_freshness",
    lambda m: quality.freshness(_stats(m), 72),
    sql(
        "SELECT label AS dataset, document_count AS row_count, newest_timestamp AS last_updated, "
        f"{r('h')} AS age_hours, 72 AS sla_hours, CASE WHEN h <= 72 THEN 'fresh' ELSE 'stale' END AS status FROM "
        "(SELECT *, (epoch_us(measured_at) - epoch_us(newest_timestamp)) / 3600000000 AS h FROM table_rows)",
        table_rows=_STATS,
    ),
)


def _growth(m):
    before = quality.table_stats(
        {"clicks": (m.clicks.where(F.col("event_timestamp") < "2024-01-20"), "event_timestamp"), "fct_orders": (adapters.raw_orders(m.spark, m.sf_dir, False), "order_purchase_timestamp")},
        NOW,
    )
    return quality.growth(_stats(m), before)


register(
    "table_growth",
    _growth,
    sql(
        "SELECT label, document_count, document_count - n AS new_rows, document_count > n AS changed FROM (SELECT label, "
        "document_count, CASE label WHEN 'clicks' THEN (SELECT count(*) FROM clicks WHERE event_timestamp < "
        "TIMESTAMP '2024-01-20') WHEN 'fct_orders' THEN document_count ELSE 0 END AS n FROM table_rows)",
        table_rows=_STATS,
    ),
)


def _anomalies(m):
    """Anomalies of the daily mart; the tables have few orders a day, so every day counts as busy."""
    return quality.anomaly_scan(
        m.daily_table, m.scores_only, adapters.raw_orders(m.spark, m.sf_dir, False), _stats(m), min_orders=0
    )


_MONTH = "(ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
_ANOMALY = sql(
    f"SELECT 'Daily GMV' AS metric, CASE WHEN abs(z) > 3 THEN 'critical' ELSE 'warning' END AS severity, {r('v')} AS value, "
    f"{r('e')} AS expected, {r('z')} AS score, date FROM (SELECT date, v, e, (v - e) / CASE WHEN coalesce(sd, 0) = 0 "
    f"THEN 1 ELSE sd END AS z FROM (SELECT date, total_gmv AS v, {r(f'sum(total_gmv) OVER {_MONTH}', 4)} / "
    f"count(total_gmv) OVER {_MONTH} AS e, stddev_samp(total_gmv) OVER {_MONTH} AS sd FROM daily) "
    "ORDER BY date DESC LIMIT 1) WHERE e > 0 AND abs(z) > 2 UNION ALL "
    f"SELECT 'Cancellation Rate', 'warning', {r('v')}, {r('e')}, {r('v / e')}, date FROM (SELECT date, v, "
    f"{r(f'sum(v) OVER {_MONTH}', 8)} / count(v) OVER {_MONTH} AS e FROM (SELECT date, orders_canceled / total_orders * 100 AS v "
    "FROM daily WHERE total_orders > 0) ORDER BY date DESC LIMIT 1) WHERE e > 0 AND v > e * 1.5::DOUBLE "
    f"UNION ALL SELECT 'Delivery Time', 'warning', {r('v')}, {r('e')}, {r('v / e')}, date FROM (SELECT date, v, "
    f"{r(f'sum(v) OVER {_MONTH}', 8)} / count(v) OVER {_MONTH} AS e FROM (SELECT date, avg_delivery_time_days AS v "
    "FROM daily WHERE avg_delivery_time_days > 0) ORDER BY date DESC LIMIT 1) WHERE e > 0 AND v > e * 1.3::DOUBLE "
    f"UNION ALL SELECT 'Review Score', 'warning', {r('coalesce(v, 0)')}, {r('e')}, {r('coalesce(v, 0) / e')}, NULL FROM "
    "(SELECT avg(review_score) AS e, avg(review_score) FILTER (order_id IN (SELECT order_id FROM raw_orders WHERE "
    "order_purchase_timestamp >= (SELECT CAST(max(order_purchase_timestamp) AS DATE) - 7 FROM raw_orders))) AS v "
    "FROM raw_reviews) WHERE e > 0 AND coalesce(v, 0) < e * 0.9::DOUBLE UNION ALL "
    f"SELECT 'Data Freshness: ' || label, CASE WHEN h > 48 THEN 'critical' ELSE 'warning' END, {r('h')}, 24.0::DOUBLE, "
    f"{r('h / 24.0::DOUBLE')}, CAST(newest_timestamp AS DATE) FROM (SELECT *, (epoch_us(measured_at) - "
    "epoch_us(newest_timestamp)) / 3600000000 AS h FROM table_rows) WHERE h > 24",
    table_rows=_STATS,
)
register("anomaly_scan", _anomalies, _ANOMALY)


def _widened(m):
    """The schema of a table with its row count, so the listing reflects what is there."""
    return quality.describe(m.raw_items).withColumn("row_count", m.raw_items.agg(F.count(F.lit(1))).scalar())


register(
    "table_schema",
    _widened,
    "SELECT *, (SELECT count(*) FROM lineitem) AS row_count FROM (VALUES "
    + ", ".join(
        f"({i}, '{n}', '{t}', true)"
        for i, (n, t) in enumerate(
            [
                ("order_id", "string"),
                ("order_item_id", "int"),
                ("product_id", "string"),
                ("seller_id", "string"),
                ("shipping_limit_date", "timestamp"),
                ("price", "double"),
                ("freight_value", "double"),
            ],
            1,
        )
    )
    + ") AS t(position, column_name, data_type, is_nullable)",
)
register(
    "layer_accuracy",
    lambda m: quality.layer_accuracy(m.raw_orders, m.raw_items, m.raw_customers),
    sql(
        "SELECT 'orders' AS table_name, 'ordered:order_purchase_timestamp<=order_delivered_customer_date' AS check_name, "
        "'error' AS severity, v <= n * 0.01::DOUBLE AS passed, v AS violations, n AS total FROM (SELECT count(*) FILTER "
        "(order_delivered_customer_date < order_purchase_timestamp) AS v, count(*) AS n FROM raw_orders "
        "WHERE order_delivered_customer_date IS NOT NULL) UNION ALL "
        + _check_rows(
            ("orders", "unique:order_id", "error", _NONE, "orders"),
            ("orders", "has_rows", "warning", _NONE, "orders"),
            ("order_items", "non_negative:price", "error", _NONE, "lineitem"),
            ("order_items", "has_rows", "warning", _NONE, "lineitem"),
            ("customers", "unique:customer_id", "error", _NONE, "customer"),
            ("customers", "has_rows", "warning", _NONE, "customer"),
        )
    ),
)
_REVIEW_COLUMNS = [
    "review_id",
    "order_id",
    "review_score",
    "review_creation_date",
    "review_answer_timestamp",
    "review_comment_title",
    "review_comment_message",
]
register(
    "review_profile",
    lambda m: quality.profile(m.raw_reviews, "review_id"),
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count, "
            f"{pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)')} AS null_pct, count(*) - count(DISTINCT review_id) "
            "AS duplicate_keys FROM raw_reviews"
            for c in _REVIEW_COLUMNS
        )
    ),
)
register(
    "orphan_order_items",
    lambda m: quality.orphans(m.raw_items, adapters.raw_orders(m.spark, m.sf_dir, False), "order_id"),
    sql(
        "SELECT count(DISTINCT order_id) AS orphan_keys, count(*) AS orphan_rows FROM raw_items WHERE order_id NOT IN "
        "(SELECT order_id FROM raw_orders)"
    ),
)
