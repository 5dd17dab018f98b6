"""Live views, stream operators on static frames, running stream queries, serving layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from agorakit.functions import fixed
from agorakit.operators import realtime, serving
from agorakit.plans.oracle import arm, mavg, msum, pct, r, sql
from agorakit.plans.registry import register
from agorakit.session import shared_dir
from agorakit.sources import adapters, sinks, topics
from agorakit.streaming import messages, operators as streams, runtime, timers

NOW = "2024-01-31 00:00:00"
DAY = "2024-01-15"

# --- live views ------------------------------------------------------------------------------------------------

_LATEST = "(SELECT CAST(max(event_timestamp) AS DATE) FROM rt)"
_ON = "CAST(event_timestamp AS DATE) = " + _LATEST
_BEFORE = f"CAST(event_timestamp AS DATE) = {_LATEST} - 1"


def _change(a: str, b: str) -> str:
    return f"coalesce({r(f'({a} - {b}) / nullif({b}, 0) * 100', 1)}, 0)"


register(
    "live_kpis",
    lambda m: realtime.rt_kpis(m.rt),
    sql(
        "SELECT gmv AS total_gmv, n AS total_orders, aov AS avg_order_value, last_event, "
        f"{r('n / 1440')} AS orders_per_minute, coalesce({pct('canceled', 'n')}, 0) AS cancel_rate, "
        f"{_change('gmv', 'y_gmv')} AS gmv_vs_yesterday, {_change('n', 'y_n')} AS orders_vs_yesterday FROM "
        f"(SELECT {msum('order_total')} AS gmv, count(DISTINCT order_id) AS n, {mavg('order_total')} AS aov, "
        "max(event_timestamp) AS last_event, count(*) FILTER (event_type = 'order_canceled') AS canceled FROM rt "
        f"WHERE {_ON}), (SELECT {msum('order_total')} AS y_gmv, count(DISTINCT order_id) AS y_n FROM rt WHERE {_BEFORE})"
    ),
)
register(
    "live_sparkline",
    lambda m: realtime.rt_sparkline(m.rt),
    sql(
        f"SELECT CAST(event_timestamp AS DATE) AS d, {msum('order_total')} AS gmv, count(DISTINCT order_id) AS orders, "
        f"{r(mavg('order_total'))} AS aov FROM rt WHERE CAST(event_timestamp AS DATE) >= {_LATEST} - 23 GROUP BY 1"
    ),
)
_HOURLY = (
    "SELECT date_trunc('hour', event_timestamp) AS ts, count(DISTINCT order_id) AS n, "
    f"{msum('order_total')} AS gmv FROM rt WHERE {{}} GROUP BY 1"
)
register(
    "live_timeseries",
    lambda m: realtime.rt_timeseries(m.rt),
    sql(
        "SELECT t.ts AS timestamp, t.n AS orders, t.gmv, coalesce(y.n, 0) AS orders_yesterday, "
        f"coalesce(y.gmv, 0) AS gmv_yesterday FROM ({_HOURLY.format(_ON)}) t LEFT JOIN ({_HOURLY.format(_BEFORE)}) y "
        "ON hour(t.ts) = hour(y.ts)"
    ),
)
register(
    "live_orders_by_state",
    lambda m: realtime.rt_by_state(m.rt),
    sql(
        f"SELECT *, {r('revenue / ' + r('sum(revenue) OVER ()', 4) + ' * 100', 1)} AS share_pct FROM (SELECT "
        f"customer_state AS state, count(DISTINCT order_id) AS orders, {msum('order_total')} AS revenue FROM rt "
        f"WHERE {_ON} AND customer_state IS NOT NULL GROUP BY 1 ORDER BY revenue DESC, state LIMIT 15)"
    ),
)
register(
    "live_orders_by_status",
    lambda m: realtime.rt_by_status(m.rt),
    sql(f"SELECT event_type AS status, count(*) AS count FROM rt WHERE {_ON} GROUP BY 1"),
)
register(
    "live_recent_orders",
    lambda m: realtime.rt_recent(m.rt),
    sql(
        "SELECT order_id, customer_id, customer_state, order_total, event_type, event_timestamp FROM rt "
        "ORDER BY event_timestamp DESC, order_id LIMIT 15"
    ),
)
register(
    "cancellation_trend",
    lambda m: realtime.cancellation_trend(m.rt),
    sql(
        "SELECT date_trunc('hour', event_timestamp) AS timestamp, "
        + pct("count(*) FILTER (event_type = 'order_canceled')", "count(*)")
        + " AS rate FROM rt GROUP BY 1 ORDER BY 1 DESC LIMIT 48"
    ),
)
register(
    "orders_last_24_hours",
    lambda m: realtime.last_hours(m.rt.drop("event_id"), NOW),
    sql(f"SELECT * FROM rt WHERE event_timestamp >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR"),
)
register(
    "gmv_per_window",
    lambda m: realtime.gmv_5min(m.metrics, NOW),
    sql(
        "SELECT window_start, metric_value AS gmv FROM metrics WHERE metric_name = 'total_gmv' "
        f"AND window_start >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR"
    ),
)
register(
    "stream_orders_of_day",
    lambda m: realtime.stream_today(m.rt, DAY),
    sql(
        f"SELECT count(*) AS orders_today, {msum('order_total')} AS gmv_today, {mavg('order_total')} AS avg_order_value, "
        f"count(DISTINCT customer_id) AS unique_customers FROM rt WHERE CAST(event_timestamp AS DATE) = DATE '{DAY}'"
    ),
)
register(
    "metric_series",
    lambda m: realtime.metric_series(m.metrics, "total_orders", DAY),
    sql(
        "SELECT window_start, window_end, metric_value FROM metrics WHERE metric_name = 'total_orders' "
        f"AND window_start >= TIMESTAMP '{DAY}'"
    ),
)
register(
    "sla_violations",
    lambda m: realtime.sla_violations(m.alerts, "1997-01-01"),
    sql(
        f"SELECT CAST(created_at AS DATE) AS alert_date, count(*) AS total_alerts, {msum('days_to_deliver')} / count(*) "
        "AS avg_late_days, count(DISTINCT seller_id) AS sellers_affected FROM alerts "
        "WHERE is_late AND created_at >= TIMESTAMP '1997-01-01' GROUP BY 1"
    ),
)

# --- stream operators on static frames -------------------------------------------------------------------------


def _order_messages(m):
    """Order messages of customers; the lookup may not know all of them."""
    return adapters.order_messages_of(m.events)


def _lookup(m):
    return m.dim_customers.select(
        "customer_id",
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
        "customer_tier",
    )


_KNOWN = (
    "SELECT customer_id, customer_city AS city, upper(customer_state) AS st, CASE WHEN coalesce(n, 0) > 10 THEN 'vip' "
    "WHEN coalesce(n, 0) >= 2 THEN 'regular' ELSE 'new' END AS tier FROM raw_customers LEFT JOIN (SELECT customer_id, "
    "count(*) AS n FROM stg_orders WHERE order_status = 'delivered' GROUP BY 1) USING (customer_id)"
)
_OPERATIONAL = sql(
    "SELECT order_id, m.customer_id, coalesce(city, 'unknown') AS customer_city, coalesce(st, 'unknown') "
    "AS customer_state, order_total, string_split(event_type, '_')[2] AS order_status, event_type, "
    "'exp_001' AS experiment_id, variant, event_timestamp, k.customer_id IS NULL AS needs_enrichment "
    "FROM order_messages m LEFT JOIN known k ON k.customer_id = m.customer_id",
    known=_KNOWN,
)
register(
    "enriched_orders_operational",
    lambda m: streams.enrich_orders(_order_messages(m), _lookup(m))[0].drop("processing_timestamp"),
    _OPERATIONAL,
)
register(
    "enriched_orders_analytic",
    lambda m: streams.enrich_orders(_order_messages(m), _lookup(m))[1].drop("processed_at"),
    sql(
        "SELECT order_id, m.customer_id, st AS customer_state, tier AS customer_tier, order_total, "
        "string_split(event_type, '_')[2] AS order_status, event_type, 'exp_001' AS experiment_id, variant, "
        "event_timestamp FROM order_messages m LEFT JOIN known k ON k.customer_id = m.customer_id",
        known=_KNOWN,
    ),
)
register("window_metrics", lambda m: m.metrics, sql("SELECT * FROM metrics"))
register("experiment_counters", lambda m: m.counters, sql("SELECT * FROM counters"))
register(
    "live_significance",
    lambda m: streams.live_significance(m.counters, 100),
    sql(
        "SELECT experiment_id, rate_control, rate_treatment, z, abs(z) > 1.96 AS significant, "
        "CASE WHEN z > 1.96 THEN 'treatment' WHEN z < -1.96 THEN 'control' END AS winner FROM (SELECT experiment_id, "
        "xc / nc AS rate_control, xt / nt AS rate_treatment, coalesce((xt / nt - xc / nc) / CASE WHEN p * (1 - p) * "
        "(1.0::DOUBLE / nc + 1.0::DOUBLE / nt) > 0 THEN sqrt(p * (1 - p) * (1.0::DOUBLE / nc + 1.0::DOUBLE / nt)) END, "
        "0) AS z FROM (SELECT *, (xc + xt) / (nc + nt) AS p FROM (SELECT experiment_id, "
        + ", ".join(
            f"max({c}) FILTER (variant = '{v}') AS {n}{v[0]}"
            for v in fixed.VARIANTS
            for c, n in (("impressions", "n"), ("conversions", "x"))
        )
        + " FROM counters GROUP BY 1) WHERE nc >= 100 AND nt >= 100))"
    ),
)
register("delivery_alerts", lambda m: m.alerts, sql("SELECT * FROM alerts"))


def _dead_letters(m):
    """Order messages that fail validation: every 13th has no customer, every 17th is empty."""
    n = F.col("order_id").cast("long")
    sent = adapters.order_messages_of(m.events).select(
        F.when(n % 17 == 0, "{}")
        .otherwise(
            F.to_json(
                F.struct(
                    "order_id",
                    F.when(n % 13 != 0, F.col("customer_id")).alias("customer_id"),
                    "event_type",
                    "order_total",
                )
            )
        )
        .alias("value")
    )
    parsed = topics.parse_messages(sent, "order_id string, customer_id string, event_type string, order_total double")
    return messages.validate(parsed, ["order_id", "customer_id"], "order_processor")


register(
    "dead_letter_counts",
    lambda m: _dead_letters(m)[1].groupBy("error_reason", "consumer").agg(F.count(F.lit(1)).alias("messages")),
    "SELECT CASE WHEN event_id % 17 = 0 THEN 'Message must be a non-empty dict' ELSE 'Missing customer_id' END "
    "AS error_reason, 'order_processor' AS consumer, count(*) AS messages FROM events "
    "WHERE event_id % 17 = 0 OR event_id % 13 = 0 GROUP BY 1",
)
register(
    "validated_orders",
    lambda m: _dead_letters(m)[0].drop("_raw"),
    sql(
        "SELECT order_id, customer_id, event_type, order_total FROM order_messages "
        "WHERE CAST(order_id AS BIGINT) % 17 <> 0 AND CAST(order_id AS BIGINT) % 13 <> 0"
    ),
)
register(
    "replayed_orders",
    lambda m: messages.replayed(messages.order_events(m.raw_orders, m.raw_items), "2024-01-01 00:00:00").select(
        "order_id", "event_time", F.date_trunc("second", "replay_at").alias("replay_at")
    ),
    sql(
        "SELECT order_id, t AS event_time, date_trunc('second', TIMESTAMP '2024-01-01' + to_microseconds(CAST(floor("
        "(epoch_us(t) - epoch_us(a)) * (172800000000.0::DOUBLE / (epoch_us(b) - epoch_us(a))) + 0.5) AS BIGINT))) "
        "AS replay_at FROM (SELECT order_id, order_purchase_timestamp AS t, min(order_purchase_timestamp) OVER () AS a, "
        "max(order_purchase_timestamp) OVER () AS b FROM raw_orders)"
    ),
)
register(
    "order_events",
    lambda m: messages.order_events(m.raw_orders, m.raw_items),
    sql(
        "SELECT 'order_' || order_status AS event_type, o.order_id, customer_id, "
        f"coalesce({r('t')}, 0) AS order_total, order_status, 'exp_001' AS experiment_id, "
        f"{arm('customer_id', repr('exp_001'))} AS variant, order_purchase_timestamp AS event_time FROM raw_orders o "
        "LEFT JOIN (SELECT order_id, sum(price) AS t FROM raw_items GROUP BY 1) USING (order_id)"
    ),
)
register(
    "payment_events",
    lambda m: messages.payment_events(m.stg_payments, m.raw_orders),
    sql(
        "SELECT 'payment_completed' AS event_type, order_id, payment_type, payment_value, payment_installments, "
        "order_purchase_timestamp + INTERVAL 60 SECOND AS event_time FROM raw_payments JOIN raw_orders USING (order_id)"
    ),
)
_STEPS = {
    "shipped": "order_purchase_timestamp + INTERVAL 2 DAY",
    "in_transit": "order_purchase_timestamp + INTERVAL 4 DAY",
    "out_for_delivery": "done - INTERVAL 1 DAY",
    "delivered": "done",
}
register(
    "delivery_events",
    lambda m: messages.delivery_events(m.raw_orders),
    sql(
        " UNION ALL ".join(
            f"SELECT '{k}' AS event_type, order_id, {t} AS event_time FROM done_orders" for k, t in _STEPS.items()
        ),
        done_orders="SELECT *, coalesce(order_delivered_customer_date, order_purchase_timestamp + INTERVAL 10 DAY) "
        "AS done FROM raw_orders",
    ),
)
register(
    "review_events",
    lambda m: messages.review_events(m.raw_reviews, m.raw_items),
    sql(
        "SELECT 'review_posted' AS event_type, review_id, order_id, coalesce(product_id, order_id) AS product_id, "
        "review_score, review_creation_date AS event_time FROM raw_reviews LEFT JOIN (SELECT order_id, product_id FROM "
        "raw_items QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, product_id) = 1) "
        "USING (order_id)"
    ),
)

# --- stream queries that run: read the event files as a stream, write to the shared folder, read back ------------


def _event_stream(m):
    return topics.read_parquet_stream(m.spark, f"{m.sf_dir}/events.parquet")


def _run_counters(m):
    """Running counters in update mode, upserted by (experiment, variant)."""
    path = shared_dir(m.spark, "counters")
    running = streams.experiment_counters(adapters.stream_messages(_event_stream(m)))
    query = runtime.start_upsert(
        running, f"{path}/table", f"{path}/checkpoint", ["experiment_id", "variant"], ["impressions", "clicks", "conversions"]
    )
    query.awaitTermination()
    return sinks.read_upserted(m.spark, f"{path}/table")


register("experiment_counters_streamed", _run_counters, sql("SELECT * FROM counters"))


def _run_latest_orders(m):
    """Latest message per customer, upserted from the order stream."""
    path = shared_dir(m.spark, "latest")
    orders = adapters.order_messages_of(_event_stream(m)).select(
        "customer_id", "event_timestamp", "order_id", "event_type", "order_total"
    )
    query = runtime.start_upsert(
        orders, f"{path}/table", f"{path}/checkpoint", ["customer_id"], ["event_timestamp", "order_id"], mode="append"
    )
    query.awaitTermination()
    return sinks.read_upserted(m.spark, f"{path}/table")


register(
    "latest_order_upserted",
    _run_latest_orders,
    sql(
        "SELECT customer_id, event_timestamp, order_id, event_type, order_total FROM order_messages QUALIFY "
        "row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp DESC, order_id DESC) = 1"
    ),
)


def _run_windows(m):
    """Windows of the event table replayed as a stream: partial sums of every batch, added up on reading."""
    path = shared_dir(m.spark, "windows")
    events = adapters.stream_messages(_event_stream(m))
    runtime.start_partials(events, f"{path}/table", f"{path}/checkpoint", streams.window_partials).awaitTermination()
    partials = m.spark.read.schema(streams.window_partials(adapters.stream_messages(m.events)).schema).parquet(f"{path}/table")
    return streams.window_totals(streams.combined_partials(partials))


register("window_metrics_streamed", _run_windows, sql("SELECT * FROM metrics"))


def _run_enrichment(m):
    """Order messages as a stream, enriched batch by batch from the customer dimension kept as an upserted table."""
    path = shared_dir(m.spark, "enriched")
    sinks.upsert(f"{path}/customers", _lookup(m), ["customer_id"], ["customer_tier"])
    orders = adapters.order_messages_of(_event_stream(m))
    query = (
        orders.writeStream.foreachBatch(
            runtime.enrich_sink(path, lambda ids: sinks.read_upserted(ids.sparkSession, f"{path}/customers", ids))
        )
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = streams.enrich_orders(_order_messages(m), _lookup(m))[0].schema
    return m.spark.read.schema(schema).parquet(f"{path}/operational").drop("processing_timestamp", "batch_id")


register("enriched_orders_streamed", _run_enrichment, _OPERATIONAL)


def _run_alerts(m):
    """Delivery events of all orders, in files of no order of time, through the monitor with timers; the closed alerts."""
    path = shared_dir(m.spark, "late_orders")
    steps = m.deliveries.where(F.col("event_type").isin("shipped", "delivered"))
    steps.repartition(int(m.spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("order_id", "event_type")).write.parquet(f"{path}/events")
    changes = timers.late_orders(topics.read_parquet_stream(m.spark, f"{path}/events"))
    with timers.timer_state(m.spark):
        query = runtime.start_upsert(changes, f"{path}/table", f"{path}/checkpoint", ["order_id"], ["revision"])
    query.awaitTermination()
    return sinks.read_upserted(m.spark, f"{path}/table").where("is_late AND delivered_at IS NOT NULL").drop("revision")


register("delivery_alerts_streamed", _run_alerts, sql("SELECT * FROM alerts"))


# --- serving layer ---------------------------------------------------------------------------------------------

_UNION = (
    "SELECT order_id, d AS order_date, order_status, order_total, customer_id, customer_state, "
    "'batch' AS _source_layer, order_purchase_timestamp AS _timestamp FROM wide UNION ALL "
    "SELECT order_id, CAST(event_timestamp AS DATE), event_type, order_total, customer_id, customer_state, 'stream', "
    "event_timestamp FROM rt"
)
_WINS = (
    "SELECT * FROM both_layers QUALIFY row_number() OVER (PARTITION BY order_id "
    "ORDER BY _source_layer DESC, _timestamp DESC) = 1"
)
register("unified_orders_union", lambda m: serving.unified_orders(m.wide, m.rt), sql(_UNION))
register(
    "unified_orders_stream_wins",
    lambda m: serving.unified_orders(m.wide, m.rt, "stream_wins"),
    sql(_WINS, both_layers=_UNION),
)
register(
    "unified_orders_boundary",
    lambda m: serving.unified_orders(m.wide, m.rt, "boundary", "2000-01-01"),
    sql(
        "SELECT * FROM both_layers WHERE (_source_layer = 'batch') = (order_date < DATE '2000-01-01')",
        both_layers=_UNION,
    ),
)
_WINDOW_AOV = f"coalesce({r('gmv / nullif(orders, 0)')}, 0)"
_STREAM_DAILY = (
    "SELECT CAST(window_start AS DATE) AS metric_date, CAST(sum(orders) AS BIGINT) AS total_orders, "
    f"{r('sum(gmv)', 4)} AS total_gmv, {r(f'sum({_WINDOW_AOV})', 4)} / count(*) "
    "AS avg_order_value, CAST(sum(sessions) AS BIGINT) AS unique_customers, NULL::DOUBLE AS late_delivery_rate, "
    "'stream' AS _source_layer FROM windows GROUP BY 1"
)
_UNIFIED_DAILY = (
    "SELECT date AS metric_date, total_orders, total_gmv, avg_order_value, unique_customers, late_delivery_rate, "
    f"'batch' AS _source_layer FROM daily UNION ALL {_STREAM_DAILY}"
)
register("unified_daily_metrics", lambda m: serving.unified_daily(m.daily, m.metrics), sql(_UNIFIED_DAILY))
register(
    "unified_grains",
    lambda m: serving.unified_grains(m.results.select("experiment_id", "variant", "total_revenue"), m.metrics, "result"),
    sql(
        "SELECT experiment_id, variant, total_revenue, NULL::TIMESTAMP AS window_start, NULL::TIMESTAMP AS window_end, "
        "NULL AS metric_name, NULL::DOUBLE AS metric_value, 'batch' AS _source, 'result' AS _grain FROM results "
        "UNION ALL SELECT NULL, NULL, NULL, window_start, window_end, metric_name, metric_value, 'stream', '5min_window' "
        "FROM metrics"
    ),
)
register(
    "unified_experiments_stream_wins",
    lambda m: serving.unified_experiments(m.results, m.counters),
    sql(
        "SELECT experiment_id, experiment_name, variant, unique_users, total_orders, converting_users, conversion_rate, "
        "total_revenue, avg_order_value, revenue_per_user, 'batch' AS _source, NULL::BIGINT AS impressions, "
        "NULL::BIGINT AS clicks, NULL::BIGINT AS conversions, NULL::DOUBLE AS revenue FROM results "
        "WHERE (experiment_id, variant) NOT IN (SELECT (experiment_id, variant) FROM counters) UNION ALL "
        "SELECT experiment_id, NULL, variant, NULL, NULL, NULL, conversion_rate, NULL, NULL, NULL, 'stream', impressions, "
        "clicks, conversions, revenue FROM counters"
    ),
)
register(
    "unified_experiments_side_by_side",
    lambda m: serving.unified_experiments(m.results, m.counters, "side_by_side"),
    sql(
        "SELECT experiment_id, variant, c.impressions AS live_impressions, c.conversions AS live_conversions, "
        "c.conversion_rate AS live_conversion_rate, b.total_orders AS batch_total_orders, "
        "b.conversion_rate AS batch_conversion_rate, CASE WHEN c.impressions IS NOT NULL THEN 'stream' ELSE 'batch' END "
        "AS _primary_source FROM counters c FULL JOIN results b USING (experiment_id, variant)"
    ),
)
_RECON = sql(
    "SELECT 'stream_only' AS category, count(*) AS order_count, "
    "coalesce((SELECT string_agg(id, ', ' ORDER BY id) FROM (SELECT id FROM ids WHERE b = 0 ORDER BY id LIMIT 5)), '') "
    "AS sample_ids FROM ids WHERE b = 0 UNION ALL SELECT 'batch_only', count(*), '' FROM ids WHERE s = 0 UNION ALL "
    "SELECT 'overlap', count(*), coalesce((SELECT string_agg(id, ', ' ORDER BY id) FROM (SELECT id FROM ids "
    "WHERE b = 1 AND s = 1 ORDER BY id LIMIT 5)), '') FROM ids WHERE b = 1 AND s = 1 UNION ALL "
    "SELECT 'totals', count(*), 'batch=' || CAST(sum(b) AS BIGINT) || ' stream=' || CAST(sum(s) AS BIGINT) || "
    "' union=' || count(*) FROM ids",
    ids="SELECT id, max(b) AS b, max(s) AS s FROM (SELECT order_id AS id, 1 AS b, 0 AS s FROM raw_orders "
    "UNION ALL SELECT order_id, 0, 1 FROM rt) GROUP BY id",
)


def _reconcile(m):
    batch = adapters.raw_orders(m.spark, m.sf_dir, False)
    return serving.reconcile(batch, m.rt)


register("batch_stream_reconciliation", _reconcile, _RECON)
register(
    "layer_totals",
    lambda m: serving.layer_totals(serving.unified_orders(m.wide, m.rt)),
    sql(
        f"SELECT _source_layer, count(*) AS cnt, {r(msum('order_total'))} AS gmv FROM both_layers GROUP BY 1",
        both_layers=_UNION,
    ),
)
register(
    "unified_last_30_days",
    lambda m: serving.unified_recent(serving.unified_orders(m.wide, m.rt), "2001-08-01"),
    sql(
        f"SELECT order_date, _source_layer, count(*) AS orders, {msum('order_total')} AS revenue FROM both_layers "
        "WHERE order_date >= DATE '2001-08-01' - 30 GROUP BY 1, 2",
        both_layers=_UNION,
    ),
)

