"""SQL twins of the model's tables, as common table expressions.

``sql(final, *names)`` puts the named expressions and all they build on in front
of a final SELECT.
"""

from __future__ import annotations

import re

from agorakit.functions import fixed
from agorakit.sources.adapters import CATEGORY_OF_TYPE, STATE_CODES


def r(expr: str, digits: int = 2) -> str:
    """Half-up rounding in double arithmetic."""
    scale = 10**digits
    return f"(floor(({expr})::DOUBLE * {scale}::DOUBLE + 0.5::DOUBLE) / {scale}::DOUBLE)"


def msum(expr: str, digits: int = 4) -> str:
    return r(f"sum({expr})", digits)


def p_norm(z: str) -> str:
    """P(|N(0,1)| > |z|) by the positive series of the error function; absolute error below 1e-13."""
    x = f"greatest(abs({z}) / sqrt(2.0::DOUBLE), 1e-150::DOUBLE)"
    term = "exp(2 * n * ln(2.0::DOUBLE) + (2 * n + 1) * ln(x) + lgamma(n + 1) - lgamma(2 * n + 2))"
    series = f"list_sum(list_transform(range(0, 250), lambda n: {term.replace('ln(x)', f'ln({x})')}))"
    return (
        f"(CASE WHEN ({z}) IS NULL THEN NULL WHEN abs({z}) > 8 THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, 1 - 2 / sqrt(pi()) * "
        f"exp(-{x} * {x}) * {series}) END)"
    )


def p_student(t: str, df: str) -> str:
    """Two-sided tail of Student's t by the positive series of the incomplete beta function."""
    y = f"greatest(({t}) * ({t}) / (({df}) + ({t}) * ({t})), 1e-300::DOUBLE)"
    b = f"(({df}) / 2)"
    front = f"exp(0.5 * ln({y}) + {b} * ln(1 - {y}) + lgamma(0.5::DOUBLE + {b}) - lgamma(0.5::DOUBLE) - lgamma({b})) / 0.5"
    term = f"exp(n * ln({y}) + lgamma(0.5::DOUBLE + {b} + n) - lgamma(0.5::DOUBLE + {b}) + lgamma(1.5::DOUBLE) - lgamma(1.5::DOUBLE + n))"
    return f"greatest(0.0::DOUBLE, 1 - {front} * list_sum(list_transform(range(0, 400), lambda n: {term})))"


def p_fisher(a: str, b: str, c: str, d: str) -> str:
    """Two-sided exact test of a 2x2 table of whole numbers: all tables not likelier than the observed."""
    choose = lambda n, k: f"(lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - ({k}) + 1))"
    pmf = lambda k: f"exp({choose(f'({a} + {b})', k)} + {choose(f'({c} + {d})', f'({a} + {c} - ({k}))')} - {choose(f'({a} + {b} + {c} + {d})', f'({a} + {c})')})"
    low, high = f"greatest(0, {a} + {c} - ({c} + {d}))", f"least({a} + {b}, {a} + {c})"
    all_p = f"list_transform(range(({low})::BIGINT, ({high})::BIGINT + 1), lambda k: {pmf('k')})"
    return f"least(1.0::DOUBLE, list_sum(list_filter({all_p}, lambda q: q <= {pmf(a)} * (1 + 1e-7::DOUBLE))))"


def mavg(expr: str, digits: int = 4) -> str:
    return f"({msum(expr, digits)} / nullif(count({expr}), 0))"


def pct(num: str, den: str, digits: int = 2) -> str:
    return r(f"({num}) / nullif(({den})::DOUBLE, 0) * 100", digits)


def days(end: str, start: str) -> str:
    return f"CAST(floor((epoch_us({end}) - epoch_us({start})) / 86400000000) AS INTEGER)"


def key(prefix: str, *parts: str) -> str:
    text = " || '|' || ".join(f"trim(CAST({p} AS VARCHAR))" for p in parts)
    return f"'{prefix}' || substr(sha256({text}), 1, 16)"


def case(column: str, table: dict[str, str], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {default} END"


def arm(customer: str, experiment: str) -> str:
    return (
        f"CASE WHEN right(sha256({customer} || '|' || {experiment}), 1) IN ('0','2','4','6','8','a','c','e') "
        "THEN 'control' ELSE 'treatment' END"
    )


def hash_mod(text: str, modulus: int = 10_000) -> str:
    chunks = [
        f"(('0x' || substr(sha256({text}), {i * 8 + 1}, 8))::BIGINT % {modulus}) * {pow(2**32, 7 - i, modulus)}"
        for i in range(8)
    ]
    return f"(({' + '.join(chunks)}) % {modulus})"


def state(nation: str) -> str:
    codes = ", ".join(f"'{s}'" for s in STATE_CODES)
    return f"([{codes}])[{nation} + 1]"


def bucket(value: str, edges: list[float], labels: list[str], op: str = "<=") -> str:
    whens = " ".join(f"WHEN {value} {op} {e} THEN '{label}'" for e, label in zip(edges, labels))
    return f"CASE WHEN {value} IS NULL THEN NULL {whens} ELSE '{labels[-1]}' END"


SENTIMENT = "CASE WHEN review_score >= 4 THEN 'positive' WHEN review_score = 3 THEN 'neutral' ELSE 'negative' END"
TIER = "CASE WHEN {0} >= 4.5 THEN 'top' WHEN {0} >= 4 THEN 'good' WHEN {0} >= 3 THEN 'average' ELSE 'poor' END"
STATUS_CATEGORY = (
    "CASE WHEN order_status = 'delivered' THEN 'completed' "
    "WHEN order_status IN ('shipped','processing','approved','invoiced') THEN 'in_progress' "
    "WHEN order_status IN ('canceled','unavailable') THEN 'canceled' ELSE 'other' END"
)

CTES: dict[str, str] = {
    "raw_orders": """
        SELECT *, CASE WHEN k % 500 <> 0 THEN order_purchase_timestamp + to_seconds((k % 7 - 1) * 3600) END
                   AS order_approved_at,
               CASE WHEN st IN ('F', 'O') THEN order_purchase_timestamp + INTERVAL 2 DAY END
                   AS order_delivered_carrier_date
        FROM (
            SELECT o_orderkey AS k, o_orderstatus AS st, CAST(o_orderkey AS VARCHAR) AS order_id,
                   CAST(o_custkey AS VARCHAR) AS customer_id,
                   CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE
                       CASE o_orderpriority WHEN '5-LOW' THEN 'canceled' WHEN '4-NOT SPECIFIED' THEN 'created'
                       ELSE 'processing' END END AS order_status,
                   o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS order_purchase_timestamp,
                   CASE WHEN o_orderstatus = 'F' THEN last_ship END AS order_delivered_customer_date,
                   o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
            FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey)
                ON l_orderkey = o_orderkey)""",
    "raw_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               l_extendedprice * l_tax AS freight_value, l_extendedprice + l_extendedprice * l_tax AS item_total
        FROM lineitem""",
    "raw_payments": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 1 AS payment_sequential,
               CASE o_orderpriority WHEN '2-HIGH' THEN 'boleto' WHEN '3-MEDIUM' THEN 'voucher'
                   WHEN '4-NOT SPECIFIED' THEN 'debit_card' ELSE 'credit_card' END AS payment_type,
               CAST(o_orderkey % 10 + 1 AS INTEGER) AS payment_installments, o_totalprice AS payment_value
        FROM orders
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), 2, 'voucher', 1, 10.0::DOUBLE FROM orders WHERE o_orderkey % 7 = 0""",
    "raw_reviews": """
        SELECT *, CASE WHEN d % 11 <> 0 THEN review_creation_date + to_seconds(d % 100 * 1800) END
                   AS review_answer_timestamp
        FROM (
            SELECT d.doc_id AS d, 'r' || CAST(d.doc_id - CASE WHEN d.doc_id % 97 = 1 THEN 1 ELSE 0 END AS VARCHAR)
                       AS review_id,
                   CAST(d.doc_id AS VARCHAR) AS order_id,
                   CASE WHEN quality = 1 AND toxic = 0 THEN 5 WHEN quality = 1 THEN 4
                        WHEN quality = 0 AND toxic = 0 THEN 2 WHEN quality = 0 THEN 1 ELSE 3 END AS review_score,
                   CASE WHEN d.doc_id % 8 = 0 THEN source END AS review_comment_title,
                   CASE WHEN d.doc_id % 5 >= 3 THEN text END AS review_comment_message,
                   TIMESTAMP '1996-01-01' + to_seconds(d.doc_id * 3571 % 129600000) AS review_creation_date
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "raw_customers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey AS VARCHAR) AS customer_unique_id,
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix, n_name AS customer_city,
               lower({state('c_nationkey')}) AS customer_state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "raw_sellers": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0')
                   AS seller_zip_code_prefix, n_name AS seller_city, upper({state('s_nationkey')}) AS seller_state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "raw_geo": f"""
        SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip, (c_custkey * 37 % 1800) / 10.0::DOUBLE - 90 AS lat,
               (c_custkey * 53 % 3600) / 10.0::DOUBLE - 180 AS lng, n_name AS city, {state('c_nationkey')} AS st
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "stg_geo": """
        SELECT zip AS geolocation_zip_code_prefix, quantile_cont(lat, 0.5) AS geolocation_lat,
               quantile_cont(lng, 0.5) AS geolocation_lng, min(city) AS geolocation_city, min(st) AS geolocation_state
        FROM raw_geo GROUP BY zip""",
    "stg_products": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS product_category_name,
               {case('lower(p_type)', CATEGORY_OF_TYPE, 'lower(p_type)')} AS product_category_name_english,
               (p_size * 2)::DOUBLE AS product_length_cm, p_size::DOUBLE AS product_height_cm,
               CASE WHEN p_size % 25 <> 0 THEN p_size::DOUBLE ELSE 0::DOUBLE END AS product_width_cm,
               (p_size * 100)::DOUBLE AS product_weight_g
        FROM part""",
    "order_prices": f"SELECT order_id, {msum('price')} AS order_total FROM raw_items GROUP BY order_id",
    "stg_orders": f"""
        SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
               CAST(order_purchase_timestamp AS DATE) AS order_date,
               CAST(hour(order_purchase_timestamp) AS INTEGER) AS order_hour,
               {days('order_delivered_customer_date', 'order_purchase_timestamp')} AS delivery_time_days,
               {days('order_delivered_customer_date', 'order_purchase_timestamp')} AS order_lifetime_days,
               coalesce(order_delivered_customer_date > order_estimated_delivery_date, false) AS is_late,
               {STATUS_CATEGORY} AS order_status_category, coalesce(order_total, 0::DOUBLE) AS order_total,
               {bucket('coalesce(order_total, 0)', *fixed.ORDER_SIZE)} AS order_size_category
        FROM (
            SELECT o.* REPLACE (CASE WHEN order_status = 'created' THEN 'unknown' ELSE order_status END AS order_status,
                       approved AS order_approved_at,
                       CASE WHEN order_delivered_customer_date IS NOT NULL THEN
                           greatest(order_delivered_customer_date, coalesce(approved, order_purchase_timestamp)) END
                           AS order_delivered_customer_date)
            FROM (SELECT *, CASE WHEN order_approved_at IS NOT NULL
                         THEN greatest(order_approved_at, order_purchase_timestamp) END AS approved FROM raw_orders) o)
        LEFT JOIN order_prices USING (order_id)""",
    "stg_reviews": f"""
        SELECT review_id, order_id, review_score, trim(review_comment_title, ' ') AS review_comment_title,
               trim(review_comment_message, ' ') AS review_comment_message, review_creation_date,
               review_answer_timestamp, {SENTIMENT} AS review_sentiment,
               {days('review_creation_date', 'order_delivered_customer_date')} AS days_since_delivery
        FROM raw_reviews LEFT JOIN (SELECT order_id, order_delivered_customer_date FROM stg_orders) USING (order_id)""",
    "dates": """
        SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders)""",
    "item_totals": f"""
        SELECT order_id, {msum('price')} AS items_price, {msum('freight_value')} AS items_freight,
               count(order_item_id) AS items_count FROM raw_items GROUP BY order_id""",
    "first_seller": """
        SELECT order_id, seller_id FROM raw_items
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, product_id, seller_id) = 1""",
    "pay_totals": f"""
        SELECT order_id, {msum('payment_value')} AS paid,
               min(payment_type) FILTER (payment_sequential = 1) AS payment_type,
               min(payment_installments) FILTER (payment_sequential = 1) AS payment_installments
        FROM raw_payments GROUP BY order_id""",
    "fct_orders": f"""
        SELECT {key('fct_', 'order_id')} AS fact_key, order_id, {key('cust_', 'c.customer_id')} AS customer_key,
               {key('sell_', 'seller_id')} AS seller_key,
               {key('geo_', 'customer_zip_code_prefix')} AS geography_key,
               {key('dt_', 'order_date')} AS date_key, order_date, order_status, total AS order_total,
               coalesce(items_count, 0) AS item_count, coalesce(paid, 0::DOUBLE) AS payment_value,
               coalesce(items_freight, 0::DOUBLE) AS freight_value, {r('total * 0.15::DOUBLE')} AS profit_estimate,
               total / greatest(coalesce(items_count, 0), 1) AS avg_item_price, delivery_time_days,
               is_late AS is_late_delivery, coalesce(payment_type, '') AS payment_type,
               coalesce(payment_installments, 1) AS payment_installments
        FROM (SELECT s.* EXCLUDE (order_total), i.*  EXCLUDE (order_id), p.* EXCLUDE (order_id), f.seller_id,
                  {r('coalesce(items_price + coalesce(items_freight, 0), 0)', 4)} AS total
              FROM stg_orders s LEFT JOIN item_totals i USING (order_id) LEFT JOIN pay_totals p USING (order_id)
              LEFT JOIN first_seller f USING (order_id)) b
        LEFT JOIN raw_customers c ON b.customer_id = c.customer_id""",
    "fct_items": f"""
        SELECT {key('fi_', 'order_id', 'order_item_id')} AS order_item_fact_key, order_id,
               {key('fct_', 'order_id')} AS fact_key, order_item_id, {key('prd_', 'product_id')} AS product_key,
               {key('sell_', 'seller_id')} AS seller_key, 1 AS quantity, price, freight_value, item_total
        FROM raw_items""",
    "daily": f"""
        SELECT order_date AS date, count(*) AS total_orders, {r(msum('order_total'))} AS total_gmv,
               CAST(sum(item_count) AS BIGINT) AS total_items,
               {r(msum('order_total') + ' / count(*)')} AS avg_order_value,
               count(DISTINCT customer_key) AS unique_customers,
               count(*) FILTER (order_status = 'delivered') AS orders_delivered,
               count(*) FILTER (order_status = 'canceled') AS orders_canceled,
               {r('avg(delivery_time_days)')} AS avg_delivery_time_days,
               {pct('count(*) FILTER (is_late_delivery)', 'count(*)')} AS late_delivery_rate,
               {r(msum('payment_value'))} AS total_revenue, {r(msum('freight_value'))} AS total_freight,
               {r('avg(item_count)')} AS avg_items_per_order
        FROM fct_orders GROUP BY order_date""",
    "wide": f"""
        SELECT order_id, customer_id, order_status, coalesce(customer_state, '') AS customer_state,
               order_purchase_timestamp, CAST(order_purchase_timestamp AS DATE) AS d,
               {r('coalesce(total, 0)')} AS order_total, coalesce(n, 0) AS item_count
        FROM raw_orders LEFT JOIN (SELECT order_id, {r('sum(price + freight_value)', 4)} AS total, count(*) AS n
                                   FROM raw_items GROUP BY order_id) USING (order_id)
        LEFT JOIN raw_customers USING (customer_id)""",
    "first_scores": """
        SELECT order_id, review_score FROM raw_reviews
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_creation_date, review_id) = 1""",
    "clicks": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS seq,
               CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
                   WHEN 'signup' THEN 'checkout_start' WHEN 'purchase' THEN 'checkout_complete'
                   ELSE 'session_start' END AS event_type,
               ts AS event_timestamp, CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
               CAST(user_id AS VARCHAR) AS customer_id, 'exp_001' AS experiment_id,
               {arm('CAST(user_id AS VARCHAR)', "'exp_001'")} AS variant,
               CASE WHEN k % 10 = 0 THEN '' WHEN k % 3 = 0 THEN 'mobile' WHEN k % 3 = 1 THEN 'desktop'
                   ELSE 'tablet' END AS device,
               CASE WHEN k % 7 = 0 THEN NULL WHEN k % 4 = 0 THEN 'google' WHEN k % 4 = 1 THEN 'direct'
                   WHEN k % 4 = 2 THEN 'email' ELSE 'social' END AS referrer,
               '/p/' || CAST(k AS VARCHAR) AS page_url,
               CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) ELSE '' END AS order_id, value
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "order_messages": f"""
        SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
               CASE event_type WHEN 'view' THEN 'order_shipped' WHEN 'signup' THEN 'order_delivered'
                   WHEN 'error' THEN 'order_canceled' ELSE 'order_placed' END AS event_type,
               ts AS event_timestamp, value AS order_total,
               {arm('CAST(user_id AS VARCHAR)', "'exp_001'")} AS variant
        FROM events""",
    "rt": f"""
        SELECT order_id, m.customer_id, {state('c_nationkey')} AS customer_state, event_timestamp, order_total,
               event_type, event_timestamp + INTERVAL 5 SECOND AS created_at
        FROM order_messages m LEFT JOIN customer c ON m.customer_id = CAST(c_custkey AS VARCHAR)""",
    "stream": """
        SELECT event_id, CASE event_type WHEN 'checkout_complete' THEN 'order_placed' ELSE event_type END AS event_type,
               event_timestamp, CASE WHEN event_type <> 'checkout_complete' THEN session_id END AS session_id,
               customer_id, experiment_id, variant,
               CASE WHEN event_type = 'checkout_complete' THEN value ELSE 0 END AS order_total
        FROM clicks""",
    "windows": f"""
        SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end,
               count(*) FILTER (event_type = 'order_placed') AS orders,
               {r("coalesce(sum(order_total) FILTER (event_type = 'order_placed'), 0)")} AS gmv,
               count(DISTINCT session_id) AS sessions, count(*) FILTER (event_type <> 'order_placed') AS clicks
        FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS w FROM stream) GROUP BY w""",
    "metrics": f"""
        SELECT window_start, window_end, unnest(['total_orders', 'total_gmv', 'unique_sessions', 'conversion_rate',
                   'avg_order_value', 'total_clicks']) AS metric_name,
               unnest([orders::DOUBLE, gmv, sessions::DOUBLE, coalesce({pct('orders', 'sessions')}, 0),
                   coalesce({r('gmv / nullif(orders, 0)')}, 0), clicks::DOUBLE]) AS metric_value
        FROM windows""",
    "counters": f"""
        SELECT *, coalesce({pct('conversions', 'impressions', 4)}, 0) AS conversion_rate FROM (
            SELECT experiment_id, variant,
                   count(*) FILTER (event_type IN ('session_start', 'page_view', 'product_view')) AS impressions,
                   count(*) FILTER (event_type IN ('add_to_cart', 'checkout_start')) AS clicks,
                   count(*) FILTER (event_type IN ('order_placed', 'checkout_complete')) AS conversions,
                   {r("coalesce(sum(order_total) FILTER (event_type IN ('order_placed', 'checkout_complete')), 0)")}
                       AS revenue
            FROM stream GROUP BY experiment_id, variant)""",
    "alerts": f"""
        SELECT order_id, seller_id, shipped_at, delivered_at, {r('days', 1)} AS days_to_deliver,
               {r('days - 3', 1)} AS days_late, days > 3 AS is_late,
               CASE WHEN days > 7 THEN 'critical' ELSE 'warning' END AS alert_severity, delivered_at AS created_at
        FROM (SELECT *, (epoch_us(delivered_at) - epoch_us(shipped_at)) / 86400000000.0::DOUBLE AS days FROM (
                  SELECT order_id, order_purchase_timestamp + INTERVAL 2 DAY AS shipped_at,
                         coalesce(order_delivered_customer_date, order_purchase_timestamp + INTERVAL 10 DAY)
                             AS delivered_at FROM stg_orders)) LEFT JOIN first_seller USING (order_id)
        WHERE days > 3""",
    "offsets": """
        SELECT 'group-' || event_type AS consumer_group, event_type || '-stream' AS topic,
               CAST(user_id % 5 AS INTEGER) AS part, date_trunc('hour', ts) AS measured_at, max(event_id) AS head,
               max(event_id) - CAST(sum(floor(value * 10)) AS BIGINT) + 40 AS committed
        FROM events GROUP BY 1, 2, 3, 4""",
    "lag": """
        SELECT consumer_group, min(topic) AS topics, CAST(sum(greatest(0, head - committed)) AS BIGINT) AS total_lag,
               CAST(count(*) AS INTEGER) AS partitions, measured_at
        FROM offsets GROUP BY consumer_group, measured_at""",
    "health": """
        SELECT *, CASE WHEN total_lag > 5000 THEN 'critical' WHEN total_lag > 1000 THEN 'warning' ELSE 'healthy' END
            AS status FROM lag""",
    "latest_health": """
        SELECT * FROM health QUALIFY row_number() OVER (PARTITION BY consumer_group ORDER BY measured_at DESC) = 1""",
    "catalog": "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{i}', '{n}', '{m}', {lift}::DOUBLE, '{t}', {size}, {rate}::DOUBLE)"
        for i, n, m, lift, t, size, rate in fixed.EXPERIMENTS
    )
    + ") AS v(experiment_id, experiment_name, primary_metric, mde_percent, test_type, sample_per_variant, baseline_rate)",
    "assignments": f"""
        SELECT customer_id, customer_state, e.experiment_id, e.experiment_name,
               {arm('customer_id', 'e.experiment_id')} AS variant
        FROM raw_customers, catalog e""",
    "results": f"""
        SELECT experiment_id, experiment_name, variant, unique_users, total_orders, converting_users,
               {pct('converting_users', 'unique_users', 4)} AS conversion_rate, total_revenue,
               coalesce({r('total_revenue / nullif(total_orders, 0)')}, 0) AS avg_order_value,
               {r('total_revenue / unique_users')} AS revenue_per_user
        FROM (SELECT experiment_id, experiment_name, variant, count(DISTINCT a.customer_id) AS unique_users,
                     count(order_id) AS total_orders,
                     count(DISTINCT CASE WHEN order_id IS NOT NULL THEN a.customer_id END) AS converting_users,
                     {r(msum('coalesce(order_total, 0)'))} AS total_revenue
              FROM assignments a LEFT JOIN stg_orders o ON a.customer_id = o.customer_id GROUP BY 1, 2, 3)""",
    "per_customer": f"""
        SELECT customer_id, arg_min(order_id, ord) AS order_id, {msum('coalesce(order_total, 0)')} AS order_total,
               CAST(sum(coalesce(n, 0)) AS BIGINT) AS item_count
        FROM (SELECT o.customer_id, o.order_id, order_total, n,
                     row_number() OVER (PARTITION BY customer_id ORDER BY order_purchase_timestamp, order_id) AS ord
              FROM raw_orders o LEFT JOIN (SELECT order_id, {msum('price')} AS order_total, count(order_item_id) AS n
                  FROM raw_items GROUP BY order_id) USING (order_id)) GROUP BY customer_id""",
    "frame": f"""
        SELECT customer_id, customer_state, experiment_id, experiment_name, variant, order_id, converted,
               CASE WHEN converted THEN coalesce(order_total, 0) ELSE 0::DOUBLE END AS order_total,
               CASE WHEN converted THEN coalesce(item_count, 0) ELSE 0 END AS item_count,
               CASE WHEN converted THEN score END AS review_score
        FROM (SELECT a.*, p.order_id, p.order_total, p.item_count, s.score,
                     {hash_mod("a.customer_id || '|' || a.experiment_id || '|outcome'")} / 10000.0::DOUBLE
                       < CASE WHEN variant = 'treatment' THEN baseline_rate * (1.0::DOUBLE + mde_percent / 100.0::DOUBLE)
                         ELSE baseline_rate END AS converted
              FROM assignments a JOIN catalog c USING (experiment_id) LEFT JOIN per_customer p USING (customer_id)
              LEFT JOIN (SELECT order_id, avg(review_score) AS score FROM raw_reviews GROUP BY order_id) s
                  ON s.order_id = p.order_id)""",
    "stats": """
        SELECT experiment_id, n_control, n_treatment, conversions_control, conversions_treatment,
               conversions_control / n_control::DOUBLE AS cr_c, conversions_treatment / n_treatment::DOUBLE AS cr_t
        FROM (SELECT experiment_id, count(*) FILTER (variant = 'control') AS n_control,
                     count(*) FILTER (variant = 'treatment') AS n_treatment,
                     count(*) FILTER (variant = 'control' AND converted) AS conversions_control,
                     count(*) FILTER (variant = 'treatment' AND converted) AS conversions_treatment
              FROM frame GROUP BY experiment_id)""",
}


def _needed(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", text))
    return [name for name in CTES if name in words]


def sql(final: str, *extra: str, **local: str) -> str:
    """``final`` behind every expression it names, directly or through others.

    ``local`` adds expressions of one query (in the given order).
    """
    wanted: list[str] = []
    entered: set[str] = set()

    def visit(text: str) -> None:
        for name in _needed(text):
            if name not in entered and name not in local:
                entered.add(name)
                visit(CTES[name])
                wanted.append(name)

    for text in local.values():
        visit(text)
    visit(final)
    for name in extra:
        if name not in wanted:
            visit(CTES[name])
            wanted.append(name)
    parts = [f"{name} AS ({CTES[name]})" for name in wanted] + [f"{name} AS ({text})" for name, text in local.items()]
    # an expression that names itself is recursive
    recursive = " RECURSIVE" if any(name in re.findall(r"[a-z_]+", text) for name, text in local.items()) else ""
    return f"WITH{recursive} {', '.join(parts)} {final}" if parts else final
