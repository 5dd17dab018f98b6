"""Business questions."""

from __future__ import annotations

from agorakit.functions import fixed
from agorakit.operators import business
from agorakit.plans.oracle import key, mavg, msum, pct, r, sql
from agorakit.plans.registry import register
from agorakit.session import shared_dir
from agorakit.sources import search
from agorakit.sources.adapters import CATEGORY_OF_TYPE

CATEGORIES = [*sorted(CATEGORY_OF_TYPE.values()), "promo"]
TERMS = ["price", "data", "the"]

_DOW = "CAST(dayofweek({0}) + 1 AS INTEGER)"
_DAY_NAME = "(['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'])[dow]"

register(
    "kpi_totals",
    lambda m: business.kpi_totals(m.wide),
    sql(
        f"SELECT coalesce({msum('order_total')}, 0) AS total_gmv, count(*) AS total_orders, "
        f"coalesce({mavg('order_total')}, 0) AS aov FROM wide"
    ),
)
register(
    "kpi_month_to_date",
    lambda m: business.kpi_mtd(m.wide),
    sql(
        f"SELECT gmv_mtd, orders_mtd, prev_gmv, coalesce({r('(gmv_mtd - prev_gmv) / nullif(prev_gmv, 0) * 100', 1)}, 0) "
        "AS gmv_growth_pct FROM (SELECT "
        f"coalesce({r('sum(gmv) FILTER (m >= latest)', 4)}, 0) AS gmv_mtd, "
        "coalesce(CAST(sum(orders) FILTER (m >= latest) AS BIGINT), 0) AS orders_mtd, "
        f"coalesce({r('sum(gmv) FILTER (m = latest - INTERVAL 1 MONTH)', 4)}, 0) AS prev_gmv "
        "FROM monthly, (SELECT max(m) AS latest FROM monthly WHERE orders > 100))",
        monthly=f"SELECT date_trunc('month', d) AS m, {msum('order_total')} AS gmv, count(*) AS orders FROM wide GROUP BY 1",
    ),
)
register(
    "kpi_delivery",
    lambda m: business.kpi_delivery(m.daily, 2),
    sql(
        f"SELECT {r(mavg('avg_delivery_time_days'), 1)} AS avg_delivery_days, "
        f"{r('100 - ' + mavg('late_delivery_rate'), 1)} AS on_time_delivery_pct FROM daily "
        "WHERE avg_delivery_time_days IS NOT NULL AND total_orders > 2"
    ),
)
register(
    "sparkline_14_days",
    lambda m: business.sparkline(m.daily, 14, 3),
    sql(
        "SELECT date AS d, total_gmv AS gmv, total_orders AS orders, avg_order_value AS aov FROM daily "
        "WHERE total_orders > 3 AND total_gmv > 0 ORDER BY date DESC LIMIT 14"
    ),
)
register(
    "repeat_purchase_rate",
    lambda m: business.repeat_rate(m.wide, m.raw_customers),
    sql(
        f"SELECT {pct('count(*) FILTER (cnt > 1)', 'count(*)', 1)} AS repeat_rate FROM "
        "(SELECT customer_unique_id, count(*) AS cnt FROM wide JOIN raw_customers USING (customer_id) GROUP BY 1)"
    ),
)
_TRENDS = sql(
    "SELECT date, gmv, "
    + r("sum(gmv) OVER w", 4)
    + " / count(gmv) OVER w AS gmv_ma7, orders, aov, delivered, shipped, canceled, processing FROM "
    f"(SELECT d AS date, {msum('order_total')} AS gmv, count(*) AS orders, {mavg('order_total')} AS aov, "
    "count(*) FILTER (order_status = 'delivered') AS delivered, count(*) FILTER (order_status = 'shipped') AS shipped, "
    "count(*) FILTER (order_status = 'canceled') AS canceled, "
    "count(*) FILTER (order_status NOT IN ('delivered', 'shipped', 'canceled')) AS processing "
    "FROM wide GROUP BY d ORDER BY d DESC LIMIT 90) WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
)
register("daily_trends", lambda m: business.daily_trends(m.wide), _TRENDS)
register(
    "sales_by_state",
    lambda m: business.by_state(m.wide),
    sql(
        f"SELECT customer_state AS state, {msum('order_total')} AS gmv, count(*) AS orders, "
        f"{r(mavg('order_total'))} AS aov FROM wide GROUP BY 1"
    ),
)
_NAMED = "SELECT product_id, product_category_name_english AS category FROM stg_products"
register(
    "top_categories",
    lambda m: business.top_products(m.raw_items, m.stg_products, m.scores_only, 4),
    sql(
        "SELECT category, units_sold, revenue, avg_price, coalesce(score, 0) AS review_score, "
        "CAST(row_number() OVER (ORDER BY revenue DESC, category) AS INTEGER) AS rank, "
        f"{r('revenue / greatest(' + r('sum(revenue) OVER ()', 4) + ', 1) * 100', 1)} AS share_pct FROM "
        f"(SELECT category, count(*) AS units_sold, {msum('price')} AS revenue, {r(mavg('price'))} AS avg_price, "
        f"{r('avg(review_score)', 1)} AS score FROM raw_items i JOIN named USING (product_id) "
        "LEFT JOIN raw_reviews v ON v.order_id = i.order_id GROUP BY 1 ORDER BY revenue DESC, category LIMIT 4)",
        named=_NAMED,
    ),
)
register(
    "revenue_by_category",
    lambda m: business.revenue_by_category(m.raw_items, m.stg_products),
    sql(f"SELECT category, {msum('price')} AS revenue FROM raw_items JOIN named USING (product_id) GROUP BY 1", named=_NAMED),
)
register(
    "top_dimension_categories",
    lambda m: business.top_dimension_categories(m.fct_items, m.dim_products),
    sql(
        f"SELECT product_category_name, count(*) AS items_sold, {msum('price')} AS total_revenue, {mavg('price')} "
        f"AS avg_price FROM fct_items JOIN (SELECT *, {key('prd_', 'product_id')} AS product_key FROM stg_products) "
        "USING (product_key) GROUP BY 1"
    ),
)
_WOW = sql(
    f"SELECT {_DAY_NAME} AS day, dow, this_week, last_week, "
    f"coalesce({r('(this_week - last_week) / nullif(last_week, 0) * 100', 1)}, 0) AS delta_pct FROM "
    f"(SELECT {_DOW.format('d')} AS dow, {r('sum(CASE WHEN age = 1 THEN gmv ELSE 0 END)', 4)} AS this_week, "
    f"{r('sum(CASE WHEN age = 2 THEN gmv ELSE 0 END)', 4)} AS last_week FROM by_day JOIN weeks USING (wk) GROUP BY 1)",
    by_day=f"SELECT d, date_trunc('week', d) AS wk, {msum('order_total')} AS gmv FROM wide GROUP BY d",
    weeks="SELECT wk, row_number() OVER (ORDER BY wk DESC) AS age FROM by_day GROUP BY wk HAVING count(*) >= 6 "
    "ORDER BY wk DESC LIMIT 2",
)
register("week_over_week", lambda m: business.wow(m.wide), _WOW)

_SUNDAY = "CAST(d - CAST(dayofweek(d) AS INTEGER) AS DATE)"
_TREND_ROWS = (
    f"SELECT week, category, {msum('price')} AS revenue FROM raw_items JOIN named USING (product_id) "
    f"JOIN (SELECT order_id, {_SUNDAY} AS week FROM wide) USING (order_id) "
    "WHERE category IN (SELECT category FROM best) GROUP BY 1, 2"
)
_BEST = (
    "SELECT category FROM raw_items JOIN named USING (product_id) GROUP BY 1 "
    f"ORDER BY {msum('price')} DESC, category LIMIT {{n}}"
)
register(
    "category_trends",
    lambda m: business.category_trends(m.raw_items, m.wide, m.stg_products, 3),
    sql(_TREND_ROWS, named=_NAMED, best=_BEST.format(n=3)),
)
register(
    "category_trends_wide",
    lambda m: business.category_trends_wide(
        business.category_trends(m.raw_items, m.wide, m.stg_products, 6), CATEGORIES
    ),
    sql(
        "SELECT week, "
        + ", ".join(f"coalesce(max(revenue) FILTER (category = '{c}'), 0) AS {c}" for c in CATEGORIES)
        + f" FROM ({_TREND_ROWS}) GROUP BY week",
        named=_NAMED,
        best=_BEST.format(n=6),
    ),
)
_COHORT = sql(
    "SELECT cohort, n0 AS cohort_size, "
    + ", ".join(f"{pct(f'nullif(n{i}, 0)', 'n0', 1)} AS month_{i}" for i in range(13))
    + " FROM (SELECT cohort, "
    + ", ".join(f"count(DISTINCT uid) FILTER (age = {i}) AS n{i}" for i in range(13))
    + " FROM (SELECT uid, strftime(first, '%Y-%m') AS cohort, "
    "(year(d) - year(first)) * 12 + month(d) - month(first) AS age FROM (SELECT customer_unique_id AS uid, d, "
    "min(d) OVER (PARTITION BY customer_unique_id) AS first FROM wide JOIN raw_customers USING (customer_id))) "
    "GROUP BY cohort) WHERE n0 >= 50 ORDER BY cohort DESC LIMIT 8"
)
register("cohort_retention", lambda m: business.cohort_retention(m.wide, m.raw_customers), _COHORT)

_LABEL = (
    "CASE "
    + " ".join(f"WHEN order_total < {e} THEN '{b}'" for e, b in zip(fixed.AOV_EDGES, fixed.AOV_LABELS))
    + f" ELSE '{fixed.AOV_LABELS[-1]}' END"
)
register(
    "order_value_distribution",
    lambda m: business.aov_distribution(m.wide),
    sql(
        "SELECT CAST(i - 1 AS INTEGER) AS pos, labels_list[i] AS bucket, coalesce(n, 0) AS count, "
        f"{r('coalesce(n, 0) / greatest(sum(coalesce(n, 0)) OVER (), 1) * 100', 1)} AS pct FROM "
        f"(SELECT [{', '.join(repr(b) for b in fixed.AOV_LABELS)}] AS labels_list, unnest(range(1, 7)) AS i) "
        f"LEFT JOIN (SELECT {_LABEL} AS b, count(*) AS n FROM wide GROUP BY 1) ON b = labels_list[i]"
    ),
)
register(
    "order_heatmap",
    lambda m: business.heatmap(m.wide),
    sql(
        f"SELECT {_DAY_NAME} AS day, * FROM (SELECT {_DOW.format('d')} AS dow, "
        "CAST(hour(order_purchase_timestamp) AS INTEGER) AS hour, count(*) AS orders FROM wide GROUP BY 1, 2)"
    ),
)
register(
    "rating_distribution",
    lambda m: business.rating_distribution(m.scores_only),
    sql("SELECT review_score, count(*) AS reviews FROM raw_reviews GROUP BY 1"),
)
_SEARCH = sql(
    "SELECT review_id, order_id, review_score FROM raw_reviews WHERE list_has_any("
    f"regexp_split_to_array(lower(review_comment_message), '[^\\p{{L}}\\p{{N}}]+'), [{', '.join(map(repr, TERMS))}])"
)
register(
    "search_review_text",
    lambda m: business.search_reviews(m.raw_reviews, TERMS).select("review_id", "order_id", "review_score"),
    _SEARCH,
)


def _indexed_search(m):
    """The same search through an inverted index: the reviews are taken into it, then only the terms' buckets are read."""
    path = shared_dir(m.spark, "reviews")
    keys = ["review_id", "order_id"]
    rows = m.raw_reviews.select(*keys, "review_score", "review_comment_message", "review_creation_date")
    search.index_batch(path, rows, keys, "review_comment_message", "review_creation_date")
    return search.search(m.spark, path, TERMS, keys, "review_creation_date").select(*keys, "review_score")


register("search_review_index", _indexed_search, _SEARCH)


def flagship(m):
    """Daily trends of the last 90 days with a 7-day moving average."""
    return business.daily_trends(m.wide)


