"""Funnels and sessions over the click events."""

from __future__ import annotations

from pyspark.sql import functions as F

from agorakit.functions import fixed
from agorakit.operators import funnel
from agorakit.plans.oracle import pct, r, sql
from agorakit.plans.registry import register
from agorakit.session import shared_dir
from agorakit.streaming import operators as streams, runtime

SESSION_GAP = 4 * 3600

_STAGES = ", ".join(f"({i}, '{s}')" for i, s in enumerate(fixed.FUNNEL_STAGES))


def _funnel_sql(by: str | None = None, source: str = "clicks", where: str = "true") -> str:
    """The funnel over one grouping column (or none)."""
    group, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    groups = f"(SELECT DISTINCT {by} FROM src) g, steps" if by else "steps"
    join = f"c.stage = s.stage{f' AND c.{by} IS NOT DISTINCT FROM s.{by}' if by else ''}"
    return sql(
        f"SELECT {group} CAST(step AS INTEGER) AS step, stage, n AS count, {r('n / base * 100', 1)} AS percentage, "
        f"CASE WHEN step = 0 THEN 0 ELSE {r('(1 - n / prev) * 100', 1)} END AS drop_off_rate, "
        f"CASE WHEN step = 4 THEN {r('v')} ELSE 0 END AS revenue FROM (SELECT *, "
        "greatest(first_value(n) OVER w, 1) AS base, greatest(lag(n) OVER w, 1) AS prev FROM (SELECT s.*, "
        f"coalesce(c.cnt, 0) AS n, coalesce(c.value, 0) AS v FROM (SELECT * FROM {groups}) s LEFT JOIN c ON {join}) "
        f"WINDOW w AS ({part} ORDER BY step))",
        src=f"SELECT * FROM {source} WHERE {where}",
        steps=f"SELECT * FROM (VALUES {_STAGES}) AS t(step, stage)",
        c=f"SELECT {group} event_type AS stage, count(DISTINCT session_id) AS cnt, {r('sum(value)', 4)} AS value "
        f"FROM src GROUP BY {group} event_type",
    )


register("funnel_overall", lambda m: funnel.funnel(m.clicks), _funnel_sql())
register(
    "funnel_by_device",
    lambda m: funnel.funnel_by_device(m.clicks),
    _funnel_sql("device", where="device IS NOT NULL"),
)
_SIDES = ", ".join(
    f"coalesce(max({c}) FILTER (variant = '{v}'), 0) AS {v}{s}"
    for v in fixed.VARIANTS
    for c, s in (("count", ""), ("percentage", "_pct"))
)
register(
    "funnel_by_variant",
    lambda m: funnel.funnel_by_variant(m.clicks, "exp_001"),
    f"SELECT *, {r('(treatment - control) / greatest(control, 1) * 100', 1)} AS improvement_percent FROM "
    f"(SELECT step, stage, {_SIDES} FROM ({_funnel_sql('variant')}) GROUP BY step, stage)",
)
register(
    "sessionize_by_gap",
    lambda m: funnel.sessionize(m.clicks.select("event_id", "customer_id", "event_timestamp"), SESSION_GAP),
    sql(
        "SELECT event_id, customer_id, event_timestamp, CAST(sum(s) OVER (PARTITION BY customer_id "
        "ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no FROM (SELECT *, "
        "CASE WHEN p IS NULL OR epoch_us(event_timestamp) - epoch_us(p) > 14400000000 THEN 1 ELSE 0 END AS s FROM "
        "(SELECT *, lag(event_timestamp) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id) AS p "
        "FROM clicks))"
    ),
)


def _run_sessions(m):
    """Sessions of the click log replayed as a stream of files in no order of time, a few files to a batch.

    The grace is the span of the log, so no row is late; a closing mark behind its end lets all sessions out.
    """
    path = shared_dir(m.spark, "sessions")
    clicks = m.clicks.select("event_id", "customer_id", "event_timestamp")
    clicks.repartition(16, F.xxhash64("event_id")).write.parquet(f"{path}/events")
    landed = m.spark.read.schema(clicks.schema).parquet(f"{path}/events")
    first, last = landed.agg(F.min(F.unix_seconds("event_timestamp")), F.max(F.unix_seconds("event_timestamp"))).first()
    span = (last - first if first is not None else 0) + SESSION_GAP + 3600
    mark = m.spark.range(1).select(
        F.lit(None).cast(clicks.schema["event_id"].dataType).alias("event_id"),
        F.lit("").alias("customer_id"),  # its own session stays open
        F.timestamp_seconds(F.lit((last or 0) + 2 * span)).alias("event_timestamp"),
    )
    for step in (None, mark):
        if step is not None:
            step.write.mode("append").parquet(f"{path}/events")
        stream = m.spark.readStream.schema(clicks.schema).option("maxFilesPerTrigger", 4).parquet(f"{path}/events")
        found = streams.gap_sessions(stream, SESSION_GAP, f"{span} seconds")
        runtime.start_append(found, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return m.spark.read.schema(found.schema).parquet(f"{path}/table")


_SESSION_SUMS = sql(
    "SELECT customer_id, min(event_timestamp) AS started_at, max(event_timestamp) AS ended_at, count(*) AS events FROM "
    "(SELECT *, sum(s) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM "
    f"(SELECT *, CASE WHEN p IS NULL OR epoch_us(event_timestamp) - epoch_us(p) > {SESSION_GAP}000000 THEN 1 ELSE 0 END AS s FROM "
    "(SELECT *, lag(event_timestamp) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id) AS p FROM clicks "
    "WHERE customer_id IS NOT NULL))) GROUP BY customer_id, session_no"
)
register("gap_sessions", lambda m: streams.gap_sessions(m.clicks, SESSION_GAP), _SESSION_SUMS)
register("gap_sessions_streamed", _run_sessions, _SESSION_SUMS)


def _conversion_sql(attribute: str) -> str:
    return sql(
        f"SELECT {attribute}, count(*) AS sessions, CAST(sum(converted) AS BIGINT) AS orders, "
        f"{r('sum(converted)::DOUBLE / count(*)', 4)} AS conversion_rate FROM (SELECT session_id, "
        f"max({attribute}) FILTER ({attribute} <> '') AS {attribute}, "
        "max(CASE WHEN event_type = 'checkout_complete' THEN 1 ELSE 0 END) AS converted FROM clicks GROUP BY 1) "
        f"WHERE {attribute} IS NOT NULL GROUP BY 1"
    )


register("conversion_by_device", lambda m: funnel.conversion_by(m.clicks, "device"), _conversion_sql("device"))
register("conversion_by_referrer", lambda m: funnel.conversion_by(m.clicks, "referrer"), _conversion_sql("referrer"))
register(
    "time_to_convert",
    lambda m: funnel.time_to_convert(m.clicks),
    sql(
        "SELECT CAST(b AS VARCHAR) || '-' || CAST(b + 5 AS VARCHAR) AS bucket, b AS minutes_start, count(*) AS count "
        "FROM (SELECT CAST(floor(mins / 5) * 5 AS INTEGER) AS b FROM (SELECT floor((epoch_us(max(event_timestamp) "
        "FILTER (event_type = 'checkout_complete')) - epoch_us(min(event_timestamp))) / 60000000) AS mins FROM clicks "
        "GROUP BY session_id) WHERE mins BETWEEN 0 AND 59) GROUP BY 1, 2"
    ),
)
register(
    "event_transitions",
    lambda m: funnel.transitions(m.clicks),
    sql(
        "SELECT event_type AS source, coalesce(n, 'exit') AS target, count(*) AS value FROM (SELECT event_type, "
        "lead(event_type) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS n FROM clicks) "
        "GROUP BY 1, 2 ORDER BY value DESC, source, target LIMIT 20"
    ),
)
register(
    "cart_abandonment",
    lambda m: funnel.abandonment(m.clicks),
    sql(
        f"SELECT carts - orders AS abandoned_carts, coalesce({pct('carts - orders', 'carts', 1)}, 0) AS abandonment_rate, "
        "carts, orders FROM (SELECT count(DISTINCT session_id) FILTER (event_type = 'add_to_cart') AS carts, "
        "count(DISTINCT session_id) FILTER (event_type = 'checkout_complete') AS orders FROM clicks)"
    ),
)
register(
    "session_metrics",
    lambda m: funnel.session_metrics(m.clicks),
    sql(
        "SELECT quantile_disc(secs, 0.5) AS median_session_duration_sec, "
        f"{r('avg(pages)', 1)} AS avg_pages_per_session, {pct('count(*) FILTER (pages <= 2)', 'count(*)', 1)} "
        f"AS bounce_rate, {pct('sum(converted)', 'count(*)', 1)} AS session_conversion FROM (SELECT "
        "CAST(floor((epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) / 1000000) AS BIGINT) AS secs, "
        "count(*) AS pages, max(CASE WHEN event_type = 'checkout_complete' THEN 1 ELSE 0 END) AS converted FROM clicks "
        "GROUP BY session_id)"
    ),
)
