"""Business, funnel, serving and quality operators on tables small enough to check by hand."""

import datetime as dt
import random

from pyspark.sql import functions as F

from agorakit.operators import business, experiments, funnel, marts, quality, realtime, serving


def clicks(spark, *rows):
    df = spark.createDataFrame([(str(i), s, kind, float(m)) for i, (s, kind, m) in enumerate(rows)], "event_id string, session_id string, event_type string, minute double")
    return df.withColumn("event_timestamp", F.timestamp_seconds(F.col("minute") * 60 + 1_704_067_200)).withColumn("value", F.lit(2.0))


def test_funnel_with_an_empty_stage(spark):
    df = clicks(
        spark, ("a", "session_start", 0), ("a", "session_start", 1), ("b", "session_start", 0), ("a", "product_view", 2),
        ("a", "checkout_start", 3), ("a", "checkout_complete", 4), ("b", "other", 1),
    )
    got = [(r["count"], r.percentage, r.drop_off_rate, r.revenue) for r in funnel.funnel(df).collect()]
    assert got == [(2, 100.0, 0.0, 0.0), (1, 50.0, 50.0, 0.0), (0, 0.0, 100.0, 0.0), (1, 50.0, 0.0, 0.0), (1, 50.0, 0.0, 2.0)]
    empty = funnel.funnel(df.where("false")).collect()
    assert len(empty) == 5 and all(r["count"] == 0 for r in empty)


def test_funnel_groups_never_exceed_the_first_stage(spark):
    rng = random.Random(2)
    rows = []
    for s in range(200):
        depth = rng.randrange(1, 6)
        rows += [(f"s{s}", stage, i) for i, stage in enumerate(["session_start", "product_view", "add_to_cart", "checkout_start", "checkout_complete"][:depth])]
    df = clicks(spark, *rows).withColumn("device", F.when(F.hash("session_id") % 2 == 0, "Mobile").otherwise("desktop"))
    out = funnel.funnel_by_device(df).collect()
    assert len(out) == 10 and {r.device for r in out} == {"mobile", "desktop"}
    for device in ("mobile", "desktop"):
        counts = [r["count"] for r in out if r.device == device]
        assert counts == sorted(counts, reverse=True)


def test_wide_trends_keep_categories_that_are_not_listed(spark):
    rows = [("2024-01-07", "books", 3.0), ("2024-01-07", "new.kind", 5.0), ("2024-01-14", "books", 4.0)]
    wide = business.category_trends_wide(spark.createDataFrame(rows, "week string, category string, revenue double"), ["books", "toys"])
    assert wide.columns == ["week", "books", "toys", "new.kind"]
    assert [tuple(r) for r in wide.collect()] == [("2024-01-07", 3.0, 0.0, 5.0), ("2024-01-14", 4.0, 0.0, 0.0)]


def test_time_to_convert_buckets(spark):
    rows = []
    for s, m in (("a", 0), ("b", 4.99), ("c", 5), ("d", 59.5), ("e", 60)):
        rows += [(s, "product_view", 0), (s, "checkout_complete", m)]
    rows.append(("none", "product_view", 0))
    got = [(r.bucket, r["count"]) for r in funnel.time_to_convert(clicks(spark, *rows)).collect()]
    assert got == [("0-5", 2), ("5-10", 1), ("55-60", 1)]


def test_sessions_and_transitions_of_a_hot_user(spark):
    rng = random.Random(9)
    minute, rows = 0.0, []
    for _ in range(800):  # one user with nearly all events, some chunk borders inside a session
        minute += rng.choice([0.5, 1, 4, 29, 31, 90])
        rows.append(("hot", rng.choice(["view", "cart", "buy"]), minute))
    rows += [("cold", "view", 3.0), ("cold", "buy", 50.0)]
    df = clicks(spark, *rows).withColumn("customer_id", F.col("session_id"))
    got = {r.event_id: r.session_no for r in funnel.sessionize(df, 1800).collect()}
    want, number, before = {}, 0, None
    for i, (_, _, m) in enumerate(rows[:-2]):
        number += before is None or (m - before) * 60 > 1800
        want[str(i)], before = number, m
    want.update({str(len(rows) - 2): 1, str(len(rows) - 1): 2})
    assert got == want
    pairs: dict = {}
    for user in ("hot", "cold"):
        kinds = [r[1] for r in rows if r[0] == user]
        for a, b in zip(kinds, kinds[1:] + ["exit"]):
            pairs[a, b] = pairs.get((a, b), 0) + 1
    assert {(r.source, r.target): r.value for r in funnel.transitions(df).collect()} == pairs


def test_session_figures(spark):
    df = clicks(spark, ("a", "add_to_cart", 0), ("a", "checkout_complete", 2), ("a", "product_view", 3), ("b", "add_to_cart", 0), ("c", "product_view", 0))
    assert tuple(funnel.abandonment(df).collect()[0]) == (1, 50.0, 2, 1)
    m = funnel.session_metrics(df).collect()[0]
    assert (m.median_session_duration_sec, m.avg_pages_per_session, m.bounce_rate, m.session_conversion) == (0, 1.7, 66.7, 33.3)
    by = funnel.conversion_by(df.withColumn("device", F.when(F.col("session_id") != "c", "x").otherwise("")), "device").collect()
    assert [tuple(r) for r in by] == [("x", 2, 1, 0.5)]


def wide(spark, *rows):
    return spark.createDataFrame(
        [(f"o{i}", *r) for i, r in enumerate(rows)], "order_id string, customer_id string, t string, order_total double, order_status string"
    ).selectExpr("*", "cast(t as timestamp) order_purchase_timestamp", "'SP' customer_state")


def test_month_to_date_and_growth(spark):
    rows = [("c", "2020-01-05", 10.0, "delivered")] * 3 + [("c", "2020-02-05", 20.0, "delivered")] * 3 + [("c", "2020-03-01", 99.0, "delivered")]
    got = business.kpi_mtd(wide(spark, *rows), min_orders=2).collect()[0]
    # the month of too few orders is not the latest, yet its orders lie after its start
    assert tuple(got) == (159.0, 4, 30.0, 430.0)
    none = business.kpi_mtd(wide(spark, *rows), min_orders=100).collect()[0]
    assert tuple(none) == (0.0, 0, 0.0, 0.0)


def test_week_over_week_needs_two_full_weeks(spark):
    week = [("c", f"2020-01-{d:02d}", 10.0, "x") for d in range(6, 12)]  # Monday to Saturday
    assert business.wow(wide(spark, *week)).count() == 0
    two = week + [("c", f"2020-01-{d:02d}", 15.0, "x") for d in range(13, 19)]
    got = {r.day: (r.this_week, r.last_week, r.delta_pct) for r in business.wow(wide(spark, *two)).collect()}
    assert got["Mon"] == (15.0, 10.0, 50.0) and set(got) == {"Mon", "Tue", "Wed", "Thu", "Fri", "Sat"}


def test_cohorts_count_month_borders(spark):
    rows = [(f"c{i}", "2020-01-31", 1.0, "x") for i in range(4)] + [("c0", "2020-02-01", 1.0, "x"), ("c1", "2021-03-01", 1.0, "x")]
    people = spark.createDataFrame([(f"c{i}", f"u{i}") for i in range(4)], "customer_id string, customer_unique_id string")
    got = business.cohort_retention(wide(spark, *rows), people, min_size=2).collect()
    assert [(r.cohort, r.cohort_size, r.month_0, r.month_1, r.month_2) for r in got] == [("2020-01", 4, 100.0, 25.0, None)]
    assert business.repeat_rate(wide(spark, *rows), people).collect()[0].repeat_rate == 50.0


def test_order_value_buckets_are_left_closed_and_complete(spark):
    rows = [("c", "2020-01-01", v, "x") for v in (49.99, 50.0, 1000.0, 5000.0)]
    got = [(r.bucket, r["count"], r.pct) for r in business.aov_distribution(wide(spark, *rows)).collect()]
    assert got == [("R$0-50", 1, 25.0), ("R$50-100", 1, 25.0), ("R$100-200", 0, 0.0), ("R$200-500", 0, 0.0), ("R$500-1K", 0, 0.0), ("R$1K+", 2, 50.0)]


def test_top_products_repeat_items_per_review(spark):
    items = spark.createDataFrame([("o1", "p1", 10.0), ("o2", "p1", 20.0), ("o3", "p2", 5.0)], "order_id string, product_id string, price double")
    products = spark.createDataFrame([("p1", "a", "toys"), ("p2", "b", None), ("p3", None, None)], "product_id string, product_category_name string, product_category_name_english string")
    reviews = spark.createDataFrame([("o1", 5), ("o1", 3)], "order_id string, review_score int")
    got = [tuple(r) for r in business.top_products(items, products, reviews).collect()]
    assert got == [("toys", 3, 40.0, 13.33, 4.0, 1, 88.9), ("b", 1, 5.0, 5.0, 0.0, 2, 11.1)]


def test_product_mart_needs_a_known_product(spark):
    items = spark.createDataFrame(
        [("o1", "p1", 10.0, 1.0), ("o1", "p1", 30.0, 1.0), ("o2", "p1", 20.0, 1.0), ("o3", "gone", 5.0, 1.0)],
        "order_id string, product_id string, price double, freight_value double",
    )
    products = spark.createDataFrame([("p1", "k1", "toys", "lifestyle")], "product_id string, product_key string, product_category_name_english string, product_category_group string")
    reviews = spark.createDataFrame([("o1", "r1", 5), ("o1", "r2", 1)], "order_id string, review_id string, review_score int").withColumn("review_creation_date", F.lit("2020-01-01").cast("timestamp"))
    got = [tuple(r) for r in marts.fct_product_performance(items, reviews, products).collect()]
    assert got == [("k1", "toys", "lifestyle", 3, 60.0, 3.0, 20.0, 2, 1, 5.0, 33.33)]


def test_reconciliation(spark):
    ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "order_id string")
    got = {r.category: (r.order_count, r.sample_ids) for r in serving.reconcile(ids("abc"), ids("bd")).collect()}
    assert got == {"stream_only": (1, "d"), "batch_only": (2, ""), "overlap": (1, "b"), "totals": (4, "batch=3 stream=2 union=4")}
    drift = quality.stream_drift(serving.reconcile(ids("abc"), ids("bd"))).collect()[0]
    assert tuple(drift) == (1, 2, 50.0, False)


def test_stream_rows_win_once(spark):
    batch = wide(spark, ("c", "2020-01-01", 1.0, "delivered"), ("c", "2020-01-02", 2.0, "shipped"))
    rt = spark.createDataFrame(
        [("o1", "c", "SP", "2020-01-03", 9.0, "order_shipped"), ("o1", "c", "SP", "2020-01-04", 8.0, "order_delivered"), ("o9", "c", "SP", "2020-01-04", 7.0, None)],
        "order_id string, customer_id string, customer_state string, t string, order_total double, event_type string",
    ).selectExpr("*", "cast(t as timestamp) event_timestamp")
    got = {r.order_id: (r._source_layer, r.order_status) for r in serving.unified_orders(batch, rt, "stream_wins").collect()}
    assert got == {"o0": ("batch", "delivered"), "o1": ("stream", "order_delivered"), "o9": ("stream", "order_placed")}
    assert serving.unified_orders(batch, rt).count() == 5
    bounded = serving.unified_orders(batch, rt, "boundary", "2020-01-02").collect()
    assert sorted(r.order_id for r in bounded) == ["o0", "o1", "o1", "o9"]


def test_live_figures_without_a_day_before(spark):
    rt = spark.createDataFrame(
        [("o1", 10.0, "order_placed"), ("o2", 30.0, "order_canceled")], "order_id string, order_total double, event_type string"
    ).withColumn("event_timestamp", F.lit("2020-01-01 05:00:00").cast("timestamp"))
    r = realtime.rt_kpis(rt).collect()[0]
    assert (r.total_gmv, r.total_orders, r.avg_order_value, r.cancel_rate, r.gmv_vs_yesterday) == (40.0, 2, 20.0, 50.0, 0.0)
    empty = realtime.rt_kpis(rt.where("false")).collect()[0]
    assert (empty.total_gmv, empty.total_orders) == (0.0, 0)


def test_checks_report_violations(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", -1.0, "y"), (None, 3.0, None)], "k string, v double, s string")
    checks = [quality.not_null("k"), quality.unique("k"), quality.non_negative("v"), quality.in_range("v", 0, 2), quality.accepted("s", ["x"]), quality.has_rows(), quality.has_values("s", ["x", "z"])]
    got = {r.check_name: (r.passed, r.violations) for r in quality.run_checks(df, checks, "t").collect()}
    assert got == {
        "not_null:k": (False, 1), "unique:k": (False, 1), "non_negative:v": (False, 1), "range:v": (False, 2),
        "accepted:s": (False, 2), "has_rows": (True, 0), "has_values:s": (False, 1),
    }
    empty = {r.check_name: r.passed for r in quality.run_checks(df.where("false"), checks).collect()}
    assert empty["has_rows"] is False and empty["not_null:k"] is True


def test_lag_bands_and_health(spark):
    rows = [("g1", "t", 0, 100, 90), ("g1", "t", 1, 50, 70), ("g2", "t", 0, 5000, 3500), ("g3", "u", 0, 9000, 1)]
    offsets = spark.createDataFrame(rows, "consumer_group string, topic string, partition int, head long, committed long").withColumn("measured_at", F.lit("2020-01-01").cast("timestamp"))
    lag = quality.consumer_lag(offsets)
    got = {r.consumer_group: (r.total_lag, r.partitions, r.status) for r in lag.collect()}
    assert got == {"g1": (10, 2, "healthy"), "g2": (1500, 1, "warning"), "g3": (8999, 1, "critical")}
    assert tuple(quality.health_check(quality.latest_health(lag)).collect()[0]) == (3, 1, False)
    none = spark.createDataFrame([], "status string")
    assert quality.health_score(quality.latest_health(lag), none).collect()[0].score == 33
    fresh = spark.createDataFrame([("fresh",), ("fresh",), ("stale",), ("fresh",)], "status string")
    assert quality.health_score(quality.latest_health(lag.where("false")), none, fresh).collect()[0].score == 75


def test_gaps_break_the_sla(spark):
    days = [dt.date(2020, 1, d) for d in (1, 2, 4, 5)]
    daily = spark.createDataFrame([(d,) for d in days], "date date")
    got = [(r.date.day, r.sla_met, r.duration_min) for r in quality.sla_calendar(daily).collect()]
    assert got == [(2, True, 1440), (4, False, 2880), (5, True, 1440)]
    assert tuple(quality.sla_days_met(quality.sla_calendar(daily)).collect()[0]) == (2, 3)


def test_anomalies_are_found(spark):
    base = dt.date(2020, 1, 1)
    rows = [(base + dt.timedelta(days=i), 20, 100.0 + i % 3, 1, 5.0) for i in range(40)]
    rows.append((base + dt.timedelta(days=40), 20, 500.0, 6, 9.0))
    daily = spark.createDataFrame(rows, "date date, total_orders long, total_gmv double, orders_canceled long, avg_delivery_time_days double")
    orders = wide(spark, ("c", "2020-01-01", 1.0, "x"), ("c", "2020-03-01", 1.0, "x"))
    reviews = spark.createDataFrame([("o0", 5), ("o1", 1)], "order_id string, review_score int")
    got = {r.metric: r.severity for r in quality.anomaly_scan(daily, reviews, orders).collect()}
    assert got == {"Daily GMV": "critical", "Cancellation Rate": "warning", "Delivery Time": "warning", "Review Score": "warning"}
    calm = quality.anomaly_scan(daily.where(F.col("date") < "2020-02-10"), reviews.where("order_id = 'o0'"), orders.where("order_id = 'o0'"))
    assert calm.count() == 0


def test_profile_and_orphans(spark):
    child = spark.createDataFrame([("a", 1), ("a", None), ("z", 2)], "k string, v int")
    got = {r.column_name: (r.null_count, r.null_pct, r.duplicate_keys) for r in quality.profile(child, "k").collect()}
    assert got == {"k": (0, 0.0, 1), "v": (1, 33.33, 1)}
    parent = spark.createDataFrame([("a",)], "k string")
    assert tuple(quality.orphans(child, parent, "k").collect()[0]) == (1, 1)


def test_arm_names_match_in_any_case(spark):
    results = spark.createDataFrame(
        [("e", "n", "Control", 100, 10.0, 50.0, 5.0), ("e", "n", "treatment", 100, 12.0, 60.0, 5.0)],
        "experiment_id string, experiment_name string, variant string, unique_users long, conversion_rate double, total_revenue double, avg_order_value double",
    )
    summary = spark.createDataFrame([("e", 0.01, "Yes", "LAUNCH", 9.0)], "experiment_id string, p_value double, significant string, recommendation string, revenue_impact_monthly double")
    row = experiments.comparison(results, summary).collect()[0]
    assert row.control_users == 100 and abs(row.lift_percent - 20.0) < 1e-9
    listed = experiments.experiment_list(experiments.comparison(results, summary)).collect()[0]
    assert listed.significant is True and listed.control_conversions == 10 and listed.ci_lower < 20 < listed.ci_upper
