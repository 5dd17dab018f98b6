import json
import os

import pytest
from pyspark.sql import functions as F

from agorakit.functions import fixed
from agorakit.sources import schemas, sinks, topics
from agorakit.streaming import messages, operators as streams, runtime

EVENT = (
    "event_type string, session_id string, customer_id string, experiment_id string, variant string, "
    "order_total double, order_id string, seller_id string, timestamp string"
)


def event(kind, at, session=None, total=None, **extra):
    return {"event_type": kind, "session_id": session, "order_total": total, "timestamp": f"2024-01-01T{at}Z", **extra}


def land(folder, name, events):
    """Write one file of messages; files are read in the order they were written."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.writelines(json.dumps(e) + "\n" for e in events)
    stamp = 1_700_000_000 + len(os.listdir(folder)) * 10
    os.utime(path, (stamp, stamp))


def stream_of(spark, folder):
    return messages.event_time(topics.read_topic_files(spark, str(folder), EVENT, max_files=1))


FIRST = [
    event("session_start", "00:01:00", "s1"),
    event("product_view", "00:04:59", "s1"),
    event("order_placed", "00:05:00", None, 10.0),
    event("product_view", "00:05:00", "s2"),
    event("product_view", "00:06:00", "s3"),
]


def windows(df):
    return {(r.window_start.strftime("%H:%M"), r.metric_name): r.metric_value for r in df.collect()}


def test_windows_at_their_edges(spark):
    df = spark.createDataFrame([tuple(e.get(c) for c in schemas.struct(EVENT).names) for e in FIRST], EVENT)
    got = windows(streams.window_metrics(messages.event_time(df)))
    assert got["00:00", "total_clicks"] == 2 and got["00:00", "unique_sessions"] == 1
    assert got["00:05", "total_orders"] == 1 and got["00:05", "total_gmv"] == 10.0
    assert got["00:05", "conversion_rate"] == 50.0 and got["00:05", "avg_order_value"] == 10.0
    assert got["00:00", "avg_order_value"] == 0.0 and len(got) == 12


def test_streamed_windows_match_the_batch_and_drop_late_rows(spark, tmp_path):
    src = tmp_path / "in"
    land(src, "a.json", FIRST)
    land(src, "b.json", [event("product_view", "00:20:00", "s9")])  # moves the watermark to 00:19
    land(src, "c.json", [event("product_view", "00:04:00", "late"), event("product_view", "00:19:30", "s8")])
    land(src, "d.json", [event("product_view", "01:00:00", "s9")])
    metrics = streams.window_metrics(stream_of(spark, src), fixed.WINDOW_GRACE)
    runtime.start_append(metrics, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = windows(spark.read.schema(metrics.schema).parquet(str(tmp_path / "out")))
    kept = [e for e in FIRST] + [event("product_view", "00:20:00", "s9"), event("product_view", "00:19:30", "s8")]
    static = spark.createDataFrame([tuple(e.get(c) for c in schemas.struct(EVENT).names) for e in kept], EVENT)
    want = windows(streams.window_metrics(messages.event_time(static)))
    assert got == want


def test_counters_upsert_running_totals(spark, tmp_path):
    src = tmp_path / "in"
    arm = {"experiment_id": "e", "variant": "control"}
    land(src, "a.json", [event("product_view", "00:00:01", "s", **arm), event("add_to_cart", "00:00:02", "s", **arm)])
    land(src, "b.json", [event("order_placed", "00:00:03", None, 7.5, **arm), event("search", "00:00:03", "s")])
    land(src, "c.json", [event("session_start", "00:00:04", "t", experiment_id="e", variant="treatment")])
    query = runtime.start_upsert(
        streams.experiment_counters(stream_of(spark, src)),
        str(tmp_path / "t"),
        str(tmp_path / "cp"),
        ["experiment_id", "variant"],
        ["impressions"],
    )
    query.awaitTermination()
    got = {r.variant: (r.impressions, r.clicks, r.conversions, r.revenue) for r in sinks.read_upserted(spark, str(tmp_path / "t")).collect()}
    assert got == {"control": (1, 1, 1, 7.5), "treatment": (1, 0, 0, 0.0)}
    progress = runtime.progress_metrics(query, spark).collect()
    assert sum(r.total_processed for r in progress) == 5 and all(r.error_rate_per_1k == 0 for r in progress)


def test_live_significance(spark):
    rows = [
        ("won", "control", 6000, 600),
        ("won", "treatment", 6000, 720),
        ("small", "control", 4999, 100),
        ("small", "treatment", 6000, 900),
        ("one_arm", "control", 9000, 100),
        ("tie", "control", 6000, 600),
        ("tie", "treatment", 6000, 600),
    ]
    df = spark.createDataFrame(rows, "experiment_id string, variant string, impressions long, conversions long")
    got = {r.experiment_id: r.winner for r in streams.live_significance(df).collect()}
    assert got == {"won": "treatment", "tie": None}


def deliveries():
    def at(order, kind, day, hour=0):
        return {"event_type": kind, "order_id": order, "seller_id": "v", "timestamp": f"2024-01-{day:02d}T{hour:02d}:00:00Z"}

    return [
        at("on_time", "shipped", 1),
        at("on_time", "delivered", 4),  # exactly 3.0 days
        at("late", "shipped", 1),
        at("late", "delivered", 4, 3),  # 3.125 days
        at("very_late", "delivered", 8, 3),  # 7.125 days, arrives first
        at("very_late", "shipped", 1),
        at("lost", "delivered", 9),
    ]


ALERTS = {"late": ("warning", 3.1, 0.1), "very_late": ("critical", 7.1, 4.1)}


def alerts(df):
    return {r.order_id: (r.alert_severity, r.days_to_deliver, r.days_late) for r in df.collect()}


def test_delivery_alerts(spark):
    rows = [tuple(e.get(c) for c in schemas.struct(EVENT).names) for e in deliveries()]
    twice = spark.createDataFrame(rows + rows, EVENT)  # delivered twice: same alerts
    assert alerts(streams.delivery_alerts(messages.event_time(twice))) == ALERTS


def test_delivery_alerts_streamed(spark, tmp_path):
    src = tmp_path / "in"
    for i, e in enumerate(deliveries()):
        land(src, f"{i}.json", [e])
    # The delay covers how much earlier than the newest event a message may be.
    out = streams.delivery_alerts_stream(stream_of(spark, src), delay="10 days")
    runtime.start_append(out, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert alerts(spark.read.schema(out.schema).parquet(str(tmp_path / "out"))) == ALERTS


def test_enrichment_flags_unknown_customers(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", 5.0, "placed", "order_placed"), ("o2", "c2", None, None, None)],
        "order_id string, customer_id string, order_total double, order_status string, event_type string",
    ).selectExpr("*", "null AS experiment_id", "null AS variant", "timestamp'2024-01-01' AS event_timestamp")
    known = spark.createDataFrame([("c1", "x", "SP", "vip")], "customer_id string, city string, state string, customer_tier string")
    ops, ana = streams.enrich_orders(orders, known)
    got = {r.order_id: (r.customer_state, r.order_total, r.order_status, r.event_type, r.needs_enrichment) for r in ops.collect()}
    assert got["o1"] == ("SP", 5.0, "placed", "order_placed", False)
    assert got["o2"] == ("unknown", 0.0, "unknown", "order_placed", True)
    tiers = {r.order_id: (r.customer_tier, r.customer_state) for r in ana.collect()}
    assert tiers == {"o1": ("vip", "SP"), "o2": (None, None)}


def test_validation_splits_dead_letters(spark):
    raw = spark.createDataFrame(
        [('{"order_id":"1","customer_id":"c"}',), ('{"order_id":"2"}',), ("{}",), ("not json",)], "value string"
    )
    parsed = topics.parse_messages(raw, schemas.TOPICS["orders"])
    good, dead = messages.validate(parsed, ["order_id", "customer_id"], "orders")
    assert [r.order_id for r in good.collect()] == ["1"]
    got = {r.original_message: r.error_reason for r in dead.collect()}
    assert got == {
        '{"order_id":"2"}': "Missing customer_id",
        "{}": "Message must be a non-empty dict",
        "not json": "Message must be a non-empty dict",
    }


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, t int, v string"
    batch = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "x")], schema)
    sinks.upsert(path, batch, ["k"], ["t"])
    once = sorted(map(tuple, sinks.read_upserted(spark, path).collect()))
    sinks.upsert(path, batch, ["k"], ["t"])
    assert sorted(map(tuple, sinks.read_upserted(spark, path).collect())) == once == [("a", 2, "new"), ("b", 1, "x")]
    sinks.upsert(path, spark.createDataFrame([("b", 2, "y"), ("c", 1, "z")], schema), ["k"], ["t"])
    assert sorted(map(tuple, sinks.read_upserted(spark, path).collect())) == [("a", 2, "new"), ("b", 2, "y"), ("c", 1, "z")]


def test_upsert_keeps_the_newest_row_whatever_the_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"k{i % 17}", (i * 7919) % 101, f"v{i}") for i in range(200)]
    schema = "k string, t int, v string"
    for n in range(0, 200, 25):
        sinks.upsert(path, spark.createDataFrame(rows[n : n + 25], schema), ["k"], ["t"], n // 25, "src", buckets=5)
    want = sorted(max((r for r in rows if r[0] == f"k{k}"), key=lambda r: r[1:]) for k in range(17))
    assert sorted(map(tuple, sinks.read_upserted(spark, path).collect())) == want
    # a batch that was delivered before is skipped, another source's is not
    late = spark.createDataFrame([("k0", 1000, "again")], schema)
    sinks.upsert(path, late, ["k"], ["t"], 3, "src")
    assert sorted(map(tuple, sinks.read_upserted(spark, path).collect())) == want
    sinks.upsert(path, late, ["k"], ["t"], 3, "other")
    assert ("k0", 1000, "again") in set(map(tuple, sinks.read_upserted(spark, path).collect()))
    # one key touches one bucket; the others stay where they were
    assert len([d for d in (tmp_path / "t" / "data" / "v=8").iterdir() if d.is_dir()]) == 1


def test_stream_results_do_not_depend_on_the_files(spark, tmp_path, small):
    from agorakit.plans import realtime
    from agorakit.plans.tables import Model

    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(350, F.rand(3)).write.parquet(str(tmp_path / "events.parquet"))
    many, one = Model(spark, str(tmp_path)), Model(spark, small)
    for run in (realtime._run_latest_orders, realtime._run_windows, realtime._run_counters):
        assert sorted(map(repr, run(many).collect())) == sorted(map(repr, run(one).collect())), run.__name__


def test_orders_never_delivered_leave_the_stream_with_an_alert(spark, tmp_path):
    src = tmp_path / "in"
    shipped = {"event_type": "shipped", "timestamp": "2024-01-01T00:00:00Z"}
    land(src, "a.json", [{**event("shipped", "00:00:00", None), **shipped, "order_id": "lost"}])
    later = {**event("delivered", "00:00:00", None), "timestamp": "2024-06-01T00:00:00Z", "order_id": "other"}
    land(src, "b.json", [later, {**later, "event_type": "shipped"}])
    land(src, "c.json", [{**later, "order_id": "more"}, {**later, "event_type": "shipped", "order_id": "more"}])
    out = streams.delivery_alerts_stream(stream_of(spark, src))
    runtime.start_append(out, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    found = spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect()
    assert [(r.order_id, r.delivered_at, r.is_late, r.alert_severity) for r in found] == [("lost", None, True, "critical")]


def test_restart_from_the_checkpoint_reads_only_new_files(spark, tmp_path):
    src, path, cp = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "cp")

    def run():
        df = stream_of(spark, src).select("customer_id", "event_timestamp", "order_total")
        query = runtime.start_upsert(df, path, cp, ["customer_id"], ["event_timestamp"], mode="append")
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    land(src, "a.json", [event("order_placed", "00:00:01", None, 1.0, customer_id="c")])
    assert run() == 1
    assert run() == 0
    land(src, "b.json", [event("order_placed", "00:00:02", None, 2.0, customer_id="c")])
    assert run() == 1
    assert [r.order_total for r in sinks.read_upserted(spark, path).collect()] == [2.0]


def test_retries_then_dead_letters(spark):
    batch = spark.createDataFrame([("a",), ("b",)], "k string")
    seen, pauses, dead = [], [], []

    def failing(df, batch_id):
        seen.append(batch_id)
        raise RuntimeError("down")

    run = runtime.with_retries(failing, lambda df, i: dead.extend(df.collect()), 3, "orders", pauses.append)
    run(batch, 7)
    assert seen == [7, 7, 7] and pauses == [1.0, 2.0]
    assert {r.error_reason for r in dead} == {"processing_failed_after_retries"} and len(dead) == 2
    assert {r.error_message for r in dead} == {"down"}
    flaky = iter([RuntimeError("once"), None])

    def sometimes(df, batch_id):
        problem = next(flaky)
        if problem:
            raise problem

    dead.clear()
    runtime.with_retries(sometimes, lambda df, i: dead.extend(df.collect()), 3, "orders", pauses.append)(batch, 8)
    assert not dead


def test_progress_counts_failed_messages(spark, tmp_path):
    src = tmp_path / "in"
    land(src, "a.json", [event("x", "00:00:01", customer_id="c"), event("x", "00:00:02")])
    parsed = stream_of(spark, src)
    watched = runtime.observe_failures(parsed, F.col("customer_id").isNull())
    listener = runtime.ProgressListener()
    query = runtime.start_append(watched.select("customer_id"), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    rows = runtime.progress_metrics(query, spark).where("total_processed > 0 or total_failed > 0").collect()
    assert [(r.total_processed, r.total_failed, r.error_rate_per_1k) for r in rows] == [(1, 1, 500.0)]
    assert listener.frame(spark).columns == runtime.progress_metrics(query, spark).columns


def test_replay_keeps_order_and_span(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00",), ("2020-01-06 00:00:00",), ("2020-01-11 00:00:00",)], "t string")
    got = messages.replayed(df.selectExpr("cast(t as timestamp) event_time"), "2024-01-01 00:00:00", 48).orderBy("event_time")
    assert [str(r.replay_at) for r in got.collect()] == ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]
    single = messages.replayed(df.limit(1).selectExpr("cast(t as timestamp) event_time"), "2024-01-01 00:00:00")
    assert str(single.collect()[0].replay_at) == "2024-01-01 00:00:00"


def test_events_as_topic_json(spark):
    orders = spark.createDataFrame([("o1", "2020-01-01 00:00:00", None)], "order_id string, p string, d string").selectExpr(
        "order_id", "cast(p as timestamp) order_purchase_timestamp", "cast(d as timestamp) order_delivered_customer_date"
    )
    values = [json.loads(r.value) for r in messages.as_json(messages.delivery_events(orders)).collect()]
    assert [(v["event_type"], v["timestamp"]) for v in values] == [
        ("shipped", "2020-01-03T00:00:00Z"),
        ("in_transit", "2020-01-05T00:00:00Z"),
        ("out_for_delivery", "2020-01-10T00:00:00Z"),
        ("delivered", "2020-01-11T00:00:00Z"),
    ]


def test_kafka_scan_names_its_source(spark):
    """No broker and no connector here: the scan must fail on the missing source, not earlier."""
    with pytest.raises(Exception, match="kafka"):
        topics.read_topic(spark, "orders", schemas.TOPICS["orders"], "localhost:1")


def test_window_settings():
    assert fixed.WINDOW_SIZE == "5 minutes" and fixed.WINDOW_GRACE == "60 seconds"


def test_parquet_stream_of_a_file_whose_name_is_a_pattern(spark, tmp_path):
    import pandas as pd

    for name, n in (("part[1].parquet", 3), ("part1.parquet", 5), ("a{b,c}*.parquet", 2), ("abx.parquet", 7)):
        pd.DataFrame({"x": range(n)}).to_parquet(tmp_path / name)
    for name, n in (("part[1].parquet", 3), ("a{b,c}*.parquet", 2)):
        stream = topics.read_parquet_stream(spark, str(tmp_path / name))
        query = stream.writeStream.format("memory").queryName(f"named_{n}").trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.table(f"named_{n}").count() == n
