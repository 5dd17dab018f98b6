"""Stateful stream operators with timers, on small landed files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from agorakit.sources import sinks, topics
from agorakit.streaming import messages, operators as streams, runtime, timers

EVENT = "event_type string, order_id string, seller_id string, timestamp string"
ALERTS = ["order_id", "seller_id", "shipped_at", "delivered_at", "days_to_deliver", "days_late", "is_late", "alert_severity", "created_at"]


def land(folder, name, events):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.writelines(json.dumps({"order_id": o, "event_type": k, "timestamp": f"{t}T00:00:00Z", "seller_id": "s"}) + "\n" for o, k, t in events)
    stamp = 1_700_000_000 + len(os.listdir(folder)) * 10
    os.utime(path, (stamp, stamp))


@pytest.fixture
def monitor(spark, tmp_path):
    """Reads what has landed since the last call and returns (rows sent, current table)."""

    def run(**more):
        stream = messages.event_time(topics.read_topic_files(spark, str(tmp_path / "in"), EVENT, max_files=1))
        out = timers.late_orders(stream, **more)
        sent = []

        def write(batch, batch_id):
            sent.extend(batch.collect())
            sinks.upsert(str(tmp_path / "table"), batch, ["order_id"], ["revision"], batch_id)

        with timers.timer_state(spark):
            query = (
                out.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            )
        query.awaitTermination()
        return sent, {r.order_id: r for r in sinks.read_upserted(spark, str(tmp_path / "table")).collect()}

    return run


def test_alert_at_day_three_raised_at_day_seven_closed_on_delivery(monitor, tmp_path):
    src = tmp_path / "in"
    land(src, "a.json", [("lost", "shipped", "2024-01-01"), ("slow", "shipped", "2024-01-01"), ("good", "shipped", "2024-01-01"), ("good", "delivered", "2024-01-03")])
    land(src, "b.json", [("x", "shipped", "2024-01-06"), ("x", "delivered", "2024-01-06")])
    sent, table = monitor()
    assert {(r.order_id, r.alert_severity, str(r.created_at)) for r in sent} == {(o, "warning", "2024-01-04 00:00:00") for o in ("lost", "slow")}
    assert all(r.delivered_at is None and r.is_late for r in table.values()) and set(table) == {"lost", "slow"}
    # the state and its timers outlive the query
    land(src, "c.json", [("y", "shipped", "2024-01-12"), ("y", "delivered", "2024-01-12")])
    sent, table = monitor()
    assert {(r.order_id, r.alert_severity) for r in sent} == {("lost", "critical"), ("slow", "critical")}
    land(src, "d.json", [("slow", "delivered", "2024-03-31")])
    _, table = monitor()
    assert (table["slow"].days_to_deliver, table["slow"].days_late, table["slow"].alert_severity) == (90.0, 87.0, "critical")
    assert str(table["slow"].delivered_at) == str(table["slow"].created_at) == "2024-03-31 00:00:00"
    assert table["lost"].delivered_at is None and table["lost"].alert_severity == "critical"


def test_delivery_read_after_later_events_takes_the_alert_back(monitor, tmp_path):
    src = tmp_path / "in"
    land(src, "a.json", [("early", "shipped", "2024-01-01")])
    land(src, "b.json", [("z", "shipped", "2024-06-01")])
    land(src, "b2.json", [("z", "delivered", "2024-06-01")])
    land(src, "c.json", [("early", "delivered", "2024-01-02"), ("before", "delivered", "2024-02-01")])
    land(src, "d.json", [("before", "shipped", "2024-01-20"), ("before", "shipped", "2024-01-20")])
    sent, table = monitor(keep_days=None)
    assert not table["early"].is_late and table["early"].days_to_deliver == 1.0
    assert table["before"].is_late and table["before"].days_to_deliver == 12.0
    history = [r for r in sent if r.order_id == "early"]
    assert history[0].alert_severity == "warning" and history[0].delivered_at is None
    assert [r.revision for r in history] == list(range(1, len(history) + 1)) and not history[-1].is_late


def test_equal_to_the_static_form_whatever_the_files(spark, tmp_path, small):
    from agorakit.plans.tables import Model

    events = Model(spark, small).deliveries.select("order_id", "seller_id", "event_type", "event_timestamp")
    late = spark.sql(
        "SELECT 'd90' order_id, 's9' seller_id, 'shipped' event_type, timestamp'1995-01-01' event_timestamp "
        "UNION ALL SELECT 'd90', 's9', 'delivered', timestamp'1995-04-01'"
    )
    both = events.unionByName(late)
    both.repartition(130, F.rand(5)).write.parquet(str(tmp_path / "events"))
    stream = timers.late_orders(topics.read_parquet_stream(spark, str(tmp_path / "events"), 50))
    with timers.timer_state(spark):
        query = runtime.start_upsert(stream, str(tmp_path / "t"), str(tmp_path / "cp"), ["order_id"], ["revision"])
    query.awaitTermination()
    found = sinks.read_upserted(spark, str(tmp_path / "t")).where("is_late and delivered_at is not null").select(*ALERTS)
    expected = streams.delivery_alerts(both).select(*ALERTS)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    assert found.where("order_id = 'd90' and days_to_deliver = 90").count() == 1


def test_the_setting_comes_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with timers.timer_state(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name, None) == before


def test_a_bucket_makes_few_calls_however_many_orders():
    import pandas as pd

    day, calls = 86_400_000_000, []

    class State:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def clear(self):
            calls.append("clear")
            self.value = None

    class Handle:
        timers: set[int] = set()

        def getValueState(self, name, schema):
            return State()

        def registerTimer(self, at):
            calls.append("register")
            self.timers.add(at)

        def deleteTimer(self, at):
            calls.append("delete")
            self.timers.discard(at)

    class Now:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

        def getExpiryTimeInMs(self):
            return min(Handle.timers)

    def rows(kind, times, seller=None):
        ids = [f"o{i}" for i in range(len(times))]
        return pd.DataFrame({"order_id": ids, "kind": kind, "at": times, "seller": pd.Series([seller] * len(times), dtype=object)})

    monitor = timers.DeliveryMonitor(3 * day, 7 * day, 90 * day)
    monitor.init(Handle())
    shipped = [i * day for i in range(1000)]
    assert not list(monitor.handleInputRows((1,), iter([rows("shipped", shipped[:500]), rows("shipped", shipped)]), None))
    assert Handle.timers == {3 * day // 1000}
    now = Now(100 * day // 1000 + 1)
    Handle.timers = {min(Handle.timers)}
    fired = pd.concat(monitor.handleExpiredTimer((1,), now, now))
    assert (fired.severity == "warning").sum() == 98 and (fired.severity == "critical").sum() == 94 and fired.delivered.isna().all()
    closed = pd.concat(monitor.handleInputRows((1,), iter([rows("delivered", [t + 2 * day for t in shipped], "s")]), None))
    # told: those with an alert; in time, so it is taken back
    assert len(closed) == 98 and set(closed.revision) == {2, 3} and set(closed.seller_id) == {"s"}
    assert not list(monitor.handleInputRows((1,), iter([rows("delivered", shipped)]), None))
    late = pd.concat(monitor.handleInputRows((1,), iter([rows("delivered", [t + 4 * day for t in shipped])]), None))
    assert len(late) == 1000 and (late.delivered - late.shipped == 4 * day).all()
    now = Now(10_000 * day // 1000)
    Handle.timers = {94 * day // 1000}
    assert not list(monitor.handleExpiredTimer((1,), now, now)) and monitor.state.value is None
    assert len(calls) < 30
