"""Stream operators that keep state of their own per key and act on event-time timers."""

from __future__ import annotations

import contextlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from agorakit.functions import fixed, half_up

# Processors travel to the executors with the query; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_DAY = 86_400_000_000
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_NONE = np.iinfo(np.int64).min  # a time that is not known
_COLUMNS = ("order_id", "shipped", "delivered", "seller", "sent", "revision", "stage")
_STATE = "orders binary, timer long"
_CHANGED = "order_id string, seller_id string, shipped long, delivered long, raised long, severity string, revision long"
BUCKETS = 1024  # groups of orders whose state is one value


@contextlib.contextmanager
def timer_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which timers need; the session's setting comes back after."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def _packed(orders: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(orders, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes | None) -> pd.DataFrame:
    if blob is None:
        kinds = {"order_id": object, "seller": object, "sent": bool}
        return pd.DataFrame({c: np.zeros(0, kinds.get(c, np.int64)) for c in _COLUMNS})
    table = pa.ipc.open_stream(blob).read_all()
    return pd.DataFrame({c: table[c].to_numpy() for c in _COLUMNS})


class DeliveryMonitor(StatefulProcessor):
    """The orders of a bucket: shipped, maybe delivered. Times are microseconds, timers milliseconds.

    Reading or writing a state value or a timer is a call from the worker to Spark. A bucket makes the same few of them
    however many orders it has: its state is one value, and it has one timer, at the first time one of its orders is due.
    ``stage`` tells what a shipped order waits for: 0 the warning, 1 the critical alert, 2 nothing.
    """

    def __init__(self, late: int, critical: int, keep: int | None) -> None:
        self.late, self.critical, self.keep = late, critical, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("orders", _STATE)

    def _load(self) -> tuple[pd.DataFrame, int | None]:
        blob, timer = self.state.get() or (None, None)
        return _unpacked(blob), timer

    def _due(self, s: pd.DataFrame) -> np.ndarray:
        """When each order is due, in milliseconds; never is the largest number."""
        shipped, delivered, stage = (s[c].to_numpy() for c in ("shipped", "delivered", "stage"))
        due = np.full(len(s), np.iinfo(np.int64).max)
        done = (shipped != _NONE) & (delivered != _NONE)
        if self.keep is not None:
            due[done] = (np.maximum(shipped, delivered)[done] + self.keep) // 1000
        for waits, after in ((0, self.late), (1, self.critical)):
            at = (shipped != _NONE) & (delivered == _NONE) & (stage == waits)
            due[at] = (shipped[at] + after) // 1000
        return due

    def _store(self, s: pd.DataFrame, timer: int | None) -> None:
        due = self._due(s)
        first = int(due.min()) if len(s) else np.iinfo(np.int64).max
        due_at = first if first < np.iinfo(np.int64).max else None
        if timer != due_at:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due_at is not None:
                self.handle.registerTimer(due_at)
        if len(s):
            self.state.update((_packed(s), due_at))
        else:
            self.state.clear()

    @staticmethod
    def _rows(s: pd.DataFrame, raised: np.ndarray, severity: str | None) -> pd.DataFrame:
        def known(values: np.ndarray) -> pd.Series:
            return pd.Series(values, dtype="Int64").mask(values == _NONE)

        return pd.DataFrame(
            {
                "order_id": s["order_id"].to_numpy(),
                "seller_id": s["seller"].to_numpy(),
                "shipped": known(s["shipped"].to_numpy()),
                "delivered": known(s["delivered"].to_numpy()),
                "raised": known(raised),
                "severity": np.full(len(s), severity, object),
                "revision": s["revision"].to_numpy(),
            }
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        s, timer = self._load()
        new = pd.concat([r[["order_id", "kind", "at", "seller"]] for r in rows], ignore_index=True)
        known = pd.Index(s["order_id"])
        orders = known.append(pd.Index(new["order_id"].unique()).difference(known, sort=False))
        place = orders.get_indexer(new["order_id"])
        fresh = len(orders) - len(s)
        if fresh:
            start = {"shipped": _NONE, "delivered": _NONE, "seller": np.full(fresh, None, object), "sent": False, "revision": 0, "stage": 0}
            more = pd.DataFrame({"order_id": orders[len(s) :].to_numpy()} | start)
            s = pd.concat([s, more], ignore_index=True) if len(s) else more
        changed = np.zeros(len(s), bool)
        for kind in ("shipped", "delivered"):
            of = (new["kind"] == kind).to_numpy()
            times = s[kind].to_numpy().copy()
            np.maximum.at(times, place[of], new["at"].to_numpy(np.int64)[of])
            changed |= times != s[kind].to_numpy()
            s[kind] = times
        named = new["seller"].notna().to_numpy()
        if named.any():
            seller = s["seller"].to_numpy(object).copy()
            best = new["seller"][named].groupby(place[named]).max()
            for i, name in zip(best.index, best):
                if seller[i] is None or name > seller[i]:
                    seller[i], changed[i] = name, True
            s["seller"] = seller
        if not changed.any():
            return
        shipped, delivered = s["shipped"].to_numpy(), s["delivered"].to_numpy()
        s["stage"] = np.where(changed, 0, s["stage"].to_numpy())
        done = changed & (shipped != _NONE) & (delivered != _NONE)
        # an order in time is only told if an alert was sent before
        told = done.copy()
        told[done] = s["sent"].to_numpy()[done] | (delivered[done] - shipped[done] > self.late)
        s["sent"] = s["sent"].to_numpy() | told
        s["revision"] = s["revision"].to_numpy() + told
        self._store(s, timer)
        if told.any():
            yield self._rows(s[told], delivered[told], None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s, timer = self._load()
        at = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        if timer is None or timer > at:
            return
        out = []
        gone = (s["delivered"].to_numpy() != _NONE) & (self._due(s) <= at)
        s = s[~gone].reset_index(drop=True)
        for waits, after, severity in ((0, self.late, "warning"), (1, self.critical, "critical")):
            hit = (s["stage"].to_numpy() == waits) & (self._due(s) <= at) & (s["delivered"].to_numpy() == _NONE)
            if hit.any():
                s["sent"] = s["sent"].to_numpy() | hit
                s["revision"] = s["revision"].to_numpy() + hit
                s["stage"] = s["stage"].to_numpy() + hit
                out.append(self._rows(s[hit], s["shipped"].to_numpy()[hit] + after, severity))
        # the timer that fired is gone
        self._store(s, timer if timer != expiredTimerInfo.getExpiryTimeInMs() else None)
        yield from out

    def close(self) -> None:
        pass


def late_orders(events: DataFrame, delay: str = "1 day", keep_days: int | None = 90, buckets: int = BUCKETS) -> DataFrame:
    """Alerts of a running stream, raised by the passing of time and closed by a delivery, however late.

    ``events``: order_id, event_type, event_timestamp and optionally seller_id. An order shipped and not delivered gets a
    warning when event time passes day 3 and a critical alert at day 7, both without a delivery time; its
    delivery closes the alert with the days it took. ``revision`` counts the rows of an order: upsert by order_id with
    the highest revision, and keep ``is_late``. Rows that end as not late take back an alert that came too
    early, because a delivery was read after later events.

    No event is dropped as late. Event time is taken from copies of the events that pass the watermark only,
    so it moves on while the events themselves have no time that could fall behind it. A delivered order leaves the state
    ``keep_days`` after its delivery (never, if None), when nothing about it is expected any more.

    State is one value for each of ``buckets`` groups of orders by a hash of order_id, and a batch writes the groups it has
    orders of anew: more buckets for many open orders and small batches. A checkpoint goes with the number it was begun with.
    """
    seller = F.col("seller_id") if "seller_id" in events.columns else F.lit(None)
    steps = events.where(F.col("event_type").isin("shipped", "delivered") & F.col("event_timestamp").isNotNull() & F.col("order_id").isNotNull()).select(
        "order_id",
        F.col("event_type").alias("kind"),
        F.unix_micros("event_timestamp").alias("at"),
        seller.cast("string").alias("seller"),
        F.pmod(F.xxhash64("order_id"), F.lit(buckets)).alias("bucket"),
        F.explode(F.array(F.lit(None).cast("timestamp"), F.col("event_timestamp"))).alias("clock"),
    )
    timed = steps.withWatermark("clock", delay).where(F.col("clock").isNull())
    monitor = DeliveryMonitor(
        fixed.SLA_DAYS * _DAY, fixed.SLA_CRITICAL_DAYS * _DAY, None if keep_days is None else keep_days * _DAY
    )
    changes = timed.groupBy("bucket").transformWithStateInPandas(monitor, _CHANGED, "Update", "EventTime")

    def moment(name: str) -> Column:
        return F.timestamp_micros(name)

    days = (F.col("delivered") - F.col("shipped")) / F.lit(float(_DAY))
    return changes.select(
        "order_id",
        "seller_id",
        moment("shipped").alias("shipped_at"),
        moment("delivered").alias("delivered_at"),
        half_up(days, 1).alias("days_to_deliver"),
        half_up(days - F.lit(fixed.SLA_DAYS), 1).alias("days_late"),
        F.coalesce(days > fixed.SLA_DAYS, F.lit(True)).alias("is_late"),
        F.coalesce("severity", F.when(days > fixed.SLA_CRITICAL_DAYS, "critical").otherwise("warning")).alias("alert_severity"),
        moment("raised").alias("created_at"),
        "revision",
    )
