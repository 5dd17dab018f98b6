"""Running stream queries: retries with dead letters, upsert sinks, progress rows."""

from __future__ import annotations

import logging
import time
from collections import deque
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from agorakit.functions import fixed
from agorakit.sources.sinks import upsert_sink
from agorakit.streaming.operators import enrich_orders

log = logging.getLogger(__name__)

PROGRESS_SCHEMA = (
    "query string, batch_id long, total_processed long, throughput_per_sec double, avg_latency_ms double, "
    "total_failed long, dlq_sent long, error_rate_per_1k double, measured_at string"
)


def with_retries(
    process: Callable[[DataFrame, int], None],
    dead_letters: Callable[[DataFrame, int], None],
    attempts: int = 3,
    consumer: str = "consumer",
    pause: Callable[[float], None] = time.sleep,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: retry a failing batch with back-off, then send it to the dead letters.

    The offsets are committed by the checkpoint after the function returns, so a
    batch is delivered at least once and the sinks must be idempotent.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        message = ""
        for attempt in range(attempts):
            try:
                process(batch, batch_id)
                return
            except Exception as error:
                log.warning("%s: batch %d, attempt %d of %d: %s", consumer, batch_id, attempt + 1, attempts, error)
                message = str(error)
                if attempt < attempts - 1:
                    pause(float(2**attempt))
        original = F.col("_raw") if "_raw" in batch.columns else F.to_json(F.struct(*batch.columns))
        dead_letters(
            batch.select(
                original.alias("original_message"),
                F.lit(fixed.DLQ_RETRIES).alias("error_reason"),
                F.lit(message[:2000]).alias("error_message"),
                F.lit(consumer).alias("consumer"),
                F.current_timestamp().alias("timestamp"),
            ),
            batch_id,
        )

    return run


def append_sink(
    path: str, prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing what ``prepare`` makes of each batch to its own folder, so a re-delivery overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def enrich_sink(path: str, customers: Callable[[DataFrame], DataFrame], now: Column | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that enriches order messages and writes operational and analytic rows.

    ``customers`` is called with the ids of each batch and returns the dimension as it is then, so a customer that comes
    into the dimension is known from the next batch on. Reading an upserted table by these ids
    (``read_upserted(..., keys=ids)``) opens only the buckets that can hold them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        known = customers(batch.select("customer_id").where("customer_id is not null").distinct())
        for name, rows in zip(("operational", "analytic"), enrich_orders(batch, known, now)):
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")

    return write


def start_partials(stream: DataFrame, path: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Start a stateless query that writes each batch's partial aggregate; the reader adds them up. No row is ever late."""
    return (
        stream.writeStream.foreachBatch(append_sink(path, prepare))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_upsert(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], mode: str = "update"
) -> StreamingQuery:
    """Start a query that upserts its rows by key and stops once all present input is read."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(upsert_sink(path, keys, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _row(name: str, progress: dict, failed: int = 0) -> tuple:
    processed = int(progress.get("numInputRows", 0))
    duration = float(progress.get("durationMs", {}).get("triggerExecution", 0))
    # a message counted as failed is one the validation metric of df.observe() saw
    observed = (progress.get("observedMetrics") or {}).get("messages") or {}
    bad = int(observed.get("failed", failed) or 0) if isinstance(observed, dict) else failed
    return (
        name,
        int(progress.get("batchId", 0)),
        processed - bad,
        round(processed / (duration / 1000.0), 2) if duration else 0.0,
        round(duration / processed, 2) if processed else 0.0,
        bad,
        bad,
        round(bad / processed * 1000.0, 2) if processed else 0.0,
        str(progress.get("timestamp", "")),
    )


def observe_failures(parsed: DataFrame, bad) -> DataFrame:
    """Count bad messages while they stream by; the count shows up in the query progress."""
    return parsed.observe("messages", F.count_if(bad).alias("failed"), F.count(F.lit(1)).alias("seen"))


def progress_metrics(query: StreamingQuery, spark: SparkSession) -> DataFrame:
    """Throughput, latency and error figures of the recent micro-batches (at most 100 are kept by Spark)."""
    rows = [_row(query.name or str(query.id), _as_dict(p)) for p in query.recentProgress]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def _as_dict(progress) -> dict:
    import json

    return progress if isinstance(progress, dict) and not hasattr(progress, "json") else json.loads(progress.json)


class ProgressListener(StreamingQueryListener):
    """Keeps the last figures of all queries of a session."""

    def __init__(self, keep: int = 1000) -> None:
        self.rows: deque[tuple] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.rows.append(_row(progress.name or str(progress.id), _as_dict(progress)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), PROGRESS_SCHEMA)
