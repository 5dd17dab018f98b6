"""Session settings the operators rely on."""

from __future__ import annotations

import atexit
import contextlib
import functools
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings a running session accepts; everything else is left to the cluster.
RUNTIME_CONF = {
    # All wall-clock semantics (days, hours, ISO strings ending in Z) are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Row-level joins keep every row of a hot key, so let AQE split its partition
    # even where that costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Sessions of a busy user are merged in each task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("agorakit")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_runtime_conf(spark)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside gives Python workers at most ``rows`` rows at a time; the session's setting comes back after."""
    before = spark.conf.get(_BATCH_ROWS)
    if not 0 < int(before) <= rows:
        spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder for written intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a session whose driver
    and executors are one process may leave that unset: it gets a temporary
    folder, which goes when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _own_folder() -> str:
    path = tempfile.mkdtemp(prefix="agorakit-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several passes read as a table in the shared folder, and read it back.

    The table survives the loss of executors and cuts the lineage; the passes
    read only the columns they need.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the tables behind materialized frames that nothing reads any more."""
    for df in frames:
        folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
        for folder in folders:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def sweep(frame: DataFrame) -> None:
    """Give back the disk of finished passes: Spark removes a shuffle's files once the driver has collected the frames it belongs to."""
    gc.collect()
    frame.sparkSession.sparkContext._jvm.System.gc()
