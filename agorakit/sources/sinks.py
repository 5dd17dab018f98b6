"""Sinks: partition overwrite, idempotent upsert, dead letters, exports, retention."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from agorakit.functions.grouping import first_per


def write_mart(df: DataFrame, path: str, partition: str | None = None, cluster: Sequence[str] = ()) -> None:
    """Overwrite a mart, or only the partitions present in ``df``.

    Rows of a partition come together for writing, but the rebalance lets AQE
    split a large partition over several files and merge small ones. ``cluster``
    sorts inside each file, so parquet min/max skipping works on those columns.
    """
    if partition:
        df = df.hint("rebalance", partition)
    if cluster or partition:
        df = df.sortWithinPartitions(*([partition] if partition else []), *cluster)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def read_mart(spark: SparkSession, path: str, partition: str, start: str, end: str) -> DataFrame:
    """A partitioned mart; a partition range is mandatory so no caller scans all of it."""
    if not start or not end:
        raise ValueError(f"a range of {partition} is required")
    return spark.read.parquet(path).where(F.col(partition).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def expire(df: DataFrame, column: str, days: int, now: datetime | str) -> DataFrame:
    """Rows younger than the retention period."""
    return df.where(F.col(column) >= F.lit(now).cast("timestamp") - F.make_dt_interval(days=F.lit(days)))


BUCKETS = 64


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """Number and content of the newest complete manifest (complete once ``_SUCCESS`` exists)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path}/manifest")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    found = [
        int(s.getPath().getName()[2:])
        for s in fs.listStatus(root)
        if s.getPath().getName().startswith("v=") and fs.exists(hadoop.Path(s.getPath(), "_SUCCESS"))
    ]
    if not found:
        return None
    return max(found), json.loads(spark.read.text(f"{path}/manifest/v={max(found)}").first()[0])


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_upserted(spark: SparkSession, path: str, keys: DataFrame | Sequence | None = None) -> DataFrame:
    """Current content of a table kept by :func:`upsert`, or only the rows of some keys.

    ``keys`` is a frame with columns of the table, among them those that choose the bucket, or, where one column does, a
    list of its values. Only the buckets that can hold them are opened: a lookup of one key reads one folder, and a list is also pushed to
    the files as a filter. Keys that the table lacks give no row.
    """
    found = _manifest(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    manifest = found[1]
    schema = StructType.fromJson(manifest["schema"])
    folders = manifest["buckets"]
    wanted = None
    if keys is not None:
        dealt_by = manifest["bucket_by"]
        if not isinstance(keys, DataFrame):
            if len(dealt_by) != 1:
                raise ValueError(f"the table's rows are found by {dealt_by}; give a frame of keys")
            wanted = [F.lit(k).cast(schema[dealt_by[0]].dataType) for k in keys]
            if not wanted:
                return spark.createDataFrame([], schema)
            keys = spark.range(1).select(F.explode(F.array(*wanted)).alias(dealt_by[0]))
        keys = keys.select([F.col(c).cast(schema[c].dataType).alias(c) for c in keys.columns]).distinct()
        hit = {str(r[0]) for r in keys.select(_bucket_of(dealt_by, manifest["n"])).distinct().collect()}
        folders = {b: v for b, v in folders.items() if b in hit}
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{path}/data/v={v}/_bucket={b}" for b, v in sorted(folders.items())])
    if wanted is not None:
        return rows.where(F.col(manifest["bucket_by"][0]).isin(wanted))
    return rows if keys is None else rows.join(keys, keys.columns, "left_semi")


def _drop_unused(spark: SparkSession, path: str, kept: Sequence[dict]) -> None:
    """Delete bucket folders that neither of the ``kept`` manifests names."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path}/data")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):  # no batch had rows yet
        return
    used = {f"v={v}/_bucket={b}" for m in kept for b, v in m["buckets"].items()}
    oldest = min(m["version"] for m in kept)
    for s in fs.listStatus(root):
        version = s.getPath().getName()
        if not version.startswith("v=") or int(version[2:]) > oldest:
            continue
        buckets = [x.getPath() for x in fs.listStatus(s.getPath()) if x.getPath().getName().startswith("_bucket=")]
        unused = [x for x in buckets if f"{version}/{x.getName()}" not in used]
        for x in [s.getPath()] if len(unused) == len(buckets) else unused:
            fs.delete(x, True)


def upsert(
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    batch_id: int | None = None,
    source: str | None = None,
    buckets: int = BUCKETS,
    bucket_by: Sequence[str] | None = None,
) -> None:
    """Upsert into a parquet table; the row with the highest ``order`` of each key stays, stored or new.

    The table is cut into buckets by a hash of the key, and only buckets that the batch has keys of are read
    and written again. A manifest names the version of every bucket; readers see a version only when its
    manifest is complete, so a lost executor leaves no trace. The merge gives the same table for
    any cut of the input into batches and for a re-delivery; a re-delivered ``batch_id`` of a named ``source``
    is skipped. ``bucket_by`` (some of the keys, else all) are the columns whose hash gives the bucket: lookups need
    them. ``buckets`` and ``bucket_by`` count for the first batch only.
    """
    spark = batch.sparkSession
    found = _manifest(spark, path)
    first = {"version": -1, "buckets": {}, "delivered": {}, "n": buckets, "bucket_by": list(bucket_by or keys)}
    version, old = found if found else (-1, first)
    dealt_by = old.get("bucket_by", list(keys))
    if source is not None and batch_id is not None and old["delivered"].get(source, -1) >= batch_id:
        return
    rank = [*order, *[c for c in batch.columns if c not in keys and c not in order]]
    newest = first_per(batch, keys, rank, False)
    bucket = _bucket_of(dealt_by, old["n"]).alias("_bucket")
    # the batch is read for its buckets and for the merge; it is kept so that the source is read once
    newest.persist()
    try:
        touched = {str(r[0]) for r in newest.select(bucket).distinct().collect()}
        folders = [f"{path}/data/v={v}/_bucket={b}" for b, v in old["buckets"].items() if b in touched]
        merged = newest
        if folders:
            stored = spark.read.schema(newest.schema).parquet(*folders)
            merged = first_per(stored.unionByName(newest), keys, rank, False)
        if touched:
            dealt = merged.select("*", bucket).hint("rebalance", "_bucket")
            dealt.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/data/v={version + 1}")
    finally:
        newest.unpersist()
    new = {
        "version": version + 1,
        "n": old["n"],
        "bucket_by": dealt_by,
        "schema": json.loads(newest.schema.json()),
        "buckets": old["buckets"] | dict.fromkeys(touched, version + 1),
        "delivered": old["delivered"] | ({source: batch_id} if source is not None and batch_id is not None else {}),
    }
    text = spark.createDataFrame([(json.dumps(new),)], "value string").coalesce(1)
    text.write.mode("overwrite").text(f"{path}/manifest/v={version + 1}")
    # the version before stays for readers already on it
    if version >= 0:
        _drop_unused(spark, path, [old, new])


def upsert_sink(path: str, keys: Sequence[str], order: Sequence[str], source: str | None = None):
    """``foreachBatch`` function that upserts every micro-batch. ``source`` names the query's checkpoint, if re-delivered batches are to be skipped."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(path, batch, keys, order, batch_id, source)

    return write


def split_dlq(df: DataFrame, rules: Mapping[str, Column], consumer: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows as dead letters.

    ``rules`` maps a reason to the condition under which a row is *bad*; the
    first matching reason is reported.
    """
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    tagged = df.withColumn("_reason", reason)
    good = tagged.where(F.col("_reason").isNull()).drop("_reason")
    original = F.col("_raw") if "_raw" in df.columns else F.to_json(F.struct(*df.columns))
    dlq = tagged.where(F.col("_reason").isNotNull()).select(
        original.alias("original_message"),
        F.col("_reason").alias("error_reason"),
        F.lit(consumer).alias("consumer"),
        F.current_timestamp().alias("timestamp"),
    )
    return good, dlq


def write_results(df: DataFrame, path: str) -> None:
    """JSON results, one folder per experiment."""
    df.write.mode("overwrite").partitionBy("experiment_id").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
