"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table: slot
``(offset + j * skip) mod size`` for j = 0, 1, ... In turns, each shard claims its
first slot that is still free, until the table is full. Shards so own equal shares (within one slot of each other),
and when a shard leaves, few slots of the others change hands. A row's place is
one look at the table, by the hash of its key.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLE = 65_537  # prime; fixed, so the broadcast table has the same size for any input
SHARDS = 64


def _number(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big")


def fill(shards: list[str], size: int = TABLE) -> list[int]:
    """Index of the shard that owns each slot."""
    if not shards or len(shards) > size:
        raise ValueError("between one shard and as many as slots are needed")
    if len(set(shards)) < len(shards):
        raise ValueError("shard names must differ")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be prime")
    place = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    owner = [-1] * size
    left = size
    while True:
        for i in range(len(shards)):
            while owner[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % size
            owner[place[i]] = i
            left -= 1
            if not left:
                return owner


def lookup_table(spark: SparkSession, shards: list[str], size: int = TABLE) -> DataFrame:
    """(slot, shard_id, shard): at most ``size`` rows, whatever the data."""
    owner = fill(shards, size)
    return spark.createDataFrame(
        [(slot, i, shards[i]) for slot, i in enumerate(owner)], "slot long, shard_id int, shard string"
    )


def place(df: DataFrame, key: str, shards: list[str], size: int = TABLE) -> DataFrame:
    """``df`` with slot, shard_id and shard by the hash of the column ``key``.

    Rows with equal keys share a shard; null keys are one key. No row is moved or
    dropped, repeated rows stay repeated. Columns of ``df`` named slot, shard_id or shard are replaced.
    """
    slot = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(size))
    table = lookup_table(df.sparkSession, shards, size)
    out = df.drop("slot", "shard_id", "shard").withColumn("slot", slot)
    columns = [c for c in out.columns if c != "slot"]
    return out.join(F.broadcast(table), "slot", "left").select(*columns, "slot", "shard_id", "shard")


def documents_placed(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, n_bytes (of the text, 0 if null), slot, shard_id, shard for every document, placed by doc_id."""
    names = [f"shard-{i:04d}" for i in range(shards)]
    sized = docs.select("doc_id", F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"))
    return place(sized, "doc_id", names)


def write_shards(df: DataFrame, path: str) -> None:
    """Write placed rows as one folder per shard. Rows are dealt by slot, so a shard's rows come from many tasks."""
    df.repartition("shard_id", "slot").write.mode("overwrite").partitionBy("shard_id").parquet(path)
