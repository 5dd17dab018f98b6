"""Fixed-size counter arrays that tasks fill and Spark adds up."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "counts binary"
ARROW = pa.schema([("counts", pa.binary())])


def packed(counts: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(counts).tobytes(), 1)


def unpacked(blob: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), dtype)


def added(frame: DataFrame, dtype, union: bool = False) -> np.ndarray | None:
    """Sum (or bitwise or) of all arrays in the column ``counts``; None when there is none.

    Two levels: about a fourth of the shuffle partitions first, then one task over one
    array each. Every task streams and holds one array; only the one total,
    whose size does not depend on the data, reaches the driver.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for blob in batch.column(0):
                own = unpacked(blob.as_py(), dtype)
                if total is None:
                    total = own.copy()
                elif union:
                    total |= own
                else:
                    total += own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([packed(total)], pa.binary())], schema=ARROW)

    first = max(1, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    rows = (
        frame.select("counts").where("counts is not null")
        .repartition(first).mapInArrow(add, SCHEMA)
        .repartition(1).mapInArrow(add, SCHEMA)
        .collect()
    )
    return unpacked(bytes(rows[0][0]), dtype).copy() if rows else None
