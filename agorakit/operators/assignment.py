"""Deterministic experiment assignment and keyed sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agorakit.functions.grouping import spread
from agorakit.functions.scalar import hash_mod

TASK_ROWS = 1 << 17  # assignments of one task


def arm_of(customer: Column, experiment: Column) -> Column:
    """Arm by the parity of SHA-256 over customer and experiment: even is control.

    The parity of the 256-bit number is that of its last hex digit.
    """
    last = F.substring(F.sha2(F.concat_ws("|", customer, experiment), 256), -1, 1)
    return F.when(last.isin("0", "2", "4", "6", "8", "a", "c", "e"), "control").otherwise("treatment")


def assign(customers: DataFrame, experiments: Sequence[str], key: str = "customer_id") -> DataFrame:
    """Every customer in every experiment, one row each; no join is needed.

    Many customers are dealt by their key before they are multiplied: they may come in one small file, whose
    task would hold all assignments once they are grouped.
    """
    dealt = spread(customers, [key], max(1, TASK_ROWS // max(1, len(experiments))))
    return dealt.withColumn("experiment_id", F.explode(F.array(*[F.lit(e) for e in experiments]))).withColumn(
        "variant", arm_of(F.trim(F.col(key).cast("string")), F.col("experiment_id"))
    )


def hash_fraction(*parts: Column) -> Column:
    """A number in [0, 1) fixed by the key, in steps of 1/10000."""
    return hash_mod(F.concat_ws("|", *parts)) / F.lit(10_000.0)


def hash_sample(df: DataFrame, key: str, salt: str, rate: float | Column) -> DataFrame:
    """Keyed sample: a row is kept or dropped by its key alone, on every run alike."""
    limit = rate if isinstance(rate, Column) else F.lit(rate)
    return df.where(hash_fraction(F.col(key).cast("string"), F.lit(salt)) < limit)
