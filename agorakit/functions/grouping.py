"""Grouping helpers that keep working when one key holds a large share of the rows.

A window over a key sorts all rows of that key in one task. The helpers here
either combine map-side (aggregates instead of windows) or cut every key into
chunks of its order column and stitch the chunks through a small summary.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def spread(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` dealt by its keys, so that a task has about ``rows`` rows however many there are; up to ``rows`` stay as they are.

    What groups or joins by the keys later needs no other exchange, and holds what a task has, not what one file has.
    The rows are counted for it, which runs a job.
    """
    count = df.count()
    if count <= rows:
        return df
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, math.ceil(count / rows)), *keys)


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], ascending: bool = True) -> DataFrame:
    """First (or last) row per key, as an aggregate: hot keys shrink before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    pick = F.min_by if ascending else F.max_by
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), rank).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*df.columns)


def chunked_running_sum(
    counts: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], chunk: Column, suffix: str = "_before"
) -> DataFrame:
    """Exclusive running sums of ``values`` along ``order`` within ``keys``, in two levels.

    ``chunk`` must grow with ``order``. Each (key, chunk) is summed in its own
    task; only one row per chunk crosses to the key-wide prefix sum.
    """
    chunked = counts.withColumn("_chunk", chunk)
    inner = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*keys, "_chunk")
        .agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
        .select(*keys, "_chunk", *[F.coalesce(F.sum(f"_t_{v}").over(outer), F.lit(0)).alias(f"_off_{v}") for v in values])
    )
    within = chunked.select("*", *[F.coalesce(F.sum(v).over(inner), F.lit(0)).alias(f"_in_{v}") for v in values])
    joined = within.join(offsets, [*keys, "_chunk"])
    out = joined.select(
        *counts.columns, *[(F.col(f"_in_{v}") + F.col(f"_off_{v}")).alias(f"{v}{suffix}") for v in values]
    )
    return out


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    value: Column,
    name: str,
    offset: int = -1,
) -> DataFrame:
    """Value of the previous (``offset=-1``) or next (``+1``) row within ``keys``.

    Same result as ``lag``/``lead`` over the key, but each (key, chunk) is its
    own window group; the value across a chunk border comes from a summary of
    one row per (key, chunk).
    """
    if offset not in (-1, 1):
        raise ValueError("offset is -1 or 1")
    rank = F.struct(*order)
    chunked = df.withColumn("_chunk", chunk).withColumn("_value", value)
    step = F.lag if offset < 0 else F.lead
    pick = F.max_by if offset < 0 else F.min_by
    inner = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy("_chunk")
    edges = (
        chunked.groupBy(*keys, "_chunk")
        .agg(pick(F.struct(F.col("_value").alias("v")), rank).alias("_edge"))
        .select(*keys, "_chunk", step("_edge").over(outer).alias("_border"))
    )
    within = chunked.withColumn("_near", step(F.struct(F.col("_value").alias("v"))).over(inner))
    return within.join(edges, [*keys, "_chunk"]).select(
        *df.columns, F.coalesce(F.col("_near"), F.col("_border"))["v"].alias(name)
    )


def balanced_chunks(counts: DataFrame, keys: Sequence[str], value: str, weight: str, parts: int = 256) -> DataFrame:
    """Add ``_part``, which of about ``parts`` equally large value ranges of its key a row is in, and the key's total.

    The borders are approximate quantiles of the distinct values (a mergeable
    sketch, one small array per key); where they fall does not affect results.
    """
    points = [i / parts for i in range(1, parts)]
    borders = counts.groupBy(*keys).agg(
        F.approx_percentile(value, points, 2000).alias("_borders"), F.sum(weight).alias("_total")
    )
    return counts.join(borders, list(keys)).select(
        *counts.columns, "_total", F.size(F.filter("_borders", lambda b: b <= F.col(value))).alias("_part")
    )


def ranked_counts(df: DataFrame, keys: Sequence[str], value: str, measures: dict[str, Column], total: str) -> DataFrame:
    """Distinct values per key with their counts, the rows before each (``<total>_before``) and in all (``_total``).

    Raw rows are never sorted: they are counted per distinct value first, and the
    running count goes through balanced value ranges, so neither a hot value nor
    a key with most of the rows ends up in one task.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*[m.alias(n) for n, m in measures.items()])
    parted = balanced_chunks(counts, keys, value, total)
    return chunked_running_sum(parted, keys, value, [total], F.col("_part")).drop("_part")


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact median per key (mean of the two middle values for an even count)."""
    ranked = ranked_counts(df, keys, value, {"_n": F.count(F.lit(1))}, "_n")
    first = F.col("_n_before")
    last = first + F.col("_n") - 1

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank <= last), F.col(value)))

    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    return ranked.groupBy(*keys).agg(((at(low) + at(high)) / F.lit(2.0)).alias(name))
