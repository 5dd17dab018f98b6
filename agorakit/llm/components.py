"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agorakit.session import discard, materialize


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``links``; the label is the smallest node of its component.

    Each round joins every node with its smallest neighbour (large star, then small
    star). Rounds grow with the logarithm of the longest path. All edges
    stay in Spark; a round is written to the shared folder, which cuts the
    lineage. Nodes without a link have no row. Null ends are ignored.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = materialize(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(high.alias("u"), low.alias("v"))
        .distinct(),
        "edges",
    )
    print_of = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    before = print_of(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .where("u != v")
            .distinct()
        )
        settled = materialize(small, "edges")
        discard(edges)
        edges = settled
        after = print_of(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
