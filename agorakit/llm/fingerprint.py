"""Bottom-k sketches of word shingles, in DataFrame functions only.

A sketch is the sorted array of the k smallest distinct 64-bit shingle hashes. The sketch of
a union is the k smallest of the parts' sketches, so parts merge in any order. A sketch with fewer
than k values is the whole set, and then all estimates are exact.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window, functions as F

SIZE = 128  # k
SHINGLE = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = " \t\n\x0b\x0c\r"


def with_sketch(df: DataFrame, text: str, name: str, k: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch of the column ``text`` as ``name``.

    Words are separated by ASCII white space, A-Z lower-cased. Fewer words than ``shingle`` are one shingle of all of them;
    null, empty and blank texts have the empty sketch.
    """
    words = F.split(F.btrim(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), F.lit(_SPACE)), "[ \\t-\\r]+")
    hashed = df.withColumn("_words", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("_words")
    at = lambda i, j: F.get(F.col("_words"), i + j)
    many = F.transform(F.sequence(F.lit(0), n - shingle), lambda i: F.xxhash64(*[at(i, F.lit(j)) for j in range(shingle)]))
    hashes = (
        F.when(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(_SPACE)) == "", F.array().cast("array<bigint>"))
        .when(n < shingle, F.array(F.xxhash64("_words")))
        .otherwise(many)
    )
    return hashed.withColumn(name, smallest(hashes, k)).drop("_words")


def smallest(hashes: Column, k: int = SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = SIZE) -> Column:
    """Sketch of the union of two sets."""
    return smallest(F.concat(a, b), k)


def merge_by(df: DataFrame, keys: list[str], sketch: str, k: int = SIZE) -> DataFrame:
    """Sketch of the union of all rows of each key. A hot key is cut to k values in every task before the shuffle."""
    values = df.select(*keys, F.explode(sketch).alias("_hash")).distinct()
    ranked = values.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))).where(F.col("_at") <= k)
    return ranked.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated Jaccard similarity; two empty sets are alike (1), an empty and another are not (0)."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = SIZE) -> Column:
    """Estimated number of distinct shingles."""
    top = F.element_at(a, -1).cast("double") + 2.0**63
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * 2.0**64 / top)


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    j = resemblance(a, b, k)
    own = distinct_count(a, k)
    shared = j / (1 + j) * (own + distinct_count(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / own))


def text_form(sketch: Column) -> Column:
    """The sketch as lower-case hexadecimal text, 16 digits a value."""
    return F.lower(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def _prefix(text: Column) -> Column:
    """The first seven bytes of a text as a number that sorts as the text does."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(text, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long")


def _at_most(borders: list[int], value: Column) -> Column:
    """Number of sorted ``borders`` that are at most ``value``, found in two steps of about the root of their number; null for null."""
    if not borders:
        return F.when(value.isNotNull(), F.lit(0))
    k = math.isqrt(len(borders) - 1) + 1
    runs = [borders[i : i + k] for i in range(0, len(borders), k)]
    count = lambda listed: F.size(F.filter(listed, lambda x: x <= value))
    outer = count(F.from_json(F.lit(json.dumps([r[0] for r in runs])), "array<bigint>"))
    inner = count(F.get(F.from_json(F.lit(json.dumps(runs)), "array<array<bigint>>"), outer - 1))
    return F.when(value.isNull(), F.lit(None)).when(outer == 0, F.lit(0)).otherwise((outer - 1) * k + inner)


def block_of(docs: DataFrame, blocks: int) -> Column:
    """The block of a row: a struct that sorts as the rows do by descending doc_id, nulls last, then text.

    Blocks hold about equally many rows wherever the ids lie: borders are quantiles of doc_id. An id that fills
    more than a block, and null ids, are cut further by quantiles of the first bytes of their texts; only rows
    alike in such an id and in seven bytes stay together. The driver holds a few numbers a block.
    """
    cuts = [i / blocks for i in range(1, blocks)]
    found = docs.agg(
        F.percentile_approx("doc_id", cuts, 10 * blocks).alias("at"), F.count("*").alias("rows"), F.count("doc_id").alias("ids")
    ).first()
    times = Counter(found["at"] or [])
    full: list[int | None] = [x for x, n in times.items() if n > 1]
    if (found["rows"] - found["ids"]) * blocks > found["rows"]:
        full.append(None)
    parts: dict[str, list[int]] = {}
    if full:
        each = max(2, 4 * blocks // len(full))
        heavy = F.col("doc_id").isin([x for x in full if x is not None])
        rows = docs.where(heavy | F.col("doc_id").isNull() if None in full else heavy).groupBy("doc_id")
        for r in rows.agg(F.percentile_approx(_prefix(F.col("text")), [i / each for i in range(1, each)], 10 * each).alias("at")).collect():
            parts["null" if r["doc_id"] is None else str(r["doc_id"])] = sorted(set(r["at"] or []))
    own = F.lit(0)
    if parts:
        listed = F.from_json(F.lit(json.dumps(parts)), "map<string,array<bigint>>")
        borders = F.try_element_at(listed, F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
        # other ids of the block are greater, so they come first
        own = F.coalesce(F.when(borders.isNotNull(), 1 + F.size(F.filter(borders, lambda x: x <= _prefix(F.col("text"))))), F.lit(0))
    place = F.coalesce(-_at_most(sorted(times), F.col("doc_id")), F.lit(1))
    return F.struct(place.cast("int").alias("place"), own.cast("int").alias("part"))


def with_next(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``docs`` (doc_id, text, carry ...) with ``next_<c>`` of the next row by descending doc_id; the last is followed by the first.

    Rows with the same doc_id follow each other by text; null ids come last. Rows are cut into blocks of like
    numbers of rows, a few for each shuffle partition. Within a block the next row is a window
    function; only each block's first row crosses to its neighbour.
    """
    blocks = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.withColumn("_block", block_of(docs, blocks))
    ahead = F.struct(*[F.col(c).alias(c) for c in carry])
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").asc()]
    within = dealt.repartition("_block").withColumn("_next", F.lead(ahead).over(Window.partitionBy("_block").orderBy(*order)))

    # the first row of every block, for the block before it; one row a block is broadcast to find it
    tops = dealt.groupBy("_block").agg(F.max("doc_id").alias("_top"))
    heads = dealt.join(F.broadcast(tops), "_block").where(F.col("doc_id").eqNullSafe(F.col("_top")))
    heads = heads.groupBy("_block").agg(F.min(F.struct("text", *[c for c in carry if c != "text"])).alias("_head"))
    ring = Window.orderBy("_block")
    edges = heads.select("_block", F.coalesce(F.lead("_head").over(ring), F.first("_head").over(ring)).alias("_edge"))
    joined = within.join(edges, "_block", "left")
    pick = lambda c: F.when(F.col("_next").isNull(), F.col(f"_edge.{c}")).otherwise(F.col(f"_next.{c}"))
    return joined.select(*docs.columns, *[pick(c).alias(f"next_{c}") for c in carry])


def fingerprints(docs: DataFrame, k: int = SIZE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles for every row.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next document's, by descending doc_id; the last document is followed by the first, and a single one
    by itself. A null text is empty. ``n_shingles`` is the estimated number of distinct shingles.
    """
    plain = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    paired = with_next(plain, ["text"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    frame = paired.withColumn("_edited", edited)
    for source, name in (("text", "_own"), ("_edited", "_other"), ("next_text", "_following")):
        frame = with_sketch(frame, source, name, k)
    return frame.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        text_form(F.col("_own")).alias("fingerprint"),
        text_form(F.col("_other")).alias("edited_fingerprint"),
        resemblance(F.col("_own"), F.col("_other"), k).alias("near_edited"),
        resemblance(F.col("_own"), F.col("_following"), k).alias("near_next"),
        distinct_count(F.col("_own"), k).alias("n_shingles"),
    )
