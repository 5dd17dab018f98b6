"""Fixity audit of archived records with Merkle trees.

A replica is a table of records: archive, slot (the record's place in its archive's order), offset and length in
bytes, and digest. Leaves hash the records of a slot, with its number and size; a node above hashes its number and the
numbers, sizes and hashes of up to ``FANOUT`` children in order, and covers their slots and their offset range. Offsets in a hash
are relative (sizes in order), so that a lost record does not make all later ones differ. Two replicas are compared
from the roots down: only children of nodes that differ are looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from agorakit.session import materialize

FANOUT = 16
ARCHIVE = 1024  # records to an archive


def record_text(url: Column, payload: Column) -> Column:
    """A response record: header, empty line, payload, two line breaks. Null url or payload is empty."""
    url, payload = F.coalesce(url, F.lit("")), F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"),
    )


def records(pages: DataFrame, per_archive: int = ARCHIVE) -> DataFrame:
    """Records of ``pages`` (page_id, url, html): archive, slot, length, digest (SHA-256 of the record).

    The archive is page_id divided by ``per_archive``, the slot the rest. A null page_id goes to archive -1, slot 0.
    """
    record = record_text(F.col("url").cast("string"), F.col("html").cast("string"))
    key = F.col("page_id").cast("long")
    return pages.select(
        F.coalesce(F.floor(key / F.lit(per_archive)), F.lit(-1)).cast("long").alias("archive"),
        F.coalesce(F.pmod(key, F.lit(per_archive)), F.lit(0)).cast("long").alias("slot"),
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("digest"),
    )


def tree(found: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(archive, level, node, hash, n, low, high) of all nodes; level 0 are slots, the highest level has the roots.

    Records that share a slot, equal ones too, are one leaf made of the slot, their number and size, the sum of their
    hashes and the smallest and largest digest, so no group is gathered. ``low``/``high`` is the range of offsets that a
    node covers. Each level is one aggregate of at most ``fanout`` children a node.
    """
    leaf = found.groupBy("archive", F.col("slot").alias("node")).agg(
        F.sum("length").alias("size"),
        F.count("*").alias("n"),
        F.sha2(
            F.concat_ws(
                ",",
                F.col("slot").cast("string"),
                F.count("*").cast("string"),
                F.sum("length").cast("string"),
                F.sum(F.xxhash64("digest").cast("decimal(38,0)")).cast("string"),
                F.min("digest"),
                F.max("digest"),
            ),
            256,
        ).alias("hash"),
    )
    # slots of an archive are few (its record count), and one row each
    ahead = Window.partitionBy("archive").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    low = F.coalesce(F.sum("size").over(ahead), F.lit(0))
    level = leaf.select("archive", F.lit(0).alias("level"), "node", "hash", "n", low.alias("low"), (low + F.col("size")).alias("high"))
    level = materialize(level, "leaves")
    top = level.agg(F.max("node")).first()[0] or 0
    child = lambda c: F.concat_ws(":", c["node"].cast("string"), c["size"].cast("string"), c["hash"])
    out, depth = level, 0
    while fanout**depth <= top:
        depth += 1
        children = F.array_sort(F.collect_list(F.struct("node", (F.col("high") - F.col("low")).alias("size"), "hash")))
        level = (
            level.withColumn("up", F.floor(F.col("node") / F.lit(fanout))).groupBy("archive", "up")
            .agg(
                F.sha2(F.concat_ws(",", F.col("up").cast("string"), F.array_join(F.transform(children, child), ",")), 256).alias("hash"),
                F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
            )
            .select("archive", F.lit(depth).alias("level"), F.col("up").alias("node"), "hash", "n", "low", "high")
        )
        out = out.unionByName(level)
    return materialize(out, "tree")


def audit(mine: DataFrame, other: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Differing leaves of two trees: archive, slot, status, low, high, n_mine, n_other.

    ``status`` is corrupt, missing (only in ``mine``) or extra (only in ``other``); low and high are offsets
    in ``mine``, or in ``other`` for an extra slot. Starts at the highest level of either tree and goes down through differing nodes only.
    """
    tops = [t.agg(F.max("level")).first()[0] for t in (mine, other)]
    depth = max([t for t in tops if t is not None], default=0)
    suspects = None
    for level in range(depth, -1, -1):
        a = mine.where(F.col("level") == level).drop("level")
        b = other.where(F.col("level") == level).drop("level")
        if suspects is not None:
            parents = suspects.select("archive", F.col("node").alias("parent"))
            within = lambda t: t.withColumn("parent", F.floor(F.col("node") / F.lit(fanout))).join(parents, ["archive", "parent"], "left_semi").drop("parent")
            a, b = within(a), within(b)
        b = b.select("archive", "node", *[F.col(c).alias(f"{c}_other") for c in ("hash", "n", "low", "high")])
        suspects = a.join(b, ["archive", "node"], "full_outer").where(~F.col("hash").eqNullSafe(F.col("hash_other")))
    status = F.when(F.col("hash_other").isNull(), "missing").when(F.col("hash").isNull(), "extra").otherwise("corrupt")
    return suspects.select(
        "archive",
        F.col("node").alias("slot"),
        status.alias("status"),
        F.coalesce("low", "low_other").alias("low"),
        F.coalesce("high", "high_other").alias("high"),
        F.coalesce("n", F.lit(0)).alias("n_mine"),
        F.coalesce("n_other", F.lit(0)).alias("n_other"),
    )


def roots(mine: DataFrame, other: DataFrame) -> DataFrame:
    """(archive, root, root_other, intact) from the highest level of the two trees."""
    depth = F.lit(max([t for t in (x.agg(F.max("level")).first()[0] for x in (mine, other)) if t is not None], default=0))
    a = mine.where(F.col("level") == depth).select("archive", F.col("hash").alias("root"))
    b = other.where(F.col("level") == depth).select("archive", F.col("hash").alias("root_other"))
    return a.join(b, "archive", "full_outer").withColumn("intact", F.col("root").eqNullSafe(F.col("root_other")))


def aged(pages: DataFrame) -> DataFrame:
    """A second replica of ``pages`` as a store with faults would give it back: test data of the registered query.

    By page_id: the rest 5 of 97 has its last byte changed, 7 of 211 is lost, 11 of 389 comes back with an id beyond all
    others' archives.
    """
    key = F.col("page_id")
    rotten = F.concat(F.substring("html", F.lit(1), F.length("html") - 1), F.lit("~"))
    kept = pages.where(~F.coalesce(F.pmod(key, F.lit(211)) == 7, F.lit(False)))
    html = F.when(F.pmod(key, F.lit(97)) == 5, rotten).otherwise(F.col("html"))
    moved = F.when(F.pmod(key, F.lit(389)) == 11, key + F.lit(1 << 40)).otherwise(key)
    return kept.select(moved.alias("page_id"), "url", html.alias("html"))


def replica_audit(pages: DataFrame) -> DataFrame:
    """Audit of ``pages`` against ``aged(pages)``: a row for every archive (slot null: its roots) and every damaged slot."""
    own = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    mine, other = tree(records(own)), tree(records(aged(own)))
    damage = audit(mine, other).select("archive", "slot", "status", "low", "high", "n_mine", "n_other")
    whole = roots(mine, other).select(
        "archive", F.lit(None).cast("long").alias("slot"),
        F.when(F.col("intact"), "intact").when(F.col("root_other").isNull(), "missing").when(F.col("root").isNull(), "extra").otherwise("differs").alias("status"),
    )
    none = F.lit(None).cast("long")
    return damage.unionByName(whole.select("*", none.alias("low"), none.alias("high"), none.alias("n_mine"), none.alias("n_other")))


AUDIT_SQL = f"""
WITH mine AS (SELECT page_id, url, html FROM pages),
other AS (
  SELECT CASE WHEN page_id % 389 = 11 THEN page_id + {1 << 40} ELSE page_id END AS page_id, url,
    CASE WHEN page_id % 97 = 5 THEN substr(html, 1, length(html) - 1) || '~' ELSE html END AS html
  FROM pages WHERE page_id % 211 <> 7
),
both_sides AS (SELECT 'a' AS side, * FROM mine UNION ALL SELECT 'b' AS side, * FROM other),
record AS (
  SELECT side, page_id // {ARCHIVE} AS archive, page_id % {ARCHIVE} AS slot,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS content
  FROM both_sides
),
leaf AS (
  SELECT side, archive, slot, sum(strlen(content)) AS size, count(*) AS n, list(sha256(content) ORDER BY content) AS digests
  FROM record GROUP BY ALL
),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY side, archive ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low
  FROM leaf
),
joined AS (
  SELECT coalesce(a.archive, b.archive) AS archive, coalesce(a.slot, b.slot) AS slot, a.n AS n_a, b.n AS n_b,
    coalesce(a.low, b.low) AS low, coalesce(a.low + a.size, b.low + b.size) AS high, a.digests IS NOT DISTINCT FROM b.digests AS same
  FROM (SELECT * FROM placed WHERE side = 'a') a FULL JOIN (SELECT * FROM placed WHERE side = 'b') b USING (archive, slot)
)
SELECT archive, slot, CASE WHEN n_b IS NULL THEN 'missing' WHEN n_a IS NULL THEN 'extra' ELSE 'corrupt' END AS status,
  low::BIGINT AS low, high::BIGINT AS high, coalesce(n_a, 0) AS n_mine, coalesce(n_b, 0) AS n_other
FROM joined WHERE NOT same
UNION ALL
SELECT archive, NULL, CASE WHEN bool_and(same) THEN 'intact' WHEN count(n_b) = 0 THEN 'missing' WHEN count(n_a) = 0 THEN 'extra' ELSE 'differs' END,
  NULL, NULL, NULL, NULL
FROM joined GROUP BY archive
"""
