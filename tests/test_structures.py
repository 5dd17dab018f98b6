"""Stored structures: lookups by key, the inverted index, distinct sketches, enrichment from a table that grows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from agorakit.operators import marts
from agorakit.sources import search, sinks, topics
from agorakit.streaming import messages, operators as streams, runtime


def opened(df):
    """Bucket folders that a frame reads."""
    return {name.split("/data/")[1].rsplit("/", 1)[0] for name in df.inputFiles()}


def test_lookup_opens_only_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(2000).selectExpr("cast(id AS string) AS k", "id % 7 AS region", "id AS v")
    sinks.upsert(path, rows, ["k"], ["v"])
    one = sinks.read_upserted(spark, path, ["17"])
    assert [tuple(r) for r in one.collect()] == [("17", 3, 17)]
    assert len(opened(one)) == 1 and len(opened(sinks.read_upserted(spark, path))) == sinks.BUCKETS
    assert "EqualTo(k,17)" in one._jdf.queryExecution().executedPlan().toString() or "In(k" in one._jdf.queryExecution().executedPlan().toString()
    some = sinks.read_upserted(spark, path, spark.createDataFrame([("3",), ("4",), ("none",), ("3",)], "k string"))
    assert sorted(r.v for r in some.collect()) == [3, 4] and len(opened(some)) <= 3
    assert sinks.read_upserted(spark, path, ["none"]).count() == 0 and sinks.read_upserted(spark, path, []).count() == 0
    # a later state of a key is what a lookup sees
    sinks.upsert(path, spark.createDataFrame([("17", 9, 5000)], "k string, region long, v long"), ["k"], ["v"])
    assert [r.v for r in sinks.read_upserted(spark, path, ["17"]).collect()] == [5000]


def test_lookup_by_two_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(500).selectExpr("concat('c', id % 50) AS customer_id", "concat('e', id % 10) AS experiment_id", "id AS v")
    sinks.upsert(path, rows, ["customer_id", "experiment_id"], ["v"])
    wanted = spark.createDataFrame([("c7", "e7")], "customer_id string, experiment_id string")
    found = sinks.read_upserted(spark, path, wanted)
    assert [r.v for r in found.collect()] == [457] and len(opened(found)) == 1
    with pytest.raises(ValueError, match="frame of keys"):
        sinks.read_upserted(spark, path, ["c7"])


REVIEW = "id string, v int, text string, stars int"


def test_index_finds_what_a_scan_finds(spark, tmp_path):
    path = str(tmp_path / "i")
    words = "good bad slow fast box price café 5star".split()
    rows = [(f"r{i}", 1, " ".join(words[(i * 7 + j * j) % 8].upper() if i % 3 else words[(i + j) % 8] for j in range(i % 6)) + ("!" if i % 2 else ""), i % 5) for i in range(300)]
    rows += [("null", 1, None, 1), ("blank", 1, " ,. ", 2)]
    data = spark.createDataFrame(rows, REVIEW)
    for part in (data.where("stars < 2"), data.where("stars >= 2")):
        search.index_batch(path, part, ["id"], "text", "v")

    def scan(terms):
        kept = F.arrays_overlap(search.terms_of(F.col("text")), F.array(*[F.lit(t.lower()) for t in terms]))
        return sorted(r.id for r in data.where(kept).collect())

    for terms in (["price"], ["CAFÉ", "slow"], ["5star", "none"], ["none"]):
        assert sorted(r.id for r in search.search(spark, path, terms, ["id"], "v").collect()) == scan(terms)
    postings = sinks.read_upserted(spark, f"{path}/postings", ["price"])
    assert len(opened(postings)) == 1  # of 64


def test_index_follows_changed_documents_in_any_order(spark, tmp_path):
    path = str(tmp_path / "i")
    take = lambda *rows: search.index_batch(path, spark.createDataFrame(list(rows), REVIEW), ["id"], "text", "v")
    find = lambda *terms: sorted((r.id, r.v) for r in search.search(spark, path, list(terms), ["id"], "v").collect())
    take(("a", 1, "old words", 1), ("b", 2, "new words", 1))
    take(("a", 2, "other words", 1), ("b", 1, "late old words", 1))
    assert find("old") == [] and find("other") == [("a", 2)] and find("words") == [("a", 2), ("b", 2)] and find("late") == []
    take(("a", 3, None, 1))
    assert find("words") == [("b", 2)]


def test_sketches_merge_to_the_sketch_of_the_whole(spark):
    df = spark.range(30_000).selectExpr("id % 9 AS day", "id % 2 AS g", "cast(id % 7000 AS string) AS who")
    by_day = marts.stored_sketches(marts.distinct_registers(df, "who", ["day", "g"]), ["day", "g"])
    whole = marts.stored_sketches(marts.distinct_registers(df, "who", ["g"]), ["g"])
    a = {r.g: r.estimate for r in marts.distinct_from_sketches(by_day, ["g"]).collect()}
    assert a == {r.g: r.estimate for r in marts.distinct_from_sketches(whole, ["g"]).collect()}
    exact = {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("who").alias("n")).collect()}
    assert all(abs(a[g] / exact[g] - 1) < 0.05 for g in exact)
    few = marts.stored_sketches(marts.distinct_registers(spark.createDataFrame([(1, "x"), (1, "y"), (1, "x"), (1, None)], "g int, who string"), "who", ["g"]), ["g"])
    assert [r.estimate for r in marts.distinct_from_sketches(few, ["g"]).collect()] == [2]


def test_customer_that_joins_between_batches_is_known_from_then_on(spark, tmp_path):
    src, path = tmp_path / "in", str(tmp_path / "out")
    schema = "order_id string, customer_id string, order_total double, order_status string, event_type string, experiment_id string, variant string, timestamp string"

    def land(name, *orders):
        os.makedirs(src, exist_ok=True)
        with open(src / name, "w") as f:
            f.writelines(json.dumps({"order_id": o, "customer_id": c, "timestamp": "2024-01-01T00:00:00Z"}) + "\n" for o, c in orders)

    def customer(*rows):
        sinks.upsert(f"{path}/customers", spark.createDataFrame(list(rows), "customer_id string, city string, state string, customer_tier string, v int"), ["customer_id"], ["v"])

    reads = []

    def known(ids):
        found = sinks.read_upserted(spark, f"{path}/customers", ids)
        reads.append(len(opened(found)))
        return found

    def run():
        stream = messages.event_time(topics.read_topic_files(spark, str(src), schema, max_files=1))
        query = stream.writeStream.foreachBatch(runtime.enrich_sink(path, known)).option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start()
        query.awaitTermination()

    customer(*[(f"c{i}", "x", "SP", "new", 1) for i in range(300)])
    land("a.json", ("o1", "c1"), ("o2", "late"), ("o3", None))
    run()
    customer(("late", "Rio", "RJ", "vip", 1), ("c1", "y", "MG", "vip", 2))
    land("b.json", ("o4", "late"), ("o5", "c1"))
    run()
    got = {r.order_id: (r.customer_state, r.needs_enrichment) for r in spark.read.parquet(f"{path}/operational").collect()}
    assert got == {"o1": ("SP", False), "o2": ("unknown", True), "o3": ("unknown", True), "o4": ("RJ", False), "o5": ("MG", False)}
    tiers = {r.order_id: r.customer_tier for r in spark.read.parquet(f"{path}/analytic").collect()}
    assert tiers["o4"] == "vip" and tiers["o1"] == "new" and tiers["o2"] is None
    assert max(reads) <= 2  # of 64 buckets


def test_event_between_two_sessions_makes_them_one(spark, tmp_path):
    src = tmp_path / "in"

    def land(name, *events):
        os.makedirs(src, exist_ok=True)
        with open(src / name, "w") as f:
            f.writelines(json.dumps({"customer_id": c, "timestamp": f"2024-01-01T{t}Z"}) + "\n" for c, t in events)
        stamp = 1_700_000_000 + len(os.listdir(src)) * 10
        os.utime(src / name, (stamp, stamp))

    # a and c are 50 minutes apart; b, in a later file, lies between. The pause of d and e is exactly the gap.
    land("1.json", ("u", "10:00:00"), ("u", "10:50:00"), ("w", "10:00:00"), ("w", "10:30:00"), ("x", "10:00:00"), ("x", "10:30:01"))
    land("2.json", ("u", "10:25:00"), (None, "10:20:00"))
    land("3.json", ("end", "15:00:00"))
    land("4.json", ("end", "15:00:01"))
    stream = messages.event_time(topics.read_topic_files(spark, str(src), "customer_id string, timestamp string", max_files=1))
    out = streams.gap_sessions(stream, 1800, "2 hours")
    runtime.start_append(out, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    shown = lambda df: sorted((r.customer_id, r.started_at.strftime("%H:%M:%S"), r.ended_at.strftime("%H:%M:%S"), r.events) for r in df.collect())
    got = shown(spark.read.schema(out.schema).parquet(str(tmp_path / "out")))
    assert got == [("u", "10:00:00", "10:50:00", 3), ("w", "10:00:00", "10:30:00", 2), ("x", "10:00:00", "10:00:00", 1), ("x", "10:30:01", "10:30:01", 1)]
    static = messages.event_time(spark.read.schema("customer_id string, timestamp string").json(str(src)))
    assert [r for r in shown(streams.gap_sessions(static, 1800)) if r[0] != "end"] == got
    with pytest.raises(ValueError, match="grace"):
        streams.gap_sessions(stream)
