import datetime as dt
import hashlib
import math
import random

from pyspark.sql import functions as F

from agorakit.functions import bucket, days_between_floor, fixed, half_up, month_gap, sentiment, surrogate_key
from agorakit.functions.grouping import exact_median, first_per, ranked_counts, spread, with_neighbour
from agorakit.functions.scalar import hash_mod
from agorakit.functions.tails import (
    f_upper,
    fisher_two_sided,
    norm_cdf,
    p_two_sided,
    t_quantile,
    t_two_sided,
)
from agorakit.operators import assignment
from agorakit.operators.assignment import arm_of, assign, hash_sample


def one(df):
    return df.collect()[0][0]


def test_bucket_edges(spark):
    values = [0.0, 50.0, 50.01, 200.0, 200.01, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    right = [r[0] for r in df.select(bucket(F.col("x"), *fixed.ORDER_SIZE)).collect()]
    left = [r[0] for r in df.select(bucket(F.col("x"), *fixed.ORDER_SIZE, closed="left")).collect()]
    assert right == ["small", "small", "medium", "medium", "large", None]
    assert left == ["small", "medium", "medium", "large", "large", None]


def test_buckets_partition_the_input(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.uniform(0, 1e5),) for _ in range(500)], "x double")
    for edges, labels in (fixed.ORDER_SIZE, fixed.WEIGHT, fixed.VOLUME):
        counts = df.groupBy(bucket(F.col("x"), edges, labels).alias("b")).count().collect()
        assert sum(r["count"] for r in counts) == 500 and {r["b"] for r in counts} <= set(labels)


def test_floor_days_are_negative_before_the_start(spark):
    t = dt.datetime(2024, 1, 2, 12)
    df = spark.createDataFrame([(t - dt.timedelta(hours=1), t), (t + dt.timedelta(hours=25), t)], "e timestamp, s timestamp")
    assert [r[0] for r in df.select(days_between_floor(F.col("e"), F.col("s"))).collect()] == [-1, 1]


def test_month_gap_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1), dt.date(2024, 1, 31))], "e date, s date")
    assert one(df.select(month_gap(F.col("e"), F.col("s")))) == 2


def test_half_up(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (1e300,), (None,)], "x double")
    assert [r[0] for r in df.select(half_up(F.col("x"), 2)).collect()] == [0.13, 2.5, 1e300, None]


def test_keys_and_hashes(spark):
    df = spark.createDataFrame([(" a1 ", 7)], "o string, n int")
    single, double, mod = df.select(
        surrogate_key("fct_", F.col("o")),
        surrogate_key("fi_", F.col("o"), F.col("n")),
        hash_mod(F.lit("c1|exp_001|outcome")),
    ).collect()[0]
    assert single == "fct_" + hashlib.sha256(b"a1").hexdigest()[:16]
    assert double == "fi_" + hashlib.sha256(b"a1|7").hexdigest()[:16]
    assert mod == int(hashlib.sha256(b"c1|exp_001|outcome").hexdigest(), 16) % 10_000


def test_sentiment(spark):
    df = spark.createDataFrame([(s,) for s in (5, 4, 3, 2, 0)], "s int")
    assert [r[0] for r in df.select(sentiment(F.col("s"))).collect()] == ["positive"] * 2 + ["neutral"] + ["negative"] * 2


def test_assignment_parity_and_split(spark):
    people = spark.range(4000).select(F.col("id").cast("string").alias("customer_id"))
    out = assign(people, ["exp_001", "exp_002"]).collect()
    assert len(out) == 8000
    for r in out[:50]:
        number = int(hashlib.sha256(f"{r.customer_id}|{r.experiment_id}".encode()).hexdigest(), 16)
        assert r.variant == ("control" if number % 2 == 0 else "treatment")
    share = sum(r.variant == "control" for r in out) / 8000
    assert 0.45 < share < 0.55
    assert one(spark.createDataFrame([("c",)], "c string").select(arm_of(F.col("c"), F.lit("e")))) in fixed.VARIANTS


def test_keyed_sample_is_stable_and_near_its_rate(spark):
    people = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    a = {r.k for r in hash_sample(people, "k", "s", 0.2).collect()}
    b = {r.k for r in hash_sample(people.repartition(7), "k", "s", 0.2).collect()}
    assert a == b and 800 < len(a) < 1200


def test_tails_against_known_values(spark):
    assert math.isclose(t_two_sided(2.0, 10), 0.07338803477074, rel_tol=1e-10)
    assert math.isclose(f_upper(4.0, 1, 10), 0.07338803477074, rel_tol=1e-10)
    assert math.isclose(t_quantile(0.975, 10), 2.228138851964939, rel_tol=1e-10)
    assert math.isclose(t_quantile(0.975, 1e7), fixed.Z_95, rel_tol=1e-6)
    assert math.isclose(fisher_two_sided(3, 1, 1, 3), 0.48571428571428571, rel_tol=1e-12)
    assert math.isclose(fisher_two_sided(8, 2, 1, 5), 0.03496503496503495, rel_tol=1e-12)
    df = spark.createDataFrame([(z,) for z in (0.0, 1.0, -2.5, 7.0, 12.0)], "z double")
    for z, p, c in df.select("z", p_two_sided(F.col("z")), norm_cdf(F.col("z"))).collect():
        assert math.isclose(p, math.erfc(abs(z) / math.sqrt(2)), rel_tol=1e-12)
        assert abs(c - 0.5 * math.erfc(-z / math.sqrt(2))) < 1e-7


def hot_events(n=3000, seed=5):
    """Events of which one key holds more than half, with repeated values."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.6 else f"k{rng.randrange(20)}", i, rng.randrange(200) / 4.0) for i in range(n)]


def test_neighbours_match_a_plain_window_on_a_hot_key(spark):
    data = hot_events()
    df = spark.createDataFrame(data, "k string, seq long, x double")
    for offset in (-1, 1):
        got = with_neighbour(df, ["k"], ["seq"], F.floor(F.col("seq") / 64), F.col("x"), "y", offset)
        by_key: dict = {}
        for k, s, x in data:
            by_key.setdefault(k, []).append((s, x))
        want = {}
        for k, rows in by_key.items():
            rows.sort()
            for i, (s, _) in enumerate(rows):
                j = i + offset
                want[s] = rows[j][1] if 0 <= j < len(rows) else None
        assert {r.seq: r.y for r in got.collect()} == want


def test_neighbours_keep_null_values(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0)], "k string, seq long, x double")
    got = with_neighbour(df, ["k"], ["seq"], F.col("seq"), F.col("x"), "y").collect()
    assert {r.seq: r.y for r in got} == {1: None, 2: 1.0, 3: None}


def test_exact_median_and_running_counts(spark):
    data = hot_events()
    df = spark.createDataFrame(data, "k string, seq long, x double")
    values: dict = {}
    for k, _, x in data:
        values.setdefault(k, []).append(x)
    for r in exact_median(df, ["k"], "x", "m").collect():
        v = sorted(values[r.k])
        n = len(v)
        assert r.m == (v[(n - 1) // 2] + v[n // 2]) / 2
    for r in ranked_counts(df, ["k"], "x", {"n": F.count(F.lit(1))}, "n").collect():
        assert r.n_before == sum(v < r.x for v in values[r.k]) and r.n == values[r.k].count(r.x)


def test_first_per_orders_ties_by_all_columns(spark):
    df = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), ("b", 2, "z")], "k string, t int, v string")
    assert sorted(tuple(r) for r in first_per(df, ["k"], ["t", "v"]).collect()) == [("a", 1, "x"), ("b", 2, "z")]
    assert sorted(tuple(r) for r in first_per(df, ["k"], ["t", "v"], False).collect()) == [("a", 1, "y"), ("b", 2, "z")]


def test_money_sums_have_the_same_bits_in_any_order(spark):
    from agorakit.functions import money_sum

    rows = spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(10**11)) / F.lit(10**4)).alias("x"), F.rand(5).alias("r"))
    found = {rows.repartition(n, "r").agg(money_sum(F.col("x") * 1.0)).first()[0] for n in (1, 3, 7, 32)}
    assert len(found) == 1 and found.pop() > 9e11


def test_many_customers_of_one_file_are_assigned_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(assignment, "TASK_ROWS", 1000)
    one = spark.range(2000).select(F.col("id").cast("string").alias("customer_id")).coalesce(1)
    twice = one.unionByName(one).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS customer_id")).coalesce(1)
    got = assign(twice, ["e1", "e2"])
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 9 and max(r["count"] for r in sizes) < 1600
    assert got.select("customer_id", F.spark_partition_id().alias("task")).distinct().count() == 2001
    assert got.count() == 2 * (2 * 2000 + 1) and got.distinct().count() == 2 * 2001
    # few rows stay where they are
    assert spread(one, ["customer_id"], 2000).rdd.getNumPartitions() == 1
