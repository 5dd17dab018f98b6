import json

import pytest
from pyspark.sql import functions as F

from agorakit.operators import quality, stats
from agorakit.sources import documents, schemas, sinks, tables


def test_csv_scan_with_fallback_and_metadata(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01,\"a, b\",SP\n")
    df = tables.read_table(spark, "sellers", str(tmp_path / "missing"), fallback=str(tmp_path))
    assert [tuple(r) for r in df.collect()] == [("s1", "01", "a, b", "SP")]
    meta = tables.table_metadata(df, "sellers").collect()[0]
    assert (meta.row_count, meta.column_count) == (1, 4) and "seller_id:string" in meta.dtypes
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_table(spark, "sellers", str(tmp_path / "missing"))


def test_missing_translation_is_empty(spark, tmp_path):
    df = tables.read_translation(spark, str(tmp_path / "none.csv"))
    assert df.columns == ["product_category_name", "product_category_name_english"] and df.count() == 0


def test_click_log_skips_bad_lines(spark, tmp_path):
    good = {"event_id": "1", "event_type": "product_view", "timestamp": "2024-01-01T00:00:00Z", "session_id": "s",
            "properties": {"device": "mobile", "unknown": 1}, "extra": 5}
    lines = [json.dumps(good), "", "{broken", json.dumps({**good, "event_id": "2", "timestamp": "never"}),
             json.dumps({**good, "event_id": "3", "timestamp": None})]
    (tmp_path / "events.ndjson").write_text("\n".join(lines))
    rows = tables.load_clickstream(spark, str(tmp_path / "events.ndjson")).collect()
    assert [(r.event_id, r.device, r.referrer) for r in rows] == [("1", "mobile", "")]


CATALOG = {
    "version": "1",
    "dataset": "d",
    "experiments": [
        {"id": "exp_001", "name": "Free", "primary_metric": "conversion_rate", "mde_percent": 10, "mde_type": "relative",
         "test_type": "chi_square", "sample_per_variant": 2450, "split": "50/50", "variants": ["control_50", "treatment_35"],
         "guardrail_metrics": ["review_score"]},
        {"id": "exp_002", "name": "Pay", "split": "70/30", "variants": ["control_6_installments", "B"]},
        {"id": "exp_003", "name": "Bare"},
    ],
}


def test_experiment_documents(spark, tmp_path):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps(CATALOG, indent=1))
    docs = {r.experiment_id: r for r in documents.experiment_docs(tables.read_catalog(spark, str(path))).collect()}

    def arms(e):
        return [(v.variant_id, v.name, v.allocation_percent, v.parameters.threshold) for v in docs[e].variants]

    assert arms("exp_001") == [("control", "Control 50", 50, 50), ("treatment", "Treatment 35", 35, 35)]
    assert arms("exp_002") == [("control", "Control 6 Installments", 70, None), ("b", "B", 30, None)]
    assert [a[0] for a in arms("exp_003")] == ["control", "treatment"]
    assert docs["exp_001"].sample_size.required_per_variant == 2450 and docs["exp_003"].sample_size.required_per_variant == 2500
    assert docs["exp_001"].metrics.guardrail == ["review_score"]


def test_product_and_review_documents(spark):
    products = spark.createDataFrame(
        [("p1", "beleza_saude", "0", None, "2", "500.7", "10", "x", None), ("p2", "novo_tipo", "5", "6", None, None, None, None, None),
         ("p3", None, None, None, None, None, None, None, None)],
        schemas.RAW["products"],
    ).withColumn("product_name_length", F.lit("9"))
    docs = {r.product_id: r for r in documents.product_docs(products).collect()}
    assert docs["p1"].category == "beauty_health" and docs["p2"].category == "novo tipo" and docs["p3"].category is None
    assert docs["p1"].attributes.weight_g == 500 and docs["p1"].attributes.dimensions.height_cm is None
    assert docs["p1"].attributes.name_length == 9 and docs["p2"].attributes.name_length == 5
    reviews = spark.createDataFrame(
        [("r1", "o1", "5", " ", " good ", "2020-01-02", None), ("r1", "o2", "1", None, None, "2020-01-03", None), ("r2", "o9", None, None, None, "x", None)],
        schemas.RAW["order_reviews"],
    )
    items = spark.createDataFrame([("o1", 2, "pb"), ("o1", 1, "pa")], "order_id string, order_item_id int, product_id string")
    got = {r.review_id: r for r in documents.review_docs(reviews, items).collect()}
    assert len(got) == 2 and got["r1"].product_id == "pa" and got["r2"].product_id == "o9"
    assert got["r1"].comment.title is None and got["r1"].comment.message == "good" and got["r1"].rating == 5
    assert got["r1"].timestamps.created_at == "2020-01-02T00:00:00Z" and got["r2"].timestamps.created_at is None


def test_partition_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "mart")
    schema = "order_date string, k string, v int"

    def day(*rows):
        return spark.createDataFrame(list(rows), schema).withColumn("order_date", F.to_date("order_date"))

    sinks.write_mart(day(("2020-01-01", "a", 1), ("2020-01-02", "b", 2)), path, "order_date", ["k"])
    sinks.write_mart(day(("2020-01-02", "c", 3)), path, "order_date", ["k"])
    read = sinks.read_mart(spark, path, "order_date", "2020-01-01", "2020-01-02")
    assert sorted((str(r.order_date), r.k, r.v) for r in read.collect()) == [("2020-01-01", "a", 1), ("2020-01-02", "c", 3)]
    plan = sinks.read_mart(spark, path, "order_date", "2020-01-02", "2020-01-02")
    assert "PartitionFilters: [isnotnull(order_date" in plan._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        sinks.read_mart(spark, path, "order_date", "", "")
    kept = sinks.expire(day(("2020-01-01", "a", 1), ("2020-01-30", "b", 2)), "order_date", 7, "2020-01-31 00:00:00")
    assert [r.k for r in kept.collect()] == ["b"]


def test_result_exports(spark, tmp_path):
    df = spark.createDataFrame([("exp_001", 0.01, "LAUNCH"), ("exp_002", 0.5, "ABANDON")], "experiment_id string, p_value double, decision string")
    sinks.write_results(df, str(tmp_path / "json"))
    assert (tmp_path / "json" / "experiment_id=exp_001").is_dir()
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    sinks.export_csv(df, str(tmp_path / "csv"))
    back = spark.read.schema("experiment_id string, p_value double, decision string").csv(str(tmp_path / "csv"), header=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert stats.ALPHA == 0.05


def test_message_checks(spark):
    rows = [("e1", "s", "c", "2024-01-01T00:00:00Z", "x", "control"), (None, "", "c", "2030-01-01T00:00:00Z", "x", "neither"), ("e3", "s", "c", "soon", None, None)]
    df = spark.createDataFrame(rows, "event_id string, session_id string, customer_id string, timestamp string, experiment_id string, variant string")
    got = sorted(sorted(r.issues) for r in quality.check_messages(df, "clickstream", "2024-06-01 00:00:00").collect())
    assert got == [
        ["Empty session_id", "Future timestamp", "Invalid variant: neither", "Missing event_id", "Missing event_type"],
        ["Invalid timestamp format", "Missing event_type"],
        ["Missing event_type"],
    ]
