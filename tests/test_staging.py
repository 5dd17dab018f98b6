import datetime as dt

from pyspark.sql import functions as F

from agorakit.operators import dims, facts, marts, staging
from agorakit.sources import schemas, tables

ORDERS = schemas.RAW["orders"]
ITEMS = "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, price string, freight_value string"


def orders_of(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS)


def test_orders_are_cleaned(spark):
    raw = orders_of(
        spark,
        # approval before purchase, delivery before approval
        (" o1 ", "c1", " Delivered ", "2017-01-02 10:00:00", "2017-01-02 09:00:00", None, "2017-01-02 08:00:00", "2017-01-20"),
        # unknown status, unparsable time
        ("o2", "c2", "lost", "not a time", None, None, None, None),
        # no id
        (None, "c3", "shipped", "2017-01-02 10:00:00", None, None, None, None),
        # delivered before purchase, no approval
        ("o4", "c4", "delivered", "2017-01-02 10:00:00", None, None, "2017-01-02 09:00:00", "2017-01-01"),
        ("o5", "c5", "canceled", "2017-01-02 10:00:00", "2017-01-03 10:00:00", None, "2017-01-06 09:00:00", "2017-01-05"),
    )
    items = spark.createDataFrame(
        [("o1", 1, "p", "s", None, "50", "1"), ("o4", 1, "p", "s", None, "150", "x"), ("o4", 2, "p", "s", None, "50.01", "2")],
        ITEMS,
    )
    got = {r.order_id: r for r in staging.stg_orders(raw, items).collect()}
    assert set(got) == {"o1", "o2", "o4", "o5"}
    purchase = dt.datetime(2017, 1, 2, 10)
    assert got["o1"].order_status == "delivered" and got["o1"].order_approved_at == purchase
    assert got["o1"].order_delivered_customer_date == purchase and got["o1"].delivery_time_days == 0
    assert got["o2"].order_status == "unknown" and got["o2"].order_purchase_timestamp is None
    assert got["o2"].order_status_category == "other" and got["o2"].order_total == 0.0
    assert got["o4"].order_delivered_customer_date == purchase and got["o4"].is_late is True
    assert got["o5"].order_status_category == "canceled" and got["o5"].delivery_time_days == 3 and got["o5"].is_late is True
    assert [got[o].order_size_category for o in ("o1", "o4", "o2")] == ["small", "large", "small"]
    freight = {r.order_id: r.order_total for r in staging.stg_orders(raw, items, True).collect()}
    assert freight["o4"] == 202.01


def test_reviews_keep_missing_text(spark):
    raw = spark.createDataFrame(
        [
            ("r1", "o1", "5", None, "  fine ", "2017-02-01", "2017-02-01 12:00:00"),
            ("r2", "o1", None, None, None, "2017-01-01", None),
            (None, "o1", "4", None, None, "2017-01-01", None),
        ],
        schemas.RAW["order_reviews"],
    )
    orders = orders_of(
        spark, ("o1", "c1", "delivered", "2017-01-02 10:00:00", None, None, "2017-01-10 10:00:00", "2017-01-20")
    )
    staged = staging.stg_reviews(raw, staging.stg_orders(orders, spark.createDataFrame([], ITEMS)))
    got = {r.review_id: r for r in staged.collect()}
    assert got["r1"].review_comment_message == "fine" and got["r1"].days_since_delivery == 21
    assert got["r2"].review_score == 0 and got["r2"].review_sentiment == "negative" and got["r2"].review_comment_message is None
    assert got["r2"].days_since_delivery == -10
    fact = {r.review_id: r for r in facts.fct_reviews(staged).collect()}
    assert fact["r1"].has_comment is True and fact["r1"].response_time_hours == 12.0 and fact["r1"].review_comment_length == 4
    assert fact["r2"].has_comment is False and fact["r2"].review_comment_length == 0
    assert facts.review_profile(facts.fct_reviews(staged)).collect()[0].invalid_review_scores == 1


def test_products_and_payments_coerce(spark):
    raw = spark.createDataFrame(
        [
            ("p1", "beleza", None, None, None, "500", "10", "50", "10"),
            ("p2", "x", None, None, None, "oops", "100", None, "10"),
            ("p3", None, None, None, None, "2000.5", "50", "100", "10"),
        ],
        schemas.RAW["products"],
    )
    names = spark.createDataFrame([("beleza", "health_beauty")], schemas.TRANSLATION)
    got = {r.product_id: r for r in dims.dim_products(staging.stg_products(raw, names)).collect()}
    assert got["p1"].product_category_group == "lifestyle" and got["p1"].product_weight_category == "light"
    assert got["p1"].product_size_category == "small"  # exactly 5000
    assert got["p2"].product_category_name_english == "x" and got["p2"].product_weight_g == 0.0
    assert got["p3"].product_category_name_english is None and got["p3"].product_size_category == "medium"  # exactly 50000
    assert got["p3"].product_weight_category == "heavy"
    left = {r.product_id: r.product_size_category for r in dims.dim_products(staging.stg_products(raw, names), "left").collect()}
    assert left["p1"] == "medium" and left["p3"] == "large"
    pay = staging.stg_payments(
        spark.createDataFrame([("o1", 1, " Credit_Card ", "x", "9.5"), (None, 1, "a", "1", "1")], schemas.RAW["order_payments"])
    ).collect()
    assert len(pay) == 1 and pay[0].payment_type == "credit_card" and pay[0].payment_installments == 1


def test_order_fact_takes_first_payment_and_seller(spark):
    orders = staging.stg_orders(
        orders_of(spark, ("o1", "c1", "delivered", "2017-01-02 10:00:00", None, None, "2017-01-12 09:00:00", "2017-01-10")),
        spark.createDataFrame([], ITEMS),
    )
    items = staging.stg_order_items(
        spark.createDataFrame(
            [("o1", 2, "p2", "s2", None, "30", "3"), ("o1", 1, "p1", "s1", None, "10", "1"), ("o1", None, "p", "s", None, "1", "1")],
            ITEMS,
        )
    )
    payments = staging.stg_payments(
        spark.createDataFrame([("o1", 2, "voucher", "1", "4"), ("o1", 1, "boleto", "3", "40")], schemas.RAW["order_payments"])
    )
    geo = dims.dim_geography(
        staging.stg_geolocation(
            spark.createDataFrame([("01", 1.0, 2.0, "b", "SP"), ("01", 3.0, 4.0, "a", "SP")], schemas.RAW["geolocation"])
        )
    )
    customers = dims.dim_customers(
        staging.stg_customers(
            spark.createDataFrame([("c1", "u1", "01", "x", "sp")], schemas.RAW["customers"]), geo
        ),
        orders,
    )
    sellers = spark.createDataFrame([("s1", "k1"), ("s2", "k2")], "seller_id string, seller_key string")
    fct = facts.fct_orders(orders, items, payments, customers, sellers, dims.dim_dates(spark), geo)
    row = fct.collect()[0]
    assert fct.columns == facts.FCT_ORDERS_COLUMNS
    assert (row.seller_key, row.payment_type, row.payment_installments, row.payment_value) == ("k1", "boleto", 3, 44.0)
    assert (row.order_total, row.item_count, row.freight_value, row.profit_estimate) == (44.0, 2, 4.0, 6.6)
    assert row.avg_item_price == 22.0 and row.delivery_time_days == 9 and row.is_late_delivery is True
    assert row.geography_key == geo.collect()[0].geography_key and row.date_key is not None
    assert facts.fct_orders(orders, items, payments, customers, sellers, dims.dim_dates(spark), geo, "2017-01-02").count() == 1
    assert facts.fct_orders(orders, items, payments, customers, sellers, dims.dim_dates(spark), geo, "2017-01-03").count() == 0
    profile = facts.fact_profile(fct).collect()[0]
    assert (profile.row_count, profile.null_customer_key, profile.null_date_key) == (1, 0, 0)
    daily = marts.fct_daily_metrics(fct)
    filled = marts.fill_days(daily, dims.dim_dates(spark, "2017-01-01", "2017-01-03")).orderBy("date").collect()
    assert [r.total_orders for r in filled] == [0, 1, 0] and filled[0].avg_delivery_time_days is None


def test_customer_tiers(spark):
    orders = spark.createDataFrame(
        [(f"o{i}", c, "delivered", t) for c, n, t in (("a", 11, 100.0), ("b", 2, 50.0), ("c", 1, 5.0)) for i in range(n)],
        "order_id string, customer_id string, order_status string, order_total double",
    ).withColumn("order_purchase_timestamp", F.lit("2017-01-01").cast("timestamp"))
    people = spark.createDataFrame([("a", "SP"), ("b", "AM"), ("c", "??"), ("d", None)], "customer_id string, customer_state string")
    got = {r.customer_id: (r.customer_tier, r.customer_value, r.customer_region) for r in dims.dim_customers(people, orders).collect()}
    assert got == {
        "a": ("vip", "high", "Southeast"),
        "b": ("regular", "medium", "North"),
        "c": ("new", "low", "Other"),
        "d": ("new", "low", "Other"),
    }


def test_wide_orders_and_zero_totals(spark):
    orders = orders_of(
        spark,
        ("o1", "c1", "delivered", "2017-01-02 10:00:00", None, None, None, None),
        ("o2", "c9", None, "2017-01-02 10:00:00", None, None, None, None),
    ).withColumn("order_purchase_timestamp", F.to_timestamp("order_purchase_timestamp"))
    items = staging.stg_order_items(spark.createDataFrame([("o1", 1, "p", "s", None, "10", "2.5")], ITEMS))
    people = spark.createDataFrame([("c1", "SP")], "customer_id string, customer_state string")
    wide = tables.load_orders(orders, items, people)
    got = {r.order_id: r for r in wide.collect()}
    assert got["o1"].order_total == 12.5 and got["o2"].order_total == 0.0
    assert got["o2"].order_status == "" and got["o2"].customer_state == ""
    assert [tuple(r) for r in marts.zero_total_sources(wide, items).collect()] == [("o2", 0.0, 0.0)]
