"""Explicit schemas of every input; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, "
    "order_estimated_delivery_date string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date string, price string, freight_value string",
    "order_payments": "order_id string, payment_sequential int, payment_type string, "
    "payment_installments string, payment_value string",
    "order_reviews": "review_id string, order_id string, review_score string, review_comment_title string, "
    "review_comment_message string, review_creation_date string, review_answer_timestamp string",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "products": "product_id string, product_category_name string, product_name_lenght string, "
    "product_description_lenght string, product_photos_qty string, product_weight_g string, "
    "product_length_cm string, product_height_cm string, product_width_cm string",
    "geolocation": "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
    "geolocation_city string, geolocation_state string",
    "assignments": "assignment_id string, customer_id string, customer_state string, experiment_id string, "
    "experiment_name string, variant string, assigned_at string, assignment_method string",
}

TRANSLATION = "product_category_name string, product_category_name_english string"

EXPERIMENT_CATALOG = (
    "version string, dataset string, experiments array<struct<id: string, name: string, primary_metric: string, "
    "mde_percent: double, mde_type: string, test_type: string, sample_per_variant: int, "
    "randomization_unit: string, split: string, variants: array<string>, guardrail_metrics: array<string>>>"
)

TOPICS = {
    "orders": "event_type string, order_id string, customer_id string, order_total double, order_status string, "
    "experiment_id string, variant string, timestamp string",
    "clickstream": "event_id string, event_type string, timestamp string, session_id string, customer_id string, "
    "experiment_id string, variant string, properties struct<product_id: string, page_url: string, "
    "device: string, referrer: string, time_spent_seconds: double, order_id: string, total: double>, "
    "metadata struct<user_agent: string, ip_address: string>",
    "payments": "event_type string, order_id string, payment_type string, payment_value double, "
    "payment_installments int, timestamp string",
    "deliveries": "event_type string, order_id string, timestamp string",
    "reviews": "event_type string, review_id string, order_id string, product_id string, review_score int, "
    "timestamp string",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
