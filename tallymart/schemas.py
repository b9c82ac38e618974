"""Declared tables: expected columns and types, keys, and the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns and inferred types each raw table must have.
EXPECTED = {
    "customers": {
        "customer_id": "object", "customer_unique_id": "object", "customer_zip_code_prefix": "int64",
        "customer_city": "object", "customer_state": "object",
    },
    "orders": {
        "order_id": "object", "customer_id": "object", "order_status": "object",
        "order_purchase_timestamp": "object", "order_approved_at": "object",
        "order_delivered_carrier_date": "object", "order_delivered_customer_date": "object",
        "order_estimated_delivery_date": "object",
    },
    "order_items": {
        "order_id": "object", "order_item_id": "int64", "product_id": "object", "seller_id": "object",
        "shipping_limit_date": "object", "price": "float64", "freight_value": "float64",
    },
    "payments": {
        "order_id": "object", "payment_sequential": "int64", "payment_type": "object",
        "payment_installments": "int64", "payment_value": "float64",
    },
    "products": {"product_id": "object", "product_category_name": "object"},
    "sellers": {
        "seller_id": "object", "seller_zip_code_prefix": "int64", "seller_city": "object", "seller_state": "object",
    },
    "reviews": {
        "review_id": "object", "order_id": "object", "review_score": "int64",
        "review_creation_date": "object", "review_answer_timestamp": "object",
    },
    "geolocation": {
        "geolocation_zip_code_prefix": "int64", "geolocation_lat": "float64", "geolocation_lng": "float64",
        "geolocation_city": "object", "geolocation_state": "object",
    },
    "category_translation": {"product_category_name": "object", "product_category_name_english": "object"},
}

# Declared keys.
PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
}
FOREIGN_KEYS = {
    "orders": [("customer_id", "customers", "customer_id")],
    "order_items": [
        ("order_id", "orders", "order_id"),
        ("product_id", "products", "product_id"),
        ("seller_id", "sellers", "seller_id"),
    ],
    "payments": [("order_id", "orders", "order_id")],
    "reviews": [("order_id", "orders", "order_id")],
}

# The numeric product columns whose gaps are filled with the column median.
PRODUCT_MEASURES = [
    "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
]

ORDER_TIMESTAMPS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]

# Star tables, their source and their columns.
STAR_TABLES = {
    "dim_customers": ("customers", [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    ]),
    "dim_orders": ("orders", [
        "order_id", "customer_id", "order_status", *ORDER_TIMESTAMPS, "order_year", "order_month",
        "order_year_month", "order_day_of_week", "order_hour", "delivery_days", "delivery_delay_days",
    ]),
    "dim_products": ("products", [
        "product_id", "product_category_name", "product_category_name_english", *PRODUCT_MEASURES,
        "product_volume_cm3",
    ]),
    "dim_sellers": ("sellers", ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]),
    "dim_reviews": ("reviews", [
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp", "has_comment",
    ]),
    "fact_order_items": ("order_items", [
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
        "freight_value", "total_item_value",
    ]),
    "fact_payments": ("payments", [
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    ]),
    "ref_geolocation": ("geolocation", [
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
        "geolocation_state",
    ]),
}


def _struct(**columns: str) -> T.StructType:
    kinds = {
        "s": T.StringType(), "l": T.LongType(), "d": T.DoubleType(),
    }
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in columns.items()])


# Typed reads of the raw CSV files; timestamps stay text until they are cleaned.
RAW_SCHEMAS = {
    "customers": _struct(
        customer_id="s", customer_unique_id="s", customer_zip_code_prefix="l", customer_city="s", customer_state="s"
    ),
    "orders": _struct(order_id="s", customer_id="s", order_status="s", **{c: "s" for c in ORDER_TIMESTAMPS}),
    "order_items": _struct(
        order_id="s", order_item_id="l", product_id="s", seller_id="s", shipping_limit_date="s", price="d",
        freight_value="d",
    ),
    "payments": _struct(
        order_id="s", payment_sequential="l", payment_type="s", payment_installments="l", payment_value="d"
    ),
    "products": _struct(product_id="s", product_category_name="s", **{c: "d" for c in PRODUCT_MEASURES}),
    "sellers": _struct(seller_id="s", seller_zip_code_prefix="l", seller_city="s", seller_state="s"),
    "reviews": _struct(
        review_id="s", order_id="s", review_score="l", review_comment_title="s", review_comment_message="s",
        review_creation_date="s", review_answer_timestamp="s",
    ),
    "geolocation": _struct(
        geolocation_zip_code_prefix="l", geolocation_lat="d", geolocation_lng="d", geolocation_city="s",
        geolocation_state="s",
    ),
    "category_translation": _struct(product_category_name="s", product_category_name_english="s"),
}
