"""Common table expressions for the DuckDB checks: raw tables, the star schema, shared helpers.

Everything here is written in SQL, apart from the Spark plans; only the raw SELECTs are shared text.
"""

from __future__ import annotations

import re

from tallymart.sources.roles import HOURLY_ITEMS, HOURLY_ORDERS, ORDERS_AS_TEXT, RAW_TABLES, SUPPLIED_TABLES


def _strip(column: str) -> str:
    return f"trim({column}, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' ')"


def rnd(expr: str, digits: int) -> str:
    """Round half away from zero on a double, in plain arithmetic."""
    x = f"CAST({expr} AS DOUBLE)"
    scale = f"{10 ** digits}.0e0"
    return f"(sign({x}) * floor(abs({x}) * {scale} + 0.5e0) / {scale})"


def avg(expr: str) -> str:
    return f"(CAST(SUM({expr}) AS DOUBLE) / NULLIF(COUNT({expr}), 0))"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _orders(source: str) -> str:
    ts = [
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ]
    parsed = ", ".join(f"TRY_CAST({c} AS TIMESTAMP) AS {c}" for c in ts)
    return f"""
        SELECT order_id, customer_id, lower({_strip('order_status')}) AS order_status,
               order_purchase_timestamp,
               CASE WHEN order_approved_at IS NULL AND order_status = 'delivered' THEN order_purchase_timestamp
                    ELSE order_approved_at END AS order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
               CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
               CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month,
               strftime(order_purchase_timestamp, '%Y-%m') AS order_year_month,
               dayname(order_purchase_timestamp) AS order_day_of_week,
               CAST(hour(order_purchase_timestamp) AS INTEGER) AS order_hour,
               (epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400e6
                   AS delivery_days,
               (epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date)) / 86400e6
                   AS delivery_delay_days
        FROM (SELECT order_id, customer_id, order_status, {parsed} FROM {source}) AS parsed"""


_PLAIN = {t: t for t in SUPPLIED_TABLES} | {t: f"raw_{t}" for t in RAW_TABLES if t not in SUPPLIED_TABLES}


def _fill(text: str, **extra: str) -> str:
    return text.format(**{**_PLAIN, **extra})


# Money is exact in the checks: decimals instead of doubles.
_MONEY = """
        SELECT * REPLACE (CAST(price AS DECIMAL(18,2)) AS price, CAST(freight_value AS DECIMAL(18,2)) AS freight_value),
               CAST(price AS DECIMAL(18,2)) + CAST(freight_value AS DECIMAL(18,2)) AS total_item_value
        FROM {source}"""

CTES: dict[str, str] = {f"raw_{name}": _fill(text) for name, text in RAW_TABLES.items()}
CTES["raw_orders_text"] = _fill(ORDERS_AS_TEXT, orders="raw_orders")
CTES["raw_hourly_orders"] = _fill(HOURLY_ORDERS)
CTES["raw_hourly_items"] = _fill(HOURLY_ITEMS)
CTES |= {
    "dim_customers": f"""
        SELECT * REPLACE (lower({_strip('customer_city')}) AS customer_city,
                          upper({_strip('customer_state')}) AS customer_state) FROM raw_customers""",
    "dim_orders": _orders("raw_orders"),
    "dim_orders_text": _orders("raw_orders_text"),
    "dim_hourly_orders": _orders("raw_hourly_orders"),
    "fact_order_items": _MONEY.format(source="raw_order_items"),
    "fact_hourly_items": _MONEY.format(source="raw_hourly_items"),
    "fact_payments": f"""
        SELECT * REPLACE (CASE lower({_strip('payment_type')}) WHEN 'not_defined' THEN 'other'
                          ELSE lower({_strip('payment_type')}) END AS payment_type,
                          CAST(payment_value AS DECIMAL(18,2)) AS payment_value) FROM raw_payments""",
    "dim_products": """
        SELECT product_id, COALESCE(p.product_category_name, 'unknown') AS product_category_name,
               COALESCE(product_category_name_english, p.product_category_name, 'unknown')
                   AS product_category_name_english
        FROM raw_products AS p LEFT JOIN raw_category_translation AS t
          ON t.product_category_name = p.product_category_name""",
    "dim_sellers": f"""
        SELECT * REPLACE (lower({_strip('seller_city')}) AS seller_city,
                          upper({_strip('seller_state')}) AS seller_state) FROM raw_sellers""",
    "dim_reviews": """
        SELECT review_id, order_id, review_score, COALESCE(review_comment_title, '') AS review_comment_title,
               COALESCE(review_comment_message, '') AS review_comment_message, review_creation_date,
               review_answer_timestamp,
               CAST(length(COALESCE(review_comment_message, '')) > 0 AS INTEGER) AS has_comment
        FROM raw_reviews""",
    "ref_geolocation": f"""
        SELECT geolocation_zip_code_prefix,
               CAST(SUM(CAST(floor(geolocation_lat * 1e12 + 0.5e0) AS HUGEINT)) AS DOUBLE) / 1e12 / COUNT(geolocation_lat)
                   AS geolocation_lat,
               CAST(SUM(CAST(floor(geolocation_lng * 1e12 + 0.5e0) AS HUGEINT)) AS DOUBLE) / 1e12 / COUNT(geolocation_lng)
                   AS geolocation_lng,
               min(lower({_strip('geolocation_city')})) AS geolocation_city,
               arg_min(upper({_strip('geolocation_state')}),
                       (lower({_strip('geolocation_city')}), upper({_strip('geolocation_state')}))) AS geolocation_state
        FROM raw_geolocation GROUP BY geolocation_zip_code_prefix""",
    "delivered_orders": "SELECT * FROM dim_orders WHERE order_status = 'delivered'",
    # Delivered items with their order's columns.
    "sold": """
        SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value, i.total_item_value,
               d.customer_id, d.order_purchase_timestamp, d.order_year, d.order_year_month, d.order_day_of_week,
               d.delivery_days, d.delivery_delay_days
        FROM fact_order_items AS i JOIN delivered_orders AS d ON d.order_id = i.order_id""",
}


def _needed(text: str, seen: list[str]) -> list[str]:
    for name in CTES:
        if name not in seen and re.search(rf"\b{name}\b", text):
            _needed(CTES[name], seen)
            seen.append(name)
    return seen


def statement(select: str, **ctes: str) -> str:
    """One statement: the shared CTEs that ``select`` and the given ``ctes`` need, then the select."""
    names = _needed(select + " ".join(ctes.values()), [])
    parts = [f"{n} AS ({CTES[n]})" for n in names] + [f"{n} AS ({text})" for n, text in ctes.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select
