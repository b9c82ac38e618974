"""DuckDB checks for cleaning, integration and data quality."""

from __future__ import annotations

from oracles.base import big, dbl, rnd, statement

MEASURES = [
    "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
]
MEDIANS = "SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in MEASURES) + " FROM raw_products"
FILLED = ", ".join(f"COALESCE(p.{c}, m.{c}) AS {c}" for c in MEASURES)
PRODUCTS = f"""
    SELECT p.product_id, d.product_category_name, d.product_category_name_english, {FILLED},
           COALESCE(p.product_length_cm, m.product_length_cm) * COALESCE(p.product_height_cm, m.product_height_cm)
               * COALESCE(p.product_width_cm, m.product_width_cm) AS product_volume_cm3
    FROM raw_products AS p CROSS JOIN medians AS m JOIN dim_products AS d ON d.product_id = p.product_id"""

ITEMS = "SELECT *, price + freight_value AS total_item_value FROM raw_order_items"

PER_ORDER_PAYMENTS = f"""
    SELECT order_id, {dbl('SUM(payment_value)')} AS total_payment_value,
           MAX(payment_installments) AS payment_installments_max,
           arg_min(payment_type, (payment_sequential, payment_type)) AS payment_type_primary,
           MAX(payment_sequential) AS num_payment_methods
    FROM fact_payments GROUP BY order_id"""
PER_ORDER_ITEMS = f"""
    SELECT order_id, MAX(order_item_id) AS total_items, {dbl('SUM(price)')} AS total_price,
           {dbl('SUM(freight_value)')} AS total_freight, {dbl('SUM(price)')} / COUNT(price) AS avg_item_price,
           COUNT(DISTINCT product_id) AS num_unique_products, COUNT(DISTINCT seller_id) AS num_unique_sellers,
           {dbl('SUM(price) + SUM(freight_value)')} AS total_order_value
    FROM fact_order_items GROUP BY order_id"""
PER_ORDER_REVIEWS = """
    SELECT order_id, arg_min(review_score, (review_creation_date, review_id)) AS review_score,
           MAX(has_comment) AS has_review_comment
    FROM dim_reviews GROUP BY order_id"""
PER_ORDER = {"order_payments": PER_ORDER_PAYMENTS, "order_items_sums": PER_ORDER_ITEMS, "order_reviews": PER_ORDER_REVIEWS}
PARTS = """dim_orders AS o LEFT JOIN dim_customers AS c ON c.customer_id = o.customer_id
           LEFT JOIN order_items_sums AS i ON i.order_id = o.order_id
           LEFT JOIN order_payments AS p ON p.order_id = o.order_id
           LEFT JOIN order_reviews AS r ON r.order_id = o.order_id"""

# Expected columns and read types per raw table.
EXPECTED = {
    "customers": [("customer_id", "object"), ("customer_unique_id", "object"), ("customer_zip_code_prefix", "int64"),
                  ("customer_city", "object"), ("customer_state", "object")],
    "orders": [(c, "object") for c in (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date")],
    "order_items": [("order_id", "object"), ("order_item_id", "int64"), ("product_id", "object"),
                    ("seller_id", "object"), ("shipping_limit_date", "object"), ("price", "float64"),
                    ("freight_value", "float64")],
    "payments": [("order_id", "object"), ("payment_sequential", "int64"), ("payment_type", "object"),
                 ("payment_installments", "int64"), ("payment_value", "float64")],
    "products": [("product_id", "object"), ("product_category_name", "object")],
    "sellers": [("seller_id", "object"), ("seller_zip_code_prefix", "int64"), ("seller_city", "object"),
                ("seller_state", "object")],
    "reviews": [("review_id", "object"), ("order_id", "object"), ("review_score", "int64"),
                ("review_creation_date", "object"), ("review_answer_timestamp", "object")],
    "geolocation": [("geolocation_zip_code_prefix", "int64"), ("geolocation_lat", "float64"),
                    ("geolocation_lng", "float64"), ("geolocation_city", "object"), ("geolocation_state", "object")],
    "category_translation": [("product_category_name", "object"), ("product_category_name_english", "object")],
}
EXTRA = {
    "products": sorted(MEASURES),
    "reviews": ["review_comment_message", "review_comment_title"],
}
KEYS = {
    "customers": ["customer_id"], "orders": ["order_id"], "products": ["product_id"], "sellers": ["seller_id"],
    "order_items": ["order_id", "order_item_id"], "payments": ["order_id", "payment_sequential"],
    "reviews": ["review_id", "order_id"],
}
REFERENCES = [
    ("orders", "customer_id", "customers"), ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"), ("order_items", "seller_id", "sellers"),
    ("payments", "order_id", "orders"), ("reviews", "order_id", "orders"),
]


def _row(table: str, check: str, status: str, detail: str, rest: str = "") -> str:
    return f"""SELECT '{table}' AS "table", {check} AS "check", {status} AS status, {detail} AS detail {rest}"""


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _schema_rows() -> list[str]:
    rows = []
    for table, columns in EXPECTED.items():
        extra = EXTRA.get(table, [])
        rows.append(_row(table, "'COLUMNS'", "'PASS'", f"'{len(columns) + len(extra)} columns found'"))
        if extra:
            rows.append(_row(table, "'EXTRA_COLS'", "'INFO'", _quote("{" + ", ".join(f"'{c}'" for c in extra) + "}")))
        for c, kind in columns:
            text = f"trim(CAST({c} AS VARCHAR))"
            found = f"""CASE WHEN COUNT({c}) = 0 THEN 'float64'
                WHEN COUNT(*) FILTER (regexp_full_match({text}, '[+-]?[0-9]+') AND typeof({c}) <> 'DOUBLE') = COUNT(*) THEN 'int64'
                WHEN COUNT(*) FILTER (TRY_CAST({text} AS DOUBLE) IS NOT NULL) = COUNT({c}) THEN 'float64'
                ELSE 'object' END"""
            rows.append(f"""SELECT * FROM ({_row(table, f"'DTYPE_{c}'", "'WARN'",
                        f"'Expected {kind}, got ' || {found}", f"FROM raw_{table}")}) AS found
                        WHERE detail <> 'Expected {kind}, got {kind}'""")
    return rows


def _null_rows() -> list[str]:
    rows = []
    for table, columns in EXPECTED.items():
        for c in [name for name, _ in columns] + EXTRA.get(table, []):
            n = f"(COUNT(*) - COUNT({c}))"
            share = f"printf('%.1f', {rnd(f'{n} * 100e0 / COUNT(*)', 1)})"
            rows.append(_row(table, f"'NULLS_{c}'", "'INFO'",
                             f"format('{{:,}}', {n}) || ' nulls (' || {share} || '%)'", f"FROM raw_{table} HAVING {n} > 0"))
    return rows


def _key_rows() -> list[str]:
    rows = []
    for table, key in KEYS.items():
        columns = ", ".join(key)
        shared = f"(SELECT COUNT(*) AS n FROM raw_{table} GROUP BY {columns} HAVING COUNT(*) > 1) AS shared"
        listed = "[" + ", ".join(f"'{c}'" for c in key) + "]"
        rows.append(_row(table, "'PRIMARY_KEY'", "CASE WHEN COALESCE(SUM(n), 0) = 0 THEN 'PASS' ELSE 'FAIL' END",
                         _quote(f"PK={listed}, duplicates=") + f" || {big('COALESCE(SUM(n), 0)')}", f"FROM {shared}"))
    return rows


def _reference_rows() -> list[str]:
    rows = []
    for child, column, parent in REFERENCES:
        orphans = f"""(SELECT COUNT(DISTINCT {column}) FROM raw_{child}
                       WHERE {column} NOT IN (SELECT {column} FROM raw_{parent}))"""
        rows.append(_row(child, f"'FK_{column}→{parent}.{column}'",
                         f"CASE WHEN {orphans} = 0 THEN 'PASS' ELSE 'WARN' END",
                         f"{orphans} || ' orphan values out of ' || COUNT(DISTINCT {column}) || ' unique'",
                         f"FROM raw_{child}"))
    return rows


def _duplicate_rows() -> list[str]:
    rows = []
    for table in EXPECTED:
        n, kinds = f"(SELECT COUNT(*) FROM raw_{table})", f"(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_{table}) AS d)"
        rows.append(_row(table, "'DUPLICATES'", f"CASE WHEN {n} = {kinds} THEN 'PASS' ELSE 'WARN' END",
                         f"({n} - {kinds}) || ' duplicate rows out of ' || format('{{:,}}', {n})"))
    return rows


def _union(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


REPORT = _union(_schema_rows() + _null_rows() + _key_rows() + _reference_rows() + _duplicate_rows())

STAR = {
    "dim_customers": ("SELECT * FROM dim_customers", {}),
    "dim_orders": ("SELECT * FROM dim_orders", {}),
    "dim_products": ("SELECT * FROM products_imputed", {"medians": MEDIANS, "products_imputed": PRODUCTS}),
    "dim_sellers": ("SELECT * FROM dim_sellers", {}),
    "dim_reviews": ("""SELECT * REPLACE (nullif(review_comment_title, '') AS review_comment_title,
                       nullif(review_comment_message, '') AS review_comment_message) FROM dim_reviews""", {}),
    "fact_order_items": ("SELECT * FROM items_as_stored", {"items_as_stored": ITEMS}),
    "fact_payments": (f"SELECT * REPLACE ({dbl('payment_value')} AS payment_value) FROM fact_payments", {}),
    "ref_geolocation": ("SELECT * FROM ref_geolocation", {}),
}
COUNTED = [t for t in STAR]

SQL = {
    "filter_delivered": statement(
        "SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM delivered_orders"),
    "time_features": statement("""
        SELECT order_id, order_purchase_timestamp, order_year, order_month, order_year_month, order_day_of_week, order_hour
        FROM dim_hourly_orders"""),
    "delivery_features": statement("SELECT order_id, order_status, delivery_days, delivery_delay_days FROM dim_orders"),
    "impute_median": statement(
        f"SELECT product_id, {FILLED} FROM raw_products AS p CROSS JOIN medians AS m", medians=MEDIANS),
    "domain_values": statement("""
        SELECT DISTINCT 'payment_type' AS domain, payment_type AS value FROM fact_payments
        UNION ALL SELECT DISTINCT 'order_status', order_status FROM dim_orders
        UNION ALL SELECT DISTINCT 'product_category_name_english', product_category_name_english FROM dim_products
        UNION ALL SELECT DISTINCT 'customer_state', customer_state FROM dim_customers"""),
    "clean_customers": statement("SELECT * FROM dim_customers"),
    "clean_orders": statement("SELECT * FROM dim_orders_text"),
    "clean_order_items": statement("SELECT * FROM items_as_stored", items_as_stored=ITEMS),
    "clean_payments": statement(STAR["fact_payments"][0]),
    "clean_products": statement("SELECT * FROM products_imputed", medians=MEDIANS, products_imputed=PRODUCTS),
    "clean_sellers": statement("SELECT * FROM dim_sellers"),
    "clean_reviews": statement("SELECT * FROM dim_reviews"),
    "geo_by_zip": statement("SELECT * FROM ref_geolocation"),
    "payments_per_order": statement("SELECT * FROM order_payments", order_payments=PER_ORDER_PAYMENTS),
    "items_per_order": statement("SELECT * FROM order_items_sums", order_items_sums=PER_ORDER_ITEMS),
    "reviews_per_order": statement("SELECT * FROM order_reviews", order_reviews=PER_ORDER_REVIEWS),
    "first_review_per_order": statement("""
        SELECT order_id, review_id, review_score, has_comment FROM dim_reviews
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_creation_date NULLS LAST, review_id) = 1"""),
    "analytical_dataset": statement(f"""
        SELECT o.*, c.* EXCLUDE (customer_id),
               COALESCE(total_items, 0) AS total_items, COALESCE(total_price, 0) AS total_price,
               COALESCE(total_freight, 0) AS total_freight, avg_item_price,
               COALESCE(num_unique_products, 0) AS num_unique_products,
               COALESCE(num_unique_sellers, 0) AS num_unique_sellers,
               COALESCE(total_order_value, 0) AS total_order_value,
               COALESCE(total_payment_value, 0) AS total_payment_value, payment_installments_max,
               payment_type_primary, num_payment_methods, review_score, has_review_comment
        FROM {PARTS}""", **PER_ORDER),
    "item_level_dataset": statement("""
        SELECT i.*, p.* EXCLUDE (product_id), s.* EXCLUDE (seller_id), o.customer_id, o.order_status,
               o.order_purchase_timestamp, o.order_year, o.order_month, o.order_year_month, o.order_day_of_week,
               o.delivery_days, o.delivery_delay_days
        FROM items_as_stored AS i LEFT JOIN products_imputed AS p ON p.product_id = i.product_id
        LEFT JOIN dim_sellers AS s ON s.seller_id = i.seller_id LEFT JOIN dim_orders AS o ON o.order_id = i.order_id""",
        items_as_stored=ITEMS, medians=MEDIANS, products_imputed=PRODUCTS),
    "join_completeness": statement(f"""
        SELECT order_rows, joined_table, unmatched FROM (
            SELECT COUNT(*) AS order_rows, COUNT(*) - COUNT(customer_unique_id) AS customers,
                   COUNT(*) - COUNT(total_price) AS order_items, COUNT(*) - COUNT(total_payment_value) AS payments,
                   COUNT(*) - COUNT(review_score) AS reviews
            FROM {PARTS}) AS counted
        UNPIVOT (unmatched FOR joined_table IN (customers, order_items, payments, reviews))""", **PER_ORDER),
    "dq_schema": statement(_union(_schema_rows())),
    "dq_nulls": statement(_union(_null_rows())),
    "dq_primary_keys": statement(_union(_key_rows())),
    "dq_foreign_keys": statement(_union(_reference_rows())),
    "dq_duplicates": statement(_union(_duplicate_rows())),
    "data_quality_report": statement(REPORT),
    "dq_summary": statement("SELECT status, COUNT(*) AS checks FROM report GROUP BY status", report=REPORT),
    "dq_failures": statement("SELECT * FROM report WHERE status = 'FAIL'", report=REPORT),
    "stage_reload": statement("SELECT * FROM dim_orders"),
    "csv_roundtrip": statement(STAR["dim_reviews"][0]),
    "csv_by_name": statement("SELECT * FROM raw_order_items"),
    "table_counts": statement(
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in COUNTED)
        + " UNION ALL SELECT 'TOTAL', " + " + ".join(f"(SELECT COUNT(*) FROM {t})" for t in COUNTED)),
    **{f"star_load_{table}": statement(select, **ctes) for table, (select, ctes) in STAR.items()},
}
