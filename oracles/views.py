"""DuckDB checks for the dashboard, the cubes, the exploratory datasets and the follow-on numbers."""

from __future__ import annotations

from oracles.base import avg, big, dbl, rnd, statement
from oracles.reports import PEOPLE, SCORED, SEGMENT_CTES, SEGMENTED, SOLD_CATEGORY, SOLD_TO, SQL as REPORTS

REVIEWED = "LEFT JOIN dim_reviews AS r ON r.order_id = s.order_id"
ALL_REVENUE = dbl("(SELECT SUM(price) FROM fact_order_items)")

KPI_COLUMNS = f"""{dbl('SUM(price)')} AS total_revenue, COUNT(DISTINCT s.order_id) AS total_orders,
    COUNT(DISTINCT customer_unique_id) AS unique_customers,
    {rnd(dbl('SUM(price)') + ' / COUNT(DISTINCT s.order_id)', 2)} AS avg_order_value,
    {rnd(avg('review_score'), 2)} AS avg_review_score, {dbl('SUM(freight_value)')} AS total_freight,
    {rnd(avg('delivery_days'), 1)} AS avg_delivery_days,
    COUNT(DISTINCT s.product_id) AS unique_products, COUNT(DISTINCT seller_id) AS active_sellers"""
KPIS = f"SELECT {KPI_COLUMNS} FROM {SOLD_TO} {REVIEWED}"

MONTHS = f"""SELECT order_year_month AS month, {dbl('SUM(price)')} AS revenue, COUNT(DISTINCT order_id) AS orders,
                    COUNT(DISTINCT customer_id) AS customers
             FROM sold GROUP BY order_year_month"""
INNER_MONTHS = """SELECT * FROM months
                  WHERE month > (SELECT MIN(month) FROM months) AND month < (SELECT MAX(month) FROM months)"""
CATEGORIES = f"""SELECT product_category_name_english AS category, {dbl('SUM(price)')} AS revenue,
                        COUNT(DISTINCT s.order_id) AS orders
                 FROM {SOLD_CATEGORY} GROUP BY category ORDER BY revenue DESC, category LIMIT 15"""
REGIONS = f"""SELECT customer_state AS state, {dbl('SUM(price)')} AS revenue, COUNT(DISTINCT s.order_id) AS orders,
                     COUNT(DISTINCT customer_unique_id) AS customers
              FROM {SOLD_TO} GROUP BY customer_state"""
PAYMENTS = f"""SELECT payment_type AS type, COUNT(*) AS count, {dbl('SUM(payment_value)')} AS value
               FROM fact_payments GROUP BY payment_type"""
SHORT_SEGMENTS = f"""SELECT CASE segment WHEN 'Loyal Customers' THEN 'Loyal' WHEN 'Recent Customers' THEN 'Recent'
                                 WHEN 'Potential Loyalists' THEN 'Potential' ELSE segment END AS segment,
                            COUNT(*) AS count, {dbl('SUM(monetary)')} AS revenue
                     FROM segmented GROUP BY 1"""
SEGMENT_BASE = {"people": PEOPLE, "scored": SCORED, "segmented": SEGMENTED}
SCORES = "SELECT review_score AS score, COUNT(*) AS count FROM dim_reviews GROUP BY review_score"
DELIVERY = f"""SELECT COUNT(*) FILTER (delivery_delay_days <= 0) AS on_time,
                      COUNT(*) FILTER (delivery_delay_days > 0) AS late, COUNT(*) AS total,
                      {rnd(avg('delivery_days'), 1)} AS avg_delivery_days,
                      {rnd(avg('delivery_delay_days'), 1)} AS avg_delay,
                      {rnd('COUNT(*) FILTER (delivery_delay_days <= 0) * 100e0 / COUNT(*)', 1)} AS on_time_rate
               FROM delivered_orders WHERE delivery_delay_days IS NOT NULL"""
WEEKDAYS = "SELECT order_day_of_week AS day, COUNT(DISTINCT order_id) AS orders FROM delivered_orders GROUP BY 1"
YEARS = f"""SELECT order_year AS year, {dbl('SUM(price)')} AS revenue, COUNT(DISTINCT order_id) AS orders
            FROM sold GROUP BY order_year"""

CUBE_FROM = f"{SOLD_TO} LEFT JOIN dim_products AS p ON p.product_id = s.product_id"
CUBE_SMALL = f"""
    SELECT order_year_month AS m, customer_state AS s, substring(product_category_name_english, 1, 15) AS c,
           {dbl('SUM(price)')} AS r, COUNT(DISTINCT s.order_id) AS o
    FROM {CUBE_FROM} GROUP BY order_year_month, customer_state, product_category_name_english"""


def _histogram(values: str, bins: int = 50) -> dict[str, str]:
    return {
        "vals": values,
        "edges": "SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5e0 ELSE min(v) END AS lo, "
                 "CASE WHEN min(v) = max(v) THEN max(v) + 0.5e0 ELSE max(v) END AS hi FROM vals",
        "hist": f"""SELECT b.bin, lo + b.bin * ((hi - lo) / {bins}e0) AS bin_start,
                           lo + (b.bin + 1) * ((hi - lo) / {bins}e0) AS bin_end, COALESCE(h.count, 0) AS count
                    FROM (SELECT unnest(range({bins})) AS bin) AS b CROSS JOIN edges
                    LEFT JOIN (SELECT i AS bin, COUNT(*) AS count
                               FROM vals JOIN (SELECT i, lo + i * ((hi - lo) / {bins}e0) AS begins,
                                                      lo + (i + 1) * ((hi - lo) / {bins}e0) AS ends
                                               FROM range({bins}) AS r(i) CROSS JOIN edges) AS e
                                 ON v >= begins AND (v < ends OR i = {bins - 1})
                               GROUP BY i) AS h ON h.bin = b.bin""",
    }


PERSONS = f"""SELECT customer_unique_id, COUNT(DISTINCT s.order_id) AS total_orders, {dbl('SUM(price)')} AS total_spent
              FROM {SOLD_TO} GROUP BY customer_unique_id"""
QUARTILES = f"""SELECT quantile_cont({dbl('price')}, 0.25) AS q1, quantile_cont({dbl('price')}, 0.75) AS q3
                FROM fact_order_items"""
FENCE = "SELECT q1, q3, q3 - q1 AS iqr, q3 + 1.5e0 * (q3 - q1) AS upper_bound FROM quartiles"
SELLERS = """SELECT v.seller_id, arg_min(seller_state, v.seller_id) AS seller_state, SUM(price) AS revenue,
                    COUNT(DISTINCT order_id) AS orders, COUNT(order_item_id) AS items
             FROM fact_order_items AS i JOIN dim_sellers AS v ON v.seller_id = i.seller_id GROUP BY v.seller_id"""
PARETO = f"""SELECT seller_id, {dbl('revenue')} AS revenue,
                    row_number() OVER w AS position,
                    row_number() OVER w * 100e0 / COUNT(*) OVER () AS seller_pct,
                    {dbl('SUM(revenue) OVER w')} * 100e0 / {dbl('SUM(revenue) OVER ()')} AS cumulative_pct
             FROM sellers WINDOW w AS (ORDER BY revenue DESC, seller_id ROWS UNBOUNDED PRECEDING)"""
COMPLETE = """SELECT CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value, delivery_days,
                     delivery_delay_days, CAST(review_score AS DOUBLE) AS review_score
              FROM sold AS s JOIN dim_reviews AS r ON r.order_id = s.order_id
              WHERE delivery_days IS NOT NULL AND delivery_delay_days IS NOT NULL AND review_score IS NOT NULL"""
CORRELATED = ["price", "freight_value", "delivery_days", "delivery_delay_days", "review_score"]
CATEGORY_SCORES = f"""
    SELECT product_category_name_english AS category, {avg('review_score')} AS avg_score,
           COUNT(review_score) AS count, {dbl('SUM(price)')} AS revenue
    FROM {SOLD_CATEGORY} JOIN dim_reviews AS r ON r.order_id = s.order_id
    GROUP BY category HAVING COUNT(review_score) >= 100 ORDER BY avg_score DESC, category LIMIT 15"""


def _findings(section: str, report: str, label: str, order: str, metrics: list[str], limit: str = "") -> str:
    ranked = f"SELECT row_number() OVER (ORDER BY {order}) AS rank, * FROM ({REPORTS[report]}) AS report"
    return " UNION ALL ".join(
        f"""SELECT '{section}' AS section, CAST(rank AS INTEGER) AS rank, CAST({label} AS VARCHAR) AS label,
                   '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ({ranked}) AS ranked {limit}"""
        for m in metrics)


def _amount(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(38,2)) AS VARCHAR)"


def _table(section: str, source: str, order: str, columns: dict[str, str]) -> str:
    """One document section with a list per column; kinds: t text, n whole number, a amount."""
    written = {"t": "'\"' || {0} || '\"'", "n": "CAST({0} AS VARCHAR)"}
    lists = []
    for c, kind in columns.items():
        value = _amount(c) if kind == "a" else written[kind].format(c)
        lists.append(f"""'"{c}":[' || string_agg({value}, ',' ORDER BY {order}) || ']'""")
    return f"SELECT '{section}' AS section, '{{' || " + " || ',' || ".join(lists) + f" || '}}' AS json FROM {source}"


def _object(section: str, source: str, columns: dict[str, str]) -> str:
    parts = [f"""'"{c}":' || {_amount(c) if k == 'a' else f'CAST({c} AS VARCHAR)'}""" for c, k in columns.items()]
    return f"SELECT '{section}' AS section, '{{' || " + " || ',' || ".join(parts) + f" || '}}' AS json FROM {source}"


WEEKDAY_NUMBER = "list_position(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'], day)"
DOCUMENT = " UNION ALL ".join([
    _object("kpis", "kpi_row", {
        "total_revenue": "a", "total_orders": "n", "unique_customers": "n", "avg_order_value": "a",
        "avg_review_score": "a", "total_freight": "a", "avg_delivery_days": "a", "unique_products": "n",
        "active_sellers": "n"}),
    _table("monthly_trends", "inner_months", "month", {"month": "t", "revenue": "a", "orders": "n", "customers": "n"}),
    _table("category_performance", "categories", "revenue DESC, category", {"category": "t", "revenue": "a", "orders": "n"}),
    _table("regional_data", "regions", "revenue DESC, state", {"state": "t", "revenue": "a", "orders": "n", "customers": "n"}),
    _table("payment_distribution", "payments", "value DESC, type", {"type": "t", "count": "n", "value": "a"}),
    _table("customer_segments", "short_segments", "revenue DESC, segment", {"segment": "t", "count": "n", "revenue": "a"}),
    _table("review_distribution", "scores", "score", {"score": "n", "count": "n"}),
    _object("delivery_metrics", "delivery", {
        "on_time": "n", "late": "n", "total": "n", "avg_delivery_days": "a", "avg_delay": "a", "on_time_rate": "a"}),
    _table("dow_patterns", "weekdays", WEEKDAY_NUMBER, {"day": "t", "orders": "n"}),
    _table("yearly_summary", "years", "year", {"year": "n", "revenue": "a", "orders": "n"}),
])

SQL = {
    "findings_digest": " UNION ALL ".join([
        _findings("overview", "q1_overview", "'all'", "1", [
            "total_orders", "total_customers", "total_revenue", "total_gmv", "avg_item_price", "unique_products",
            "active_sellers"]),
        _findings("payments", "q6_payment_distribution", "payment_type", "total_value DESC, payment_type",
                  ["pct_of_transactions", "total_value"]),
        _findings("categories", "q5_category_performance", "category", "total_revenue DESC, category",
                  ["total_revenue", "revenue_share_pct"], "WHERE rank <= 5"),
        _findings("segments", "q8_customer_segmentation", "segment", "total_revenue DESC, segment",
                  ["customer_count", "total_revenue"]),
        _findings("reviews", "q10_review_analysis", "review_score", "review_score",
                  ["review_count", "pct", "avg_delivery_days"]),
    ]),
    "kpis": statement(KPIS),
    "kpis_per_order_reviews": statement(f"""
        SELECT {KPI_COLUMNS} FROM {SOLD_TO}
        LEFT JOIN (SELECT order_id, {avg('review_score')} AS review_score FROM dim_reviews GROUP BY order_id) AS r
          ON r.order_id = s.order_id"""),
    "filtered_kpis": statement(f"""
        SELECT {KPI_COLUMNS} FROM {SOLD_TO} JOIN dim_products AS p ON p.product_id = s.product_id {REVIEWED}
        WHERE order_year = 1997 AND customer_state = 'NATION_3' AND product_category_name_english = 'BRAND#4'"""),
    "cube_kpis": statement(KPIS),
    "cube_filtered_kpis": statement(f"""
        SELECT {KPI_COLUMNS} FROM {SOLD_TO} JOIN dim_products AS p ON p.product_id = s.product_id {REVIEWED}
        WHERE order_year = 1997 AND customer_state = 'NATION_3' AND product_category_name_english = 'BRAND#4'"""),
    "cube_distinct_by_year": statement(f"""
        SELECT order_year AS year, COUNT(DISTINCT customer_unique_id) AS customers, COUNT(DISTINCT product_id) AS products,
               COUNT(DISTINCT seller_id) AS sellers FROM {SOLD_TO} GROUP BY order_year"""),
    "cube_distinct_by_state_category": statement(f"""
        SELECT customer_state AS state, product_category_name_english AS category, COUNT(DISTINCT customer_unique_id) AS customers,
               COUNT(DISTINCT s.product_id) AS products, COUNT(DISTINCT seller_id) AS sellers FROM {CUBE_FROM} GROUP BY ALL"""),
    "kpi_cards": statement("""
        SELECT total_revenue, CAST(CAST(total_revenue AS DECIMAL(28,2)) + CAST(total_freight AS DECIMAL(28,2)) AS DOUBLE)
                   AS total_gmv, total_orders, unique_products, active_sellers,
               unique_customers, avg_order_value, k.avg_delivery_days, avg_review_score,
               (SELECT COUNT(*) FROM dim_reviews) AS total_reviews, on_time_rate, on_time, late
        FROM kpi_row AS k CROSS JOIN delivery""", kpi_row=KPIS, delivery=DELIVERY),
    "monthly_trends": statement("SELECT * FROM inner_months", months=MONTHS, inner_months=INNER_MONTHS),
    "monthly_trends_for_year": statement(
        "SELECT * FROM inner_months WHERE left(month, 4) = '1997'", months=MONTHS, inner_months=INNER_MONTHS),
    "category_performance": statement(CATEGORIES),
    "regional_data": statement(REGIONS),
    "payment_distribution": statement(PAYMENTS),
    "payment_share": statement(
        f"SELECT type, value, {rnd('value * 100e0 / SUM(value) OVER ()', 1)} AS share_pct FROM payments", payments=PAYMENTS),
    "customer_segments": statement(SHORT_SEGMENTS, **SEGMENT_BASE),
    "review_distribution": statement(SCORES),
    "review_share": statement(
        f"SELECT score, count, {rnd('count * 100e0 / SUM(count) OVER ()', 1)} AS share_pct FROM scores", scores=SCORES),
    "delivery_metrics": statement(DELIVERY),
    "dow_patterns": statement(WEEKDAYS),
    "dow_patterns_weekend": statement(
        "SELECT day, orders, CAST(day IN ('Saturday', 'Sunday') AS INTEGER) AS is_weekend FROM weekdays", weekdays=WEEKDAYS),
    "yearly_summary": statement(YEARS),
    "dashboard_document": statement(
        DOCUMENT, kpi_row=KPIS, months=MONTHS, inner_months=INNER_MONTHS, categories=CATEGORIES, regions=REGIONS,
        payments=PAYMENTS, **SEGMENT_BASE, short_segments=SHORT_SEGMENTS, scores=SCORES, delivery=DELIVERY,
        weekdays=WEEKDAYS, years=YEARS),
    "cube_state_category": statement(CUBE_SMALL),
    "sales_cube_json": statement(CUBE_SMALL),
    "sales_cube": statement(f"""
        SELECT order_year AS yr, order_year_month AS mo, customer_state AS st,
               substring(product_category_name_english, 1, 20) AS cat, COALESCE(payment_type, 'Unknown') AS pay,
               COUNT(DISTINCT s.order_id) AS orders, {dbl('SUM(price)')} AS rev,
               {rnd(avg('review_score'), 2)} AS rev_score, COUNT(DISTINCT s.customer_id) AS cust
        FROM {CUBE_FROM} LEFT JOIN fact_payments AS f ON f.order_id = s.order_id {REVIEWED}
        GROUP BY order_year, order_year_month, customer_state, product_category_name_english, payment_type"""),
    "cube_year_month": statement(f"""
        SELECT order_year AS year, order_year_month AS month, customer_state AS state,
               product_category_name_english AS category, COUNT(DISTINCT s.order_id) AS orders,
               {dbl('SUM(price)')} AS revenue
        FROM {CUBE_FROM} GROUP BY 1, 2, 3, 4"""),
    "eda_monthly": statement(
        "SELECT month AS order_year_month, revenue, orders FROM inner_months", months=MONTHS, inner_months=INNER_MONTHS),
    "eda_category_revenue": statement(f"""
        SELECT product_category_name_english AS category, {dbl('SUM(price)')} AS revenue
        FROM fact_order_items AS i JOIN dim_products AS p ON p.product_id = i.product_id
        GROUP BY category ORDER BY revenue DESC, category LIMIT 15"""),
    "eda_payment_mix": statement(f"""
        SELECT payment_type AS type, {dbl('SUM(payment_value)')} AS total_value, COUNT(payment_value) AS count,
               {dbl('SUM(payment_value)')} * 100e0 / {dbl('(SELECT SUM(payment_value) FROM fact_payments)')} AS value_pct
        FROM fact_payments GROUP BY payment_type"""),
    "eda_review_counts": statement("""
        SELECT review_score, COUNT(*) AS count
        FROM dim_reviews AS r JOIN delivered_orders AS d ON d.order_id = r.order_id GROUP BY review_score"""),
    "delivery_box_by_score": statement("""
        SELECT b.review_score, n, q1, median, q3,
               least(min(v) FILTER (v >= q1 - 1.5e0 * (q3 - q1)), any_value(q1)) AS whisker_low,
               greatest(max(v) FILTER (v <= q3 + 1.5e0 * (q3 - q1)), any_value(q3)) AS whisker_high
        FROM boxes AS b JOIN times AS t ON t.review_score = b.review_score GROUP BY b.review_score, n, q1, median, q3""",
        times="""SELECT review_score, delivery_days AS v
                 FROM dim_reviews AS r JOIN delivered_orders AS d ON d.order_id = r.order_id
                 WHERE delivery_days IS NOT NULL""",
        boxes="""SELECT review_score, COUNT(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                        quantile_cont(v, 0.75) AS q3 FROM times GROUP BY review_score"""),
    "eda_region_top15": statement(
        "SELECT state AS customer_state, revenue, orders FROM regions ORDER BY revenue DESC, state LIMIT 15",
        regions=REGIONS),
    "eda_correlation": statement(" UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {rnd(f'corr({x}, {y})', 6)} AS correlation FROM complete_rows"
        for x in CORRELATED for y in CORRELATED), complete_rows=COMPLETE),
    "purchase_frequency": statement("""
        SELECT total_orders, COUNT(*) AS customers FROM persons GROUP BY total_orders ORDER BY total_orders LIMIT 10""",
        persons=PERSONS),
    "histogram_ltv": statement(
        "SELECT * FROM hist", persons=PERSONS, **_histogram("SELECT total_spent AS v FROM persons")),
    "dow_reindexed": statement(f"""
        SELECT w.day AS order_day_of_week, revenue
        FROM (SELECT unnest(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']) AS day) AS w
        LEFT JOIN (SELECT order_day_of_week, {dbl('SUM(price)')} AS revenue FROM sold GROUP BY 1) AS t
          ON t.order_day_of_week = w.day"""),
    "eda_hourly": statement("""
        SELECT order_hour, COUNT(DISTINCT d.order_id) AS orders
        FROM dim_hourly_orders AS d JOIN fact_hourly_items AS i ON i.order_id = d.order_id
        WHERE order_status = 'delivered' GROUP BY order_hour"""),
    "histogram_delivery": statement(
        "SELECT hist.*, (SELECT median(v) FROM vals) AS median FROM hist",
        **_histogram("""SELECT delivery_days AS v FROM delivered_orders
                        WHERE delivery_days IS NOT NULL AND customer_id IN (SELECT customer_id FROM dim_customers)""")),
    "ontime_by_state": statement("""
        SELECT customer_state, on_time, late, on_time + late AS total,
               on_time / CAST(on_time + late AS DOUBLE) * 100e0 AS on_time_pct
        FROM (SELECT customer_state, COUNT(*) FILTER (delivery_delay_days <= 0) AS on_time,
                     COUNT(*) FILTER (delivery_delay_days > 0) AS late
              FROM delivered_orders AS d JOIN dim_customers AS c ON c.customer_id = d.customer_id
              GROUP BY customer_state) AS t
        ORDER BY total DESC, customer_state LIMIT 10"""),
    "price_outliers": statement(f"""
        SELECT *, (SELECT COUNT(*) FROM fact_order_items WHERE {dbl('price')} > upper_bound) AS outlier_count FROM fence""",
        quartiles=QUARTILES, fence=FENCE),
    "histogram_price": statement(
        "SELECT * FROM hist", quartiles=QUARTILES, fence=FENCE,
        **_histogram(f"SELECT {dbl('price')} AS v FROM fact_order_items, fence WHERE {dbl('price')} <= upper_bound")),
    "price_freight_sample": statement(f"""
        SELECT order_id, order_item_id, {dbl('price')} AS price, {dbl('freight_value')} AS freight_value
        FROM fact_order_items
        ORDER BY (order_id * 8 + order_item_id) % 2147483648 * 2654435761 % 4294967296, order_id, order_item_id, price, freight_value
        LIMIT 5000"""),
    "seller_stats": statement(f"SELECT seller_id, {dbl('revenue')} AS revenue, orders, items FROM sellers", sellers=SELLERS),
    "seller_pareto": statement(PARETO, sellers=SELLERS),
    "pareto_cutoff": statement(
        "SELECT COALESCE(MIN(seller_pct) FILTER (cumulative_pct >= 80), MIN(seller_pct)) AS seller_pct FROM pareto",
        sellers=SELLERS, pareto=PARETO),
    "seller_state_top10": statement(f"""
        SELECT seller_state, {dbl('SUM(revenue)')} AS revenue FROM sellers GROUP BY seller_state
        ORDER BY revenue DESC, seller_state LIMIT 10""", sellers=SELLERS),
    "eda_order_status": statement("SELECT order_status, COUNT(*) AS count FROM dim_orders GROUP BY order_status"),
    "eda_installments": statement(f"""
        SELECT payment_installments, COUNT(payment_value) AS count, {avg('payment_value')} AS avg_value
        FROM fact_payments WHERE payment_type = 'credit_card' AND payment_installments <= 12
        GROUP BY payment_installments"""),
    "eda_category_scores": statement(
        f"SELECT *, {rnd('AVG(avg_score) OVER ()', 6)} AS mean_of_means FROM category_scores",
        category_scores=CATEGORY_SCORES),
    "eda_freight": statement(f"""
        SELECT customer_state, {avg('freight_value')} AS avg_freight,
               {rnd('AVG(' + dbl('freight_value') + ' / NULLIF(' + dbl('price') + ', 0)) * 100e0', 6)} AS freight_ratio
        FROM {SOLD_TO} GROUP BY customer_state ORDER BY avg_freight DESC, customer_state LIMIT 15"""),
    "segment_revenue_share": statement(f"""
        SELECT segment, total_revenue, {rnd('total_revenue * 100e0 / SUM(total_revenue) OVER ()', 1)} AS revenue_share_pct,
               {rnd('total_revenue * 0.1e0', 2)} AS recovery_value
        FROM segment_totals""", **SEGMENT_CTES),
    "top_n_concentration": statement(f"""
        SELECT 'category' AS dimension, 5 AS top_n, {rnd(f'SUM(revenue) * 100e0 / {ALL_REVENUE}', 1)} AS revenue_share_pct
        FROM (SELECT revenue FROM categories ORDER BY revenue DESC, category LIMIT 5) AS c
        UNION ALL
        SELECT 'state', 3, {rnd(f'SUM(revenue) * 100e0 / {ALL_REVENUE}', 1)}
        FROM (SELECT revenue FROM regions ORDER BY revenue DESC, state LIMIT 3) AS r""",
        categories=CATEGORIES, regions=REGIONS),
    "positive_review_rate": statement(f"""
        SELECT COUNT(*) AS positive_reviews, (SELECT COUNT(*) FROM dim_reviews) AS all_reviews,
               {rnd('COUNT(*) * 100e0 / (SELECT COUNT(*) FROM dim_reviews)', 1)} AS positive_pct
        FROM dim_reviews AS r JOIN delivered_orders AS d ON d.order_id = r.order_id WHERE review_score >= 4"""),
}
