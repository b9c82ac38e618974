"""Times the headline queries and prints one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_RUNS (timed runs after one warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallymart.catalog import QUERIES
from tallymart.session import build_session

HEADLINE = [
    "q1_overview", "q2_monthly_trends", "q3_yearly_summary", "q4_top_customers", "q5_category_performance",
    "q6_payment_distribution", "q7_delivery_by_state", "q8_customer_segmentation", "q9_seller_performance",
    "q10_review_analysis", "q11_regional_performance", "q12_dow_patterns", "q13_hourly_patterns",
    "q14_cancellation_analysis", "q15_freight_analysis", "q16_yoy_growth", "q17_category_reviews",
    "kpis", "sales_cube", "analytical_dataset", "item_level_dataset", "clean_orders", "clean_products",
    "price_outliers", "delivery_box_by_score", "eda_correlation", "seller_pareto", "dq_primary_keys", "dq_nulls",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR",
    })
    for name in HEADLINE:
        run(QUERIES[name], spark, sf_dir)
    times = {n: statistics.median(run(QUERIES[n], spark, sf_dir) for _ in range(runs)) for n in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {n: round(t, 3) for n, t in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
