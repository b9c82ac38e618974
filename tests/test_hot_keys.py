"""One order, customer, product and seller hold a third of all rows: results still equal the plain SQL."""

import glob
import os
import shutil

import duckdb
import pytest

import __spark_entry__ as spark_entry
from tallymart.operators import joins
from tests.compare import differences, duck

# The same joins in plain SQL make every item-review pair; the payment cube would be too many for it.
NAMES = [
    "q1_overview", "q2_monthly_trends", "q4_top_customers", "q5_category_performance", "q7_delivery_by_state",
    "q8_customer_segmentation", "q9_seller_performance", "q10_review_analysis", "q11_regional_performance",
    "q15_freight_analysis", "q17_category_reviews", "kpis", "cube_state_category", "analytical_dataset",
    "item_level_dataset", "items_per_order", "reviews_per_order", "eda_correlation", "eda_category_scores",
    "delivery_box_by_score", "seller_pareto", "dq_primary_keys", "dq_duplicates", "price_outliers",
]


@pytest.fixture(scope="module")
def hot_dir(sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        shutil.copy(path, folder)
    order = con.sql(f"SELECT min(o_orderkey) FROM '{sf_dir}/orders.parquet' WHERE o_orderstatus = 'F'").fetchall()[0][0]
    changes = {
        "lineitem": f"""l_orderkey: CASE WHEN file_row_number % 3 = 0 THEN {order} ELSE l_orderkey END,
                        l_partkey: CASE WHEN file_row_number % 3 = 1 THEN 7 ELSE l_partkey END,
                        l_suppkey: CASE WHEN file_row_number % 3 = 2 THEN 3 ELSE l_suppkey END""",
        "orders": "o_custkey: CASE WHEN file_row_number % 3 = 0 THEN 5 ELSE o_custkey END",
        "events": f"event_id: CASE WHEN file_row_number % 3 = 0 THEN {2 * order} ELSE event_id END",
    }
    for table, change in changes.items():
        replaced = ", ".join(f"{part.split(':', 1)[1]} AS {part.split(':', 1)[0].strip()}" for part in change.split(",\n"))
        os.remove(f"{folder}/{table}.parquet")
        con.execute(f"""COPY (SELECT * EXCLUDE (file_row_number) REPLACE ({replaced})
                        FROM read_parquet('{sf_dir}/{table}.parquet', file_row_number = true))
                        TO '{folder}/{table}.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.fixture(autouse=True)
def large(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 2)
    monkeypatch.setattr(joins, "HOT_KEYS", 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, hot_dir):
    df = spark_entry.queries()[name](spark, hot_dir)
    assert differences(df, duck(hot_dir), spark_entry.oracle_sql()[name]) == []
