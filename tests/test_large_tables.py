"""The same results when no table counts as small and every join key counts as hot."""

import pytest

import __spark_entry__ as spark_entry
from tallymart.operators import joins
from tests.compare import differences, duck

NAMES = [
    "q1_overview", "q5_category_performance", "q9_seller_performance", "q17_category_reviews", "kpis", "filtered_kpis",
    "sales_cube", "cube_state_category", "analytical_dataset", "item_level_dataset", "eda_category_scores",
    "delivery_box_by_score", "q4_top_customers", "q8_customer_segmentation", "q11_regional_performance",
]


@pytest.fixture(autouse=True)
def large(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 2)
    monkeypatch.setattr(joins, "HOT_KEYS", 2000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, sf_dir):
    df = spark_entry.queries()[name](spark, sf_dir)
    assert differences(df, duck(sf_dir), spark_entry.oracle_sql()[name]) == []


def test_a_hot_order_is_spread(spark, sf_dir):
    df = spark_entry.queries()["q5_category_performance"](spark, sf_dir)
    assert "_slice" in df._jdf.queryExecution().executedPlan().toString()
