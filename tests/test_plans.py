"""What reaches the scans, and what the plans leave out."""

from tallymart.catalog import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unused_columns_and_joins_are_pruned(spark, sf_dir):
    text = plan(QUERIES["q14_cancellation_analysis"](spark, sf_dir))
    assert "struct<o_orderstatus:string>" in text and "lineitem" not in text
    assert "l_shipdate" not in plan(QUERIES["q2_monthly_trends"](spark, sf_dir))


def test_distinct_customers_need_no_expansion(spark, sf_dir):
    for name in ("q1_overview", "q2_monthly_trends", "q3_yearly_summary", "q9_seller_performance", "q11_regional_performance", "kpis", "filtered_kpis"):
        assert "Expand" not in plan(QUERIES[name](spark, sf_dir)), name


def test_category_grain_needs_no_shuffle_of_its_own(spark, sf_dir):
    """Without broadcasts of the orders, rows stay partitioned by order from the join to the grain."""
    from tallymart.operators import joins

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    limit, joins.BROADCAST_ROWS = joins.BROADCAST_ROWS, 400  # products are small, orders are not
    try:
        text = plan(QUERIES["category_performance"](spark, sf_dir))
    finally:
        joins.BROADCAST_ROWS = limit
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [order_id" in text
    assert not [line for line in text.splitlines() if "Exchange hashpartitioning(category" in line and "order_id" in line]


def test_items_are_shuffled_once_for_each_large_side(spark, sf_dir, monkeypatch):
    """Orders and products are large, sellers are more than a broadcast may have rows but short: two shuffles of items, none of the joined orders."""
    from tallymart.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_ROWS", 9)  # there are 10 sellers
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["item_level_dataset"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line.split("hashpartitioning(")[1] for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    by = [line.split("#")[0] for line in shuffles]
    assert by.count("product_id") == 2 and by.count("order_id") == 1 and by.count("o_orderkey") == 1 and "seller_id" not in by
    assert "_slice" not in text


def test_items_are_the_same_when_they_are_packed(spark, monkeypatch):
    """Every side is shuffled: items without an order, product or seller, keys that come twice, amounts that are no cents, numbers and times that are missing."""
    from tallymart.operators import joins
    from tallymart.plans.integrate import item_level_dataset
    from tests.tiny import SCHEMAS, order, tiny_star

    items = [
        ("o1", 1, "p1", "s1", "2017-01-11 10:00:00", 10.0, 1.5), ("o1", 2, None, "s2", None, 0.005, None), ("o1", 2, None, "s2", None, 0.005, None),
        ("o2", None, "p2", None, "1969-12-31 23:59:59.999999", None, 2.0), (None, 1, "p3", "s9", "2400-01-01 00:00:00", -3.25, 0.0), ("o9", -4, "p9", "s1", None, 1e15, 1.0),
    ]
    tables = {
        "order_items": items, "orders": [order("o1"), order("o1", "c2", got=None), order("o2", bought=None)],
        "products": [("p1", "toys", 1.0, 2.0, 3.0), ("p1", None, 5.0, None, 0.1), ("p2", "toys", None, 7.0, 8.0), (None, "x", 1.0, 1.0, 1.0)],
        "sellers": [("s1", 7, "A", "sp"), ("s1", None, None, None), ("s2", 2**40, "B ", "rj")],
    }
    assert len(SCHEMAS["order_items"].split(",")) == len(items[0])
    small = item_level_dataset(tiny_star(spark, **tables))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    for hot in (100_000, 1):
        monkeypatch.setattr(joins, "HOT_ROWS", hot)
        packed = item_level_dataset(tiny_star(spark, **tables))
        assert "_word0" in plan(packed) and packed.dtypes == small.dtypes
        assert sorted(map(repr, packed.collect())) == sorted(map(repr, small.collect()))
