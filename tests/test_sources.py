import logging

from tallymart import schemas
from tallymart.plans.publish import save_results
from tallymart.plans.star import Star, write_star
from tallymart.sources.files import load_tables, read_csv, read_json, write_csv, write_json
from tests.tiny import order, item, rows, tiny_star

REVIEWS_CSV = '''review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,,"two lines
and ""quotes"", a comma",2018-01-01 00:00:00,2018-01-02 03:04:05
r2,o1,bad,NA,null,,
'''


def test_raw_csv_files(spark, tmp_path, caplog):
    (tmp_path / "reviews.csv").write_text(REVIEWS_CSV)
    with caplog.at_level(logging.WARNING):
        tables = load_tables(spark, str(tmp_path))
    assert list(tables) == ["reviews"]
    assert "orders" in caplog.text
    first, second = tables["reviews"].orderBy("review_id").collect()
    assert first["review_comment_message"] == 'two lines\nand "quotes", a comma' and first["review_comment_title"] is None
    assert tuple(second) == ("r2", "o1", None, None, None, None, None)
    cleaned = Star(tables).reviews.orderBy("review_id").collect()
    assert [r["has_comment"] for r in cleaned] == [1, 0]
    assert cleaned[0]["review_answer_timestamp"].isoformat() == "2018-01-02T03:04:05"


def test_csv_and_json_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a\n\"b\"", 1.5, None), ("", 2.5, 3)], "t string, x double, n bigint")
    write_csv(df, f"{tmp_path}/csv")
    assert sorted(rows(read_csv(spark, f"{tmp_path}/csv", df.schema, multi_line=True)), key=repr) == [
        ('a\n"b"', 1.5, None), (None, 2.5, 3)]
    write_json(df, f"{tmp_path}/json")
    assert sorted(rows(read_json(spark, f"{tmp_path}/json", df.schema))) == [("", 2.5, 3), ('a\n"b"', 1.5, None)]


def test_star_is_replaced_and_reports_run_on_it(spark, tmp_path):
    from tallymart.plans import reports

    star = tiny_star(spark, customers=[("c1", "u1", 1, "rio", "RJ")], orders=[order("a")], order_items=[item("a")])
    for partition_by in (None, {"dim_orders": ["order_year"]}):
        stored = write_star(star, str(tmp_path), partition_by=partition_by)
    assert stored.orders.count() == 1
    assert set(stored.products.columns) < set(schemas.STAR_TABLES["dim_products"][1])  # columns on both sides
    assert rows(reports.overview(stored)) == rows(reports.overview(star))
    plan = reports.status_breakdown(stored)._jdf.queryExecution().executedPlan().toString()
    assert "order_purchase_timestamp" not in plan  # only the needed column is read
    sold = reports.monthly_trends(stored)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,delivered)" in sold


def test_failed_jobs_do_not_stop_the_others(spark, tmp_path):
    def broken():
        raise RuntimeError("no")

    results = save_results({"bad": broken, "good": lambda: spark.range(2)}, str(tmp_path))
    assert results["bad"] is None and results["good"].count() == 2
    assert spark.read.csv(f"{tmp_path}/good", header=True).count() == 2


def test_jobs_side_by_side(spark, tmp_path):
    from threading import Barrier

    both = Barrier(2, timeout=60)

    def waits(n):
        both.wait()
        return spark.range(n)

    jobs = {"two": lambda: waits(2), "bad": lambda: spark.table("absent"), "three": lambda: waits(3)}
    results = save_results(jobs, str(tmp_path), at_once=3)
    assert list(results) == list(jobs) and results["bad"] is None
    assert [results[k].count() for k in ("two", "three")] == [2, 3]


def test_columns_are_found_by_name(spark, tmp_path):
    """Another order, one more column, one missing, and texts and NaN where numbers belong."""
    from tallymart.plans.quality import quality_report
    from tallymart.sources.files import load_texts

    (tmp_path / "order_items.csv").write_text(
        "price,remark,order_id,order_item_id,product_id,seller_id,freight_value\n"
        "10.5,x,o1,1,p1,s1,1.0\nabc,y,o2,1,p2,s2,2.0\nNaN,z,o3,1,p3,s3,3.0\n")
    got = load_tables(spark, str(tmp_path))["order_items"].orderBy("order_id")
    assert [(r["order_id"], r["order_item_id"], r["price"], r["freight_value"], r["shipping_limit_date"]) for r in got.collect()] == [
        ("o1", 1, 10.5, 1.0, None), ("o2", 1, None, 2.0, None), ("o3", 1, None, 3.0, None)]
    found = {(r["check"], r["status"]): r["detail"] for r in quality_report(load_texts(spark, str(tmp_path))).where(
        "table = 'order_items'").collect()}
    assert found["EXTRA_COLS", "INFO"] == "{'remark'}" and found["MISSING_COLS", "FAIL"] == "{'shipping_limit_date'}"
    assert found["DTYPE_price", "WARN"] == "Expected float64, got object" and found["NULLS_price", "INFO"].startswith("1 nulls")
