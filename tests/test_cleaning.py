from datetime import datetime

from tallymart.plans import clean, integrate
from tallymart.plans.star import star_table
from tests.tiny import item, order, review, rows, tiny_star


def only(df, *columns):
    return rows(df.select(*columns))


def test_approval_is_filled_by_the_status_as_delivered(spark):
    star = tiny_star(spark, orders=[
        order("a", approved=None), order("b", status=" Delivered ", approved=None), order("c", approved="2017-01-11 00:00:00")])
    got = {r[0]: r[1:] for r in only(star.orders, "order_id", "order_status", "order_approved_at")}
    assert got["a"] == ("delivered", datetime(2017, 1, 10, 10))
    assert got["b"] == ("delivered", None)
    assert got["c"] == ("delivered", datetime(2017, 1, 11))


def test_unreadable_times_become_null(spark):
    star = tiny_star(spark, orders=[order("a", bought="junk", got="2017-13-45")])
    columns = ["order_purchase_timestamp", "order_year_month", "order_hour", "delivery_days", "delivery_delay_days"]
    assert only(star.orders, *columns) == [(None, None, None, None, None)]


def test_time_features_and_fractional_days(spark):
    star = tiny_star(spark, orders=[order("a", got="2017-01-15 22:00:00", due="2017-01-16 00:00:00")])
    columns = ["order_year", "order_month", "order_year_month", "order_day_of_week", "order_hour", "delivery_days"]
    assert only(star.orders, *columns) == [(2017, 1, "2017-01", "Tuesday", 10, 5.5)]
    assert abs(only(star.orders, "delivery_delay_days")[0][0] + 2 / 24) < 1e-12


def test_days_do_not_depend_on_the_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # clocks change between the two days
    try:
        star = tiny_star(spark, orders=[
            order("a", bought="1997-07-01 00:00:00", got="1997-12-01 00:00:00", due="1997-12-03 06:00:00.5")])
        days, late = only(star.orders, "delivery_days", "delivery_delay_days")[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days == 153.0 and abs(late + 2.25 + 0.5 / 86400) < 1e-12


def test_payment_types(spark):
    star = tiny_star(spark, payments=[("o", 1, " Not_Defined ", 1, 1.0), ("o", 2, "BOLETO", 1, 1.0), ("o", 3, None, 1, 1.0)])
    assert [r[0] for r in only(star.payments, "payment_type")] == ["other", "boleto", None]


def test_products_are_named_imputed_and_measured(spark):
    star = tiny_star(
        spark,
        products=[("a", "x", 1.0, 2.0, 3.0), ("b", None, None, 4.0, 3.0), ("c", "y", 4.0, None, 3.0)],
        category_translation=[("x", "ex")])
    got = {r["product_id"]: r.asDict() for r in star.products_imputed.collect()}
    assert got["a"]["product_category_name_english"] == "ex"
    assert got["b"]["product_category_name_english"] == "unknown"
    assert got["c"]["product_category_name_english"] == "y"
    assert got["b"]["product_length_cm"] == 2.5 and got["c"]["product_height_cm"] == 3.0
    assert got["b"]["product_volume_cm3"] == 2.5 * 4 * 3


def test_comment_of_blanks_counts(spark):
    star = tiny_star(spark, reviews=[review("r1", "a", 5, " "), review("r2", "a", 5, ""), review("r3", "a", 5)])
    assert [r[0] for r in only(star.reviews, "has_comment")] == [1, 0, 0]
    assert [r[0] for r in only(star_table(star, "dim_reviews"), "review_comment_message")] == [" ", None, None]


def test_geolocation_takes_first_values_that_are_not_missing(spark):
    star = tiny_star(spark, geolocation=[(1, 1.0, 2.0, None, "sp"), (1, 3.0, None, " B ", None), (1, 5.0, 4.0, "a", "rj")])
    assert rows(star.geolocation) == [(1, 3.0, 3.0, "a", "RJ")]


def test_payments_per_order(spark):
    star = tiny_star(spark, payments=[
        ("a", 3, "boleto", 2, 1.5), ("a", 1, None, 1, 2.0), ("a", 2, "voucher", 9, None), ("b", 1, "boleto", 1, None)])
    got = {r[0]: r[1:] for r in rows(integrate.payments_per_order(star.payments))}
    # The first payment has no type; the number of methods is the last sequence number.
    assert got == {"a": (3.5, 9, "voucher", 3), "b": (0.0, 1, "boleto", 1)}


def test_items_per_order_uses_the_highest_item_number(spark):
    star = tiny_star(spark, order_items=[item("a", 1, "p", "s", 10.0, 1.0), item("a", 7, "q", "s", 20.0, 0.5)])
    assert rows(integrate.items_per_order(star.order_items)) == [("a", 7, 30.0, 1.5, 15.0, 2, 1, 31.5)]


def test_first_review_puts_undated_last(spark):
    star = tiny_star(spark, reviews=[
        review("r3", "a", 1, created=None), review("r2", "a", 2, "text"), review("r1", "a", 3),
        review("r0", "a", None, created="2016-01-01 00:00:00")])
    assert rows(integrate.reviews_per_order(star.reviews)) == [("a", 3, 1)]
    assert rows(integrate.first_review_per_order(star.reviews)) == [("a", "r0", None, 0)]


def test_analytical_dataset_fills_seven_columns(spark):
    star = tiny_star(spark, orders=[order("a", customer_id="nobody")])
    got = integrate.analytical_dataset(star).first().asDict()
    zero = {c for c, v in got.items() if v == 0}
    assert zero == set(integrate.ZERO_FILLED)
    for c in ("avg_item_price", "payment_installments_max", "payment_type_primary", "num_payment_methods", "review_score",
              "has_review_comment", "customer_unique_id"):
        assert got[c] is None
    gaps = {r["joined_table"]: r["unmatched"] for r in integrate.join_completeness(star).collect()}
    assert gaps == {"customers": 1, "order_items": 1, "payments": 1, "reviews": 1}


def test_impute_keeps_a_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    assert rows(clean.impute_medians(df, ["a", "b", "not_there"])) == [(None, 1.0), (None, 1.0)]
    assert rows(clean.impute_medians(df, ["a", "b", "not_there"], exact=False)) == [(None, 1.0), (None, 1.0)]
