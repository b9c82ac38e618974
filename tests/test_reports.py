import math

import pytest

from tallymart.plans import cubes, dashboard, eda, insights, reports, segments
from tallymart.plans.segments import RfmConfig
from tests.tiny import item, order, review, rows, tiny_star

CUSTOMERS = [("c1", "u1", 1, "rio", "RJ"), ("c2", "u1", 1, "recife", "PE"), ("c3", "u2", 1, "rio", "RJ")]
PRODUCTS = [("p1", "toys", 1.0, 1.0, 1.0), ("p2", "books", 1.0, 1.0, 1.0)]
SELLERS = [("s1", 1, "rio", "RJ"), ("s2", 1, "rio", "RJ")]


@pytest.fixture
def star(spark):
    """Order a: 2 items, 2 reviews, 2 payments of one type; b: 1 item, no review; c: not delivered."""
    return tiny_star(
        spark, customers=CUSTOMERS, products=PRODUCTS, sellers=SELLERS,
        orders=[order("a", "c1"), order("b", "c2", bought="2017-03-01 00:00:00"), order("c", "c3", "shipped")],
        order_items=[item("a", 1, "p1", "s1", 10.0, 1.0), item("a", 2, "p2", "s1", 20.0, 2.0),
                     item("b", 1, "p1", "s2", 40.0, 4.0), item("c", 1, "p1", "s1", 30.0, 3.0)],
        reviews=[review("r1", "a", 5), review("r2", "a", 2), review("r3", "c", 1)],
        payments=[("a", 1, "voucher", 1, 5.0), ("a", 2, "voucher", 1, 25.0)])


def test_reviews_repeat_items_unless_reduced(star):
    repeated = dashboard.kpis(star).first()
    assert (repeated["total_revenue"], repeated["total_freight"]) == (2 * 30.0 + 40.0, 2 * 3.0 + 4.0)
    assert repeated["avg_review_score"] == 3.5 and repeated["total_orders"] == 2 and repeated["unique_customers"] == 1
    once = dashboard.kpis(star, reviews="per_order").first()
    assert (once["total_revenue"], once["avg_review_score"]) == (70.0, 3.5)
    with pytest.raises(ValueError):
        dashboard.kpis(star, reviews="other")


def test_overview_counts_people_per_order(star):
    r = reports.overview(star).first()
    assert (r["total_orders"], r["total_customers"], r["total_revenue"], r["unique_products"], r["active_sellers"]) == (
        2, 2, 70.0, 2, 2)


def test_person_who_moved_counts_in_both_states(star):
    regions = {r["customer_state"]: r["unique_customers"] for r in reports.regional_performance(star).collect()}
    assert regions == {"RJ": 1, "PE": 1}
    top = reports.top_customers(star).collect()
    assert [(r["customer_unique_id"], r["customer_city"], r["customer_state"], r["total_orders"]) for r in top] == [
        ("u1", "rio", "RJ", 2)]
    assert top[0]["total_spent"] == 100.0


def test_shares_use_all_items(star):
    shares = {r["category"]: r["revenue_share_pct"] for r in reports.category_performance(star).collect()}
    assert shares == {"toys": 50.0, "books": 20.0}
    sold = {r["category"]: r["items_sold"] for r in reports.category_performance(star).collect()}
    assert sold == {"toys": 2, "books": 2}  # sums of item numbers


def test_cube_repeats_by_payments_and_reviews(star):
    got = {(r["cat"], r["mo"], r["pay"]): (r["orders"], r["rev"], r["rev_score"], r["cust"]) for r in cubes.sales_cube(star).collect()}
    assert got == {
        ("toys", "2017-01", "voucher"): (1, 40.0, 3.5, 1),
        ("books", "2017-01", "voucher"): (1, 80.0, 3.5, 1),
        ("toys", "2017-03", "Unknown"): (1, 40.0, None, 1),
    }


def test_cut_category_names_may_repeat(spark):
    names = ["a_category_that_is_long_1", "a_category_that_is_long_2"]
    star = tiny_star(
        spark, customers=CUSTOMERS, orders=[order("a")],
        products=[("p1", names[0], 1.0, 1.0, 1.0), ("p2", names[1], 1.0, 1.0, 1.0)],
        order_items=[item("a", 1, "p1"), item("a", 2, "p2"), item("a", 3, "gone")])
    assert sorted(r["c"] for r in cubes.state_category_cube(star).collect()) == ["Other", names[0][:15], names[0][:15]]
    assert sorted(r["cat"] for r in cubes.sales_cube(star).collect()) == ["Unknown", names[0][:20], names[0][:20]]
    assert sorted(r["c"] for r in cubes.state_category_cube(star, width=None).collect()) == ["Other", *names]
    assert sorted(r["cat"] for r in cubes.sales_cube(star, width=None).collect()) == ["Unknown", *names]


def test_price_of_zero_has_no_freight_share(spark):
    star = tiny_star(spark, customers=CUSTOMERS, orders=[order("a")],
                     order_items=[item("a", 1, price=0.0, freight=5.0), item("a", 2, price=10.0, freight=1.0)])
    r = reports.freight_analysis(star).first()
    assert (r["avg_freight"], r["freight_pct_of_price"], r["item_count"]) == (3.0, 10.0, 2)


def test_year_without_sales_gives_no_growth(spark):
    star = tiny_star(
        spark, customers=CUSTOMERS,
        orders=[order("a", bought="2015-05-01"), order("b", bought="2017-05-01"), order("c", bought="2018-05-01")],
        order_items=[item("a"), item("b"), item("c", price=15.0)])
    got = {r["order_year"]: (r["revenue_growth_pct"], r["order_growth_pct"]) for r in reports.yoy_growth(star).collect()}
    assert got == {2015: (None, None), 2017: (None, None), 2018: (50.0, 0.0)}


def test_on_time_percentages_have_their_own_denominators(spark):
    star = tiny_star(
        spark, customers=CUSTOMERS,
        orders=[order("a"), order("b", due=None), order("c", got=None), order("d", got="2017-02-10 00:00:00")])
    assert reports.delivery_by_state(star).first()["on_time_pct"] == pytest.approx(33.3)
    metrics = dashboard.delivery_metrics(star).first()
    assert (metrics["on_time"], metrics["late"], metrics["total"], metrics["on_time_rate"]) == (1, 1, 2, 50.0)
    assert eda.ontime_by_state(star).first()["on_time_pct"] == 50.0
    assert dashboard.delivery_metrics(tiny_star(spark)).first()["on_time_rate"] == 0.0


@pytest.mark.parametrize("bought, score", [
    ("2018-09-01 00:00:00", 5), ("2018-08-31 23:59:59", 4), ("2018-07-03 00:00:00", 4), ("2018-07-02 12:00:00", 3),
    ("2018-04-04 00:00:00", 3), ("2018-04-03 23:00:00", 2), ("2017-10-01 00:00:00", 2), ("2017-09-30 23:59:59", 1),
])
def test_recency_limits_compare_fractions_of_days(spark, bought, score):
    star = tiny_star(spark, customers=CUSTOMERS, orders=[order("a", bought=bought)], order_items=[item("a")])
    assert segments.rfm_scores(star, RfmConfig()).first()["r_score"] == score


def test_frequency_and_spend_scores(spark):
    orders = [order(f"o{i}") for i in range(2)]
    star = tiny_star(spark, customers=CUSTOMERS, orders=orders, order_items=[item("o0", price=100.0), item("o1", price=99.99)])
    r = segments.rfm_scores(star).first()
    assert (r["frequency"], r["f_score"], r["monetary"], r["m_score"]) == (2, 3, 199.99, 3)


def brute_segment(r, f, m):
    if r >= 4 and f >= 3 and m >= 4:
        return "Champions"
    if r >= 3 and f >= 2 and m >= 3:
        return "Loyal Customers"
    if r >= 4 and f <= 2:
        return "Recent Customers"
    if r >= 3 and m >= 3:
        return "Potential Loyalists"
    if r <= 2 and f >= 2:
        return "At Risk"
    return "Lost" if r <= 2 and f <= 1 and m <= 2 else "Others"


def test_all_score_combinations(spark):
    from pyspark.sql import functions as F

    scores = [(r, f, m) for r in range(1, 6) for f in (1, 3, 4, 5) for m in range(1, 6)]
    df = spark.createDataFrame(scores, "r int, f int, m int")
    got = df.select("r", "f", "m", segments.segment_of(F.col("r"), F.col("f"), F.col("m"))).collect()
    assert all(segment == brute_segment(r, f, m) for r, f, m, segment in got)


def test_category_reviews_limit_counts_reviews_once(star):
    got = {r["category"]: tuple(r)[1:] for r in reports.category_reviews(star, min_reviews=2).collect()}
    assert got == {"toys": (2, 3.5, 1, 1, 50.0), "books": (2, 3.5, 1, 1, 50.0)}
    assert reports.category_reviews(star, min_reviews=3).count() == 0


def test_weekday_without_sales_is_kept(star):
    got = dict(rows(eda.weekday_revenue(star)))
    assert len(got) == 7 and got["Tuesday"] == 30.0 and got["Wednesday"] == 40.0 and got["Sunday"] is None


def test_pareto(star):
    assert [(r["seller_id"], r["position"], r["seller_pct"]) for r in eda.seller_pareto(star).orderBy("position").collect()] == [
        ("s1", 1, 50.0), ("s2", 2, 100.0)]
    assert rows(eda.pareto_cutoff(star, 50.0)) == [(50.0,)]
    assert rows(eda.pareto_cutoff(star, 101.0)) == [(50.0,)]


def test_sample_is_whole_when_small(star):
    assert eda.price_freight_sample(star).count() == 4
    assert eda.price_freight_sample(star, 2).count() == 2


def test_selection_of_kpis(star):
    assert dashboard.kpis(star, state="PE").first()["total_revenue"] == 40.0
    assert dashboard.kpis(star, category="books").first()["total_revenue"] == 40.0
    assert dashboard.kpis(star, year=2018).first()["total_orders"] == 0


def test_invariants(spark, sf_dir):
    from tallymart.catalog import QUERIES, RFM, star_of

    tables = star_of(spark, sf_dir)
    total = QUERIES["q1_overview"](spark, sf_dir).first()

    def added(name, column):
        return sum(r[column] for r in QUERIES[name](spark, sf_dir).collect())

    for name, column in [("q2_monthly_trends", "revenue"), ("q3_yearly_summary", "revenue"),
                         ("q8_customer_segmentation", "total_revenue"), ("q11_regional_performance", "total_revenue"),
                         ("q12_dow_patterns", "revenue"), ("regional_data", "revenue")]:
        assert math.isclose(added(name, column), total["total_revenue"], rel_tol=1e-12), name
    for name in ("q2_monthly_trends", "q15_freight_analysis"):
        column = "freight_revenue" if name.startswith("q2") else "total_freight"
        assert math.isclose(added(name, column), total["total_freight"], rel_tol=1e-12)
    for name in ("q2_monthly_trends", "q3_yearly_summary", "q11_regional_performance", "q12_dow_patterns"):
        assert added(name, "order_count") == total["total_orders"]
    assert added("q14_cancellation_analysis", "order_count") == tables.orders.count()
    assert added("q6_payment_distribution", "transaction_count") == tables.payments.count()
    assert added("review_distribution", "count") == tables.reviews.count()
    people = segments.customer_segmentation(tables, RFM)
    kpi = dashboard.kpis(tables).first()
    assert sum(r["customer_count"] for r in people.collect()) == kpi["unique_customers"]
    assert added("q11_regional_performance", "unique_customers") >= kpi["unique_customers"]
    assert kpi["total_revenue"] > total["total_revenue"]
    assert added("q10_review_analysis", "pct") < 100
    assert insights.positive_review_rate(tables).first()["positive_pct"] < 100
