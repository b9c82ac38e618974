"""The data behind the exploratory charts, unrounded unless said otherwise.

Groups without a key are left out, as in the charts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymart.functions.exprs import (
    WEEKDAYS, cents, fixed_point, from_fixed_point, money, percent, ratio, rounded, weekday_number, wide,
)
from tallymart.operators.distributions import box_summary, histogram, outlier_fence
from tallymart.operators.moments import co_moments, correlations, merged
from tallymart.operators.quantiles import exact_quantiles
from tallymart.operators.running import running_total
from tallymart.operators.selection import top_k, trim_edges, with_row_of, with_share
from tallymart.plans.reports import customer_totals, freight_per_customer, total
from tallymart.plans.sales import category_sales, delivered_orders, order_sales, per_customer, scores_per_order
from tallymart.session import checkpointed


def monthly(star) -> DataFrame:
    """Revenue and orders per month, always without the first and last month."""
    months = order_sales(star, "order_year_month").where("order_year_month IS NOT NULL").groupBy("order_year_month").agg(
        money(total("revenue")).alias("revenue"), F.count("*").alias("orders"))
    return trim_edges(months, "order_year_month").orderBy("order_year_month")


def category_revenue(star, k: int = 15) -> DataFrame:
    """Top categories by revenue of all items, smallest first."""
    per_product = star.order_items.groupBy("product_id").agg(F.sum(wide(cents(F.col("price")))).alias("revenue"))
    by_category = (
        per_product.join(star.products, "product_id")
        .where("product_category_name_english IS NOT NULL")
        .groupBy(F.col("product_category_name_english").alias("category"))
        .agg(money(F.sum("revenue")).alias("revenue"))
    )
    return top_k(by_category, k, F.desc("revenue"), F.asc("category")).orderBy("revenue", F.desc("category"))


def payment_mix(star) -> DataFrame:
    value = F.sum(wide(cents(F.col("payment_value"))))
    typed = star.payments.where("payment_type IS NOT NULL")
    kinds = (
        typed.groupBy(F.col("payment_type").alias("type"))
        .agg(money(value).alias("total_value"), F.count("payment_value").alias("count"))
    )
    return with_share(kinds, "value_pct", F.col("total_value"), typed.agg(money(value))).orderBy(
        F.desc("total_value"), "type")


def delivered_reviews(star) -> DataFrame:
    """Delivered orders' reviews as (order, score, n) with the order's delivery time."""
    scored = star.reviews.where("review_score IS NOT NULL").groupBy("order_id", "review_score").agg(F.count("*").alias("n"))
    return scored.join(delivered_orders(star, "delivery_days"), "order_id")


def review_counts(star) -> DataFrame:
    return delivered_reviews(star).groupBy("review_score").agg(F.sum("n").alias("count")).orderBy("review_score")


def delivery_box_by_score(star) -> DataFrame:
    """Box summary of the delivery time for each score from 1 to 5."""
    stars = delivered_reviews(star).where(F.col("review_score").between(1, 5))
    stars = checkpointed(stars.select("review_score", "delivery_days", "n"))
    return box_summary(stars, "review_score", "delivery_days", "n").orderBy("review_score")


def region_top15(star, k: int = 15) -> DataFrame:
    states = (
        customer_totals(star).where("customer_state IS NOT NULL").groupBy("customer_state")
        .agg(money(total("revenue")).alias("revenue"), F.sum("orders").alias("orders"))
    )
    return top_k(states, k, F.desc("revenue"), F.asc("customer_state")).orderBy("revenue", F.desc("customer_state"))


CORRELATED = ["price", "freight_value", "delivery_days", "delivery_delay_days", "review_score"]


def correlation(star) -> DataFrame:
    """Correlations over items joined with their orders' reviews, complete rows only, to six digits.

    The joined rows are not made. Within an order all items meet all reviews, so the joined rows' means are those of the items and of
    the reviews, their co-moments are those of either side as often as the other has rows, and items and reviews have none together. Orders are
    merged by the parallel formula, in one job.
    """
    items = co_moments(star.order_items, ["price", "freight_value"], ["order_id"])
    reviews = co_moments(star.reviews, ["review_score"], ["order_id"]).withColumnRenamed("n", "n_reviews")
    orders = delivered_orders(star, "delivery_days", "delivery_delay_days").dropna()
    joined = orders.join(items, "order_id").join(reviews, "order_id")
    own = {c: F.col(c) * F.col("n_reviews") for c in ("c_price_price", "c_price_freight_value", "c_freight_value_freight_value")}
    own["c_review_score_review_score"] = F.col("c_review_score_review_score") * F.col("n")
    parts = joined.select(
        (F.col("n") * F.col("n_reviews")).alias("n"), "m_price", "m_freight_value", "m_review_score",
        *[F.col(c).cast("double").alias(f"m_{c}") for c in ("delivery_days", "delivery_delay_days")], *[v.alias(c) for c, v in own.items()])
    tables = {"price": star.order_items, "freight_value": star.order_items, "review_score": star.reviews}
    near = {c: tables.get(c, star.orders).agg(F.avg(c)) for c in CORRELATED}
    return correlations(merged(parts, CORRELATED, near), CORRELATED)


def person_totals(star) -> DataFrame:
    """Delivered orders and spend per person."""
    return customer_totals(star).groupBy("customer_unique_id").agg(
        F.sum("orders").alias("total_orders"), money(total("revenue")).alias("total_spent"))


def purchase_frequency(star, k: int = 10) -> DataFrame:
    """How many people have placed 1, 2, 3 .. orders: the ``k`` smallest counts."""
    return top_k(person_totals(star).groupBy("total_orders").agg(F.count("*").alias("customers")), k,
                 F.asc("total_orders"))


def spend_histogram(star) -> DataFrame:
    return histogram(person_totals(star), "total_spent")


def weekday_revenue(star) -> DataFrame:
    """Revenue for all seven weekdays, NULL for a day without sales."""
    sold = (
        order_sales(star, "order_day_of_week").groupBy("order_day_of_week")
        .agg(money(total("revenue")).alias("revenue"))
    )
    days = F.explode(F.array(*[F.lit(d) for d in WEEKDAYS])).alias("order_day_of_week")
    week = star.orders.sparkSession.range(1).select(days)
    return week.join(sold, "order_day_of_week", "left").orderBy(weekday_number(F.col("order_day_of_week")))


def hourly(star) -> DataFrame:
    """Orders per hour of the day."""
    return (
        order_sales(star, "order_hour").where("order_hour IS NOT NULL").groupBy("order_hour")
        .agg(F.count("*").alias("orders")).orderBy("order_hour")
    )


def delivery_times(star) -> DataFrame:
    """Delivery times of delivered orders with a known customer, as (delivery_days, n)."""
    reduced = delivered_orders(star, "delivery_days").groupBy("customer_id", "delivery_days").agg(F.count("*").alias("n"))
    return reduced.join(star.customers.select("customer_id"), "customer_id", "left_semi").dropna(subset=["delivery_days"])


def delivery_histogram(star) -> DataFrame:
    """50 bins, with the median repeated on every row."""
    times = checkpointed(delivery_times(star).select("delivery_days", "n"))
    median = exact_quantiles(times, "delivery_days", {"median": 0.5}, weight="n").select("median")
    return with_row_of(histogram(times, "delivery_days", weight="n"), median, "median").orderBy("bin")


def ontime_by_state(star, k: int = 10) -> DataFrame:
    """States with most dated deliveries: on time, late, total and on-time percentage."""
    delay = F.col("delivery_delay_days")
    states = (
        per_customer(
            delivered_orders(star, "delivery_delay_days"), star,
            F.count_if(delay <= 0).alias("on_time"), F.count_if(delay > 0).alias("late"), columns=("customer_state",))
        .where("customer_state IS NOT NULL")
        .groupBy("customer_state").agg(F.sum("on_time").alias("on_time"), F.sum("late").alias("late"))
        .withColumn("total", F.col("on_time") + F.col("late"))
    )
    largest = top_k(states, k, F.desc("total"), F.asc("customer_state"))
    return largest.withColumn("on_time_pct", ratio(F.col("on_time"), F.col("total")) * 100.0)


def price_outliers(star) -> DataFrame:
    return outlier_fence(star.order_items, "price", None)


def price_histogram(star) -> DataFrame:
    """Prices up to the upper fence."""
    fence = outlier_fence(star.order_items, "price", None).select("upper_bound")
    normal = with_row_of(star.order_items.select("price"), fence, "_limit").where(F.col("price") <= F.col("_limit"))
    return histogram(normal, "price")


# A multiplicative hash: ids are reduced first so that the product fits a bigint.
ID_RANGE, SAMPLE_FACTOR, SAMPLE_RANGE = 2147483648, 2654435761, 4294967296


def price_freight_sample(star, n: int = 5000) -> DataFrame:
    """A fixed pseudo-random sample: the rows with the smallest hash of order and item number.

    Sampling is what this job is for; ids that are not numbers are hashed to one first.
    """
    order_id = F.col("order_id")
    if dict(star.order_items.dtypes)["order_id"] == "string":
        order_id = F.crc32(order_id)
    place = (order_id % ID_RANGE * 8 + F.col("order_item_id")) % ID_RANGE * F.lit(SAMPLE_FACTOR) % F.lit(SAMPLE_RANGE)
    columns = ["order_id", "order_item_id", "price", "freight_value"]
    return top_k(star.order_items.select(*columns, place.alias("_place")), n, F.asc("_place"), *columns).drop("_place")


def known_sellers(star, *columns: str) -> DataFrame:
    """Items of all orders per known seller: revenue (cents), orders, items and seller columns."""
    per_seller = star.order_items.groupBy("seller_id").agg(
        F.sum(wide(cents(F.col("price")))).alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
        F.count("order_item_id").alias("items"),
    )
    return per_seller.join(star.sellers.select("seller_id", *columns), "seller_id")


def seller_stats(star) -> DataFrame:
    return known_sellers(star).select("seller_id", money(F.col("revenue")).alias("revenue"), "orders", "items")


def seller_pareto(star) -> DataFrame:
    """Sellers from largest revenue down: position in percent and cumulative revenue in percent."""
    ranked = running_total(
        known_sellers(star).select("seller_id", "revenue"), "revenue", F.desc("revenue"), F.asc("seller_id"))
    return ranked.select(
        "seller_id", money(F.col("revenue")).alias("revenue"), "position",
        percent(F.col("position"), F.col("rows")).alias("seller_pct"),
        percent(money(F.col("running")), money(F.col("total"))).alias("cumulative_pct"),
    )


def pareto_cutoff(star, share: float = 80.0) -> DataFrame:
    """The share of sellers that makes up ``share`` percent of revenue; the first seller if none reaches it."""
    reached = F.when(F.col("cumulative_pct") >= share, F.col("seller_pct"))
    return seller_pareto(star).agg(F.coalesce(F.min(reached), F.min("seller_pct")).alias("seller_pct"))


def seller_states(star, k: int = 10) -> DataFrame:
    states = (
        known_sellers(star, "seller_state").where("seller_state IS NOT NULL").groupBy("seller_state")
        .agg(money(F.sum("revenue")).alias("revenue"))
    )
    return top_k(states, k, F.desc("revenue"), F.asc("seller_state")).orderBy("revenue", F.desc("seller_state"))


def order_status(star) -> DataFrame:
    counts = star.orders.where("order_status IS NOT NULL").groupBy("order_status").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "order_status")


def installments(star, most: int = 12) -> DataFrame:
    """Credit-card payments by number of installments."""
    cards = star.payments.where((F.col("payment_type") == "credit_card") & (F.col("payment_installments") <= most))
    return (
        cards.groupBy("payment_installments")
        .agg(F.count("payment_value").alias("count"),
             ratio(money(F.sum(wide(cents(F.col("payment_value"))))), F.count("payment_value")).alias("avg_value"))
        .orderBy("payment_installments")
    )


def category_scores(star, k: int = 15, min_count: int = 100) -> DataFrame:
    """Best-scored categories, smallest mean first, with the mean of the means shown."""
    sold = category_sales(star, delivered_orders(star).select("order_id")).where("category IS NOT NULL")
    scored = sold.join(scores_per_order(star.reviews), "order_id")
    means = (
        scored.groupBy("category")
        .agg(
            F.sum(wide(F.col("score_sum") * F.col("n_items"))).alias("scores"),
            F.sum(F.col("n_scores") * F.col("n_items")).alias("count"),
            money(F.sum(wide(F.col("revenue")) * F.col("n_reviews"))).alias("revenue"),
        )
        .where(F.col("count") >= min_count)
        .select("category", ratio(F.col("scores"), F.col("count")).alias("avg_score"), "count", "revenue")
    )
    best = top_k(means, k, F.desc("avg_score"), F.asc("category"))
    mean = ratio(from_fixed_point(F.sum(fixed_point(F.col("avg_score")))), F.count("*"))
    return with_row_of(best, best.agg(rounded(mean, 6)), "mean_of_means").orderBy("avg_score", F.desc("category"))


def freight(star, k: int = 15) -> DataFrame:
    """States with the highest mean freight, and freight as a mean percentage of price."""
    states = (
        freight_per_customer(star).where("customer_state IS NOT NULL").groupBy("customer_state")
        .agg(
            ratio(money(F.sum("freight")), F.sum("n_items")).alias("avg_freight"),
            rounded(ratio(from_fixed_point(F.sum("shares")), F.sum("n_shares")) * 100.0, 6).alias("freight_ratio"),
        )
    )
    return top_k(states, k, F.desc("avg_freight"), F.asc("customer_state")).orderBy("avg_freight", F.desc("customer_state"))
