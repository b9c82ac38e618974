"""The catalogue of named business questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymart.functions.exprs import (
    cents, exact_micros, fixed_point, from_fixed_point, mean_days, money, percent, ratio, rounded, weekday_number, wide,
)
from tallymart.operators.joins import lookup_join
from tallymart.operators.selection import top_k, with_row_of, with_share
from tallymart.plans.sales import (
    category_sales, delivered_orders, distinct_products_and_sellers, order_sales, per_customer, repeated,
    with_review_copies,
)


def total(name: str):
    """Sum of a column of whole cents."""
    return F.sum(wide(F.col(name)))


def all_items_revenue(star) -> DataFrame:
    """One row: the revenue of all items, delivered or not."""
    return star.order_items.agg(money(F.sum(wide(cents(F.col("price"))))))


def overview(star) -> DataFrame:
    """Totals over delivered items."""
    totals = order_sales(star).agg(
        F.count("*").alias("total_orders"),
        F.count_distinct("customer_id").alias("total_customers"),
        money(total("revenue")).alias("total_revenue"),
        money(total("freight")).alias("total_freight"),
        money(total("gmv")).alias("total_gmv"),
        rounded(ratio(money(total("revenue")), F.sum("n_items")), 2).alias("avg_item_price"),
    )
    named = distinct_products_and_sellers(star).select(F.struct("unique_products", "active_sellers"))
    return with_row_of(totals, named, "_named").select(*totals.columns, "_named.*")


def monthly_trends(star) -> DataFrame:
    return (
        order_sales(star, "order_year_month")
        .groupBy("order_year_month")
        .agg(
            F.count("*").alias("order_count"),
            money(total("revenue")).alias("revenue"),
            money(total("freight")).alias("freight_revenue"),
            F.count_distinct("customer_id").alias("unique_customers"),
            rounded(ratio(money(total("revenue")), F.sum("n_items")), 2).alias("avg_order_value"),
        )
        .orderBy("order_year_month")
    )


def yearly_summary(star) -> DataFrame:
    return (
        order_sales(star, "order_year")
        .groupBy("order_year")
        .agg(
            F.count("*").alias("order_count"),
            money(total("revenue")).alias("revenue"),
            F.count_distinct("customer_id").alias("unique_customers"),
            rounded(ratio(money(total("revenue")), F.count("*")), 2).alias("avg_order_value"),
        )
        .orderBy("order_year")
    )


def top_customers(star, k: int = 10, reviews: str = "fan_out") -> DataFrame:
    """People by spend. City and state are those of the person's smallest customer id."""
    orders = with_review_copies(order_sales(star), star, reviews)
    spend = per_customer(
        orders, star,
        F.count("*").alias("orders"),
        F.sum(repeated(F.col("revenue"), F.col("copies"))).alias("spent"),
        F.sum(F.col("n_items") * F.col("copies")).alias("items"),
        F.sum(F.col("score_sum") * F.col("n_items")).alias("scores"),
        F.sum(F.col("n_scores") * F.col("n_items")).alias("scored"),
        columns=("customer_unique_id", "customer_city", "customer_state"),
    )
    people = spend.groupBy("customer_unique_id").agg(
        F.min_by("customer_city", "customer_id").alias("customer_city"),
        F.min_by("customer_state", "customer_id").alias("customer_state"),
        F.sum("orders").alias("total_orders"),
        money(F.sum("spent")).alias("total_spent"),
        rounded(ratio(money(F.sum("spent")), F.sum("items")), 2).alias("avg_item_value"),
        rounded(ratio(F.sum("scores"), F.sum("scored")), 1).alias("avg_review_score"),
    )
    return top_k(people, k, F.desc("total_spent"), F.asc("customer_unique_id"))


def category_performance(star, k: int = 20) -> DataFrame:
    """Categories by delivered revenue; the share is of the revenue of all items, delivered or not."""
    categories = (
        category_sales(star, delivered_orders(star).select("order_id"))
        .groupBy("category")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("item_numbers").alias("items_sold"),
            money(total("revenue")).alias("total_revenue"),
            rounded(ratio(money(total("revenue")), F.sum("n_items")), 2).alias("avg_price"),
        )
    )
    shares = with_share(categories, "revenue_share_pct", F.col("total_revenue"), all_items_revenue(star), 2)
    return top_k(shares, k, F.desc("total_revenue"), F.asc("category"))


def payment_distribution(star) -> DataFrame:
    """All payments by type."""
    paid = wide(cents(F.col("payment_value")))
    kinds = (
        star.payments.groupBy("payment_type")
        .agg(
            F.count("*").alias("transaction_count"),
            money(F.sum(paid)).alias("total_value"),
            rounded(ratio(money(F.sum(paid)), F.count("payment_value")), 2).alias("avg_value"),
            rounded(ratio(F.sum("payment_installments"), F.count("payment_installments")), 1).alias("avg_installments"),
        )
    )
    n_payments = star.payments.agg(F.count("*"))
    return with_share(kinds, "pct_of_transactions", F.col("transaction_count"), n_payments, 2).orderBy(
        F.desc("total_value"), "payment_type")


def delivery_by_state(star) -> DataFrame:
    """Delivery times per state; an order without an estimate counts as not on time."""
    orders = delivered_orders(star, "delivery_days", "delivery_delay_days").where("delivery_days IS NOT NULL")
    delay = F.col("delivery_delay_days")
    return (
        per_customer(
            orders, star,
            F.count("*").alias("orders"),
            F.sum(exact_micros(F.col("delivery_days"))).alias("days"),
            F.sum(exact_micros(delay)).alias("delays"),
            F.count(delay).alias("n_delays"),
            F.count_if(delay <= 0).alias("on_time"),
            columns=("customer_state",),
        )
        .groupBy("customer_state")
        .agg(
            F.sum("orders").alias("order_count"),
            rounded(mean_days(F.sum("days"), F.sum("orders")), 1).alias("avg_delivery_days"),
            rounded(mean_days(F.sum("delays"), F.sum("n_delays")), 1).alias("avg_delay_days"),
            rounded(percent(F.sum("on_time"), F.sum("orders")), 1).alias("on_time_pct"),
        )
        .orderBy("avg_delivery_days", "customer_state")
    )


def seller_performance(star, k: int = 15, reviews: str = "fan_out") -> DataFrame:
    """Sellers by delivered revenue."""
    sold = star.order_items.select("order_id", "seller_id", "product_id", cents(F.col("price")).alias("revenue"))
    orders = with_review_copies(delivered_orders(star).select("order_id"), star, reviews)
    rows = lookup_join(sold, orders, "order_id", "inner", ["seller_id", "product_id"], star.rows("orders"))
    # Per seller and order first, then per seller; the seller's products are counted from pairs in the same two steps.
    totals = rows.groupBy("seller_id", "order_id").agg(
        F.sum(repeated(F.col("revenue"), F.col("copies"))).alias("revenue"), F.sum("copies").alias("items"),
        F.sum("score_sum").alias("scores"), F.sum("n_scores").alias("scored"))
    totals = totals.groupBy("seller_id").agg(F.count("order_id").alias("orders_fulfilled"), *[F.sum(c).alias(c) for c in ("revenue", "items", "scores", "scored")])
    products = rows.groupBy("seller_id", "product_id").agg(F.count("*").alias("n")).groupBy("seller_id").agg(F.count("product_id").alias("unique_products"))
    sellers = (
        totals.join(products, "seller_id")
        .join(star.sellers.select("seller_id", "seller_city", "seller_state"), "seller_id")
        .select(
            "seller_id", "seller_city", "seller_state", "orders_fulfilled",
            money(F.col("revenue")).alias("total_revenue"),
            rounded(ratio(money(F.col("revenue")), F.col("items")), 2).alias("avg_item_price"),
            "unique_products",
            rounded(ratio(F.col("scores"), F.col("scored")), 2).alias("avg_review_score"),
        )
    )
    return top_k(sellers, k, F.desc("total_revenue"), F.asc("seller_id"))


def review_analysis(star) -> DataFrame:
    """Reviews of delivered orders by score; the percentage is of all reviews."""
    scored = star.reviews.groupBy("order_id", "review_score").agg(
        F.count("*").alias("n"), F.sum("has_comment").alias("comments")
    )
    days, delays = F.col("delivery_days"), F.col("delivery_delay_days")
    scores = (
        scored.join(delivered_orders(star, "delivery_days", "delivery_delay_days"), "order_id")
        .groupBy("review_score")
        .agg(
            F.sum("n").alias("review_count"),
            rounded(mean_days(F.sum(exact_micros(days) * F.col("n")), F.sum(F.when(days.isNotNull(), F.col("n")))), 1)
            .alias("avg_delivery_days"),
            rounded(mean_days(F.sum(exact_micros(delays) * F.col("n")), F.sum(F.when(delays.isNotNull(), F.col("n")))), 1)
            .alias("avg_delay_days"),
            F.sum("comments").alias("with_comments"),
        )
    )
    n_reviews = star.reviews.agg(F.count("*"))
    return with_share(scores, "pct", F.col("review_count"), n_reviews, 1).select(
        "review_score", "review_count", "pct", "avg_delivery_days", "avg_delay_days", "with_comments"
    ).orderBy("review_score")


def regional_performance(star) -> DataFrame:
    """States by delivered revenue; the share is of the revenue of all items."""
    states = (
        customer_totals(star)
        .groupBy("customer_state")
        .agg(
            F.sum("orders").alias("order_count"),
            F.count_distinct("customer_unique_id").alias("unique_customers"),
            money(total("revenue")).alias("total_revenue"),
            rounded(ratio(money(total("revenue")), F.sum("items")), 2).alias("avg_order_value"),
        )
    )
    shares = with_share(states, "revenue_share_pct", F.col("total_revenue"), all_items_revenue(star), 2)
    return shares.orderBy(F.desc("total_revenue"), "customer_state")


def customer_totals(star) -> DataFrame:
    """Delivered orders, items and revenue per customer id, with person and state."""
    return per_customer(
        order_sales(star), star,
        F.count("*").alias("orders"),
        F.sum("n_items").alias("items"),
        total("revenue").alias("revenue"),
        columns=("customer_unique_id", "customer_state"),
    )


def weekday_patterns(star) -> DataFrame:
    return (
        order_sales(star, "order_day_of_week")
        .groupBy("order_day_of_week")
        .agg(
            F.count("*").alias("order_count"),
            money(total("revenue")).alias("revenue"),
            rounded(ratio(money(total("revenue")), F.sum("n_items")), 2).alias("avg_item_price"),
        )
        .orderBy(weekday_number(F.col("order_day_of_week")))
    )


def hourly_patterns(star) -> DataFrame:
    return (
        order_sales(star, "order_hour")
        .groupBy("order_hour")
        .agg(F.count("*").alias("order_count"), money(total("revenue")).alias("revenue"))
        .orderBy("order_hour")
    )


def status_breakdown(star) -> DataFrame:
    """All orders by status."""
    statuses = star.orders.groupBy("order_status").agg(F.count("*").alias("order_count"))
    shares = with_share(statuses, "pct", F.col("order_count"), star.orders.agg(F.count("*")), 2)
    return shares.orderBy(F.desc("order_count"), "order_status")


def freight_per_customer(star) -> DataFrame:
    """Delivered freight per customer id; the freight share of an item without a price is left out."""
    share = F.try_divide("freight_value", "price")
    freight = star.order_items.groupBy("order_id").agg(
        F.count("*").alias("n_items"),
        F.sum(cents(F.col("freight_value"))).alias("freight"),
        F.sum(fixed_point(share)).alias("shares"),
        F.count(share).alias("n_shares"),
    )
    return per_customer(
        delivered_orders(star).join(freight, "order_id"), star,
        *[F.sum(wide(F.col(c))).alias(c) for c in ("n_items", "freight", "shares", "n_shares")],
        columns=("customer_state",),
    )


def freight_analysis(star) -> DataFrame:
    return (
        freight_per_customer(star)
        .groupBy("customer_state")
        .agg(
            rounded(ratio(money(total("freight")), F.sum("n_items")), 2).alias("avg_freight"),
            money(total("freight")).alias("total_freight"),
            rounded(ratio(from_fixed_point(F.sum("shares")), F.sum("n_shares")) * 100.0, 1).alias("freight_pct_of_price"),
            F.sum("n_items").cast("bigint").alias("item_count"),
        )
        .orderBy(F.desc("avg_freight"), "customer_state")
    )


def yoy_growth(star) -> DataFrame:
    """Each year against the calendar year before; NULL when that year has no sales."""
    yearly = order_sales(star, "order_year").groupBy("order_year").agg(
        money(total("revenue")).alias("revenue"), F.count("*").alias("orders")
    )
    before = yearly.select(
        (F.col("order_year") + 1).alias("order_year"), F.col("revenue").alias("revenue_before"),
        F.col("orders").alias("orders_before"),
    )
    return (
        yearly.join(before, "order_year", "left")
        .select(
            "order_year", "revenue", "orders",
            rounded(percent(F.col("revenue") - F.col("revenue_before"), F.col("revenue_before")), 1)
            .alias("revenue_growth_pct"),
            rounded(percent(F.col("orders") - F.col("orders_before"), F.col("orders_before")), 1)
            .alias("order_growth_pct"),
        )
        .orderBy("order_year")
    )


def category_reviews(star, k: int = 20, min_reviews: int = 50) -> DataFrame:
    """Categories by mean score; a review counts once per item of its order, but once as a review."""
    sold = category_sales(star, delivered_orders(star).select("order_id")).select("order_id", "category", "n_items")
    reviews = star.reviews.select("order_id", "review_id", "review_score")
    score, weight = F.col("review_score"), F.col("n_items")
    by_category = (
        lookup_join(reviews, sold, "order_id", "inner", ["review_id"], star.rows("order_items"))
        .groupBy("category")
        .agg(
            F.count_distinct("review_id").alias("review_count"),
            rounded(ratio(F.sum(score * weight), F.sum(F.when(score.isNotNull(), weight))), 2).alias("avg_score"),
            F.sum(F.when(score >= 4, weight).otherwise(0)).alias("positive_reviews"),
            F.sum(F.when(score <= 2, weight).otherwise(0)).alias("negative_reviews"),
            F.sum(weight).alias("rows"),
        )
        .where(F.col("review_count") >= min_reviews)
        .withColumn("satisfaction_rate", rounded(percent(F.col("positive_reviews"), F.col("rows")), 1))
        .drop("rows")
    )
    return top_k(by_category, k, F.desc("avg_score"), F.asc("category"))
