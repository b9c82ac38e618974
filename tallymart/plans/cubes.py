"""Cubes for the dashboard's filters, and their export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.functions.exprs import money, ratio, rounded
from tallymart.plans.reports import total
from tallymart.plans.sales import category_sales, delivered_orders, order_states, repeated, scores_per_order

# Output widths and placeholders of the exports.
SHORT_CATEGORY, LONG_CATEGORY = 15, 20
OTHER, UNKNOWN = "Other", "Unknown"


def _cells(star, *order_columns: str) -> DataFrame:
    """Delivered items at (order, category) grain with order columns and state; unknown products stay."""
    orders = order_states(star, delivered_orders(star, *order_columns))
    return category_sales(star, orders, "left")


def shown(width: int | None) -> Column:
    """The category's name, or its first ``width`` characters."""
    return F.col("category") if width is None else F.substring("category", 1, width)


def state_category_cube(star, width: int | None = SHORT_CATEGORY) -> DataFrame:
    """Month, state, category: revenue and orders.

    Rows are per full category and the name is cut to ``width`` characters afterwards, so names that begin alike repeat; None leaves it whole,
    and then (m, s, c) is unique but for the placeholder.
    """
    return (
        _cells(star, "order_year_month")
        .groupBy("order_year_month", "customer_state", "category")
        .agg(total("revenue").alias("revenue"), F.count("*").alias("orders"))
        .select(
            F.coalesce("order_year_month", F.lit(OTHER)).alias("m"),
            F.coalesce("customer_state", F.lit(OTHER)).alias("s"),
            F.coalesce(shown(width), F.lit(OTHER)).alias("c"),
            money(F.col("revenue")).alias("r"),
            F.col("orders").alias("o"),
        )
    )


def sales_cube(star, width: int | None = LONG_CATEGORY) -> DataFrame:
    """Year, month, state, category, payment type: orders, revenue, mean score, customers.

    An order's items repeat per payment of the type and per review, as in a plain join of the three. ``width`` as in ``state_category_cube``.
    """
    payments = star.payments.groupBy("order_id", "payment_type").agg(F.count("*").alias("n_payments"))
    cells = (
        _cells(star, "order_year", "order_year_month")
        .join(payments, "order_id", "left")
        .join(scores_per_order(star.reviews), "order_id", "left")
    )
    n_payments = F.coalesce("n_payments", F.lit(1))
    copies = F.greatest(F.coalesce("n_reviews", F.lit(1)), F.lit(1))
    return (
        cells.groupBy("order_year", "order_year_month", "customer_state", "category", "payment_type")
        .agg(
            F.count("*").alias("orders"),
            F.sum(repeated(F.col("revenue"), n_payments, copies)).alias("revenue"),
            F.sum(repeated(F.col("score_sum"), F.col("n_items"), n_payments)).alias("scores"),
            F.sum(repeated(F.col("n_scores"), F.col("n_items"), n_payments)).alias("scored"),
            F.count_distinct("customer_id").alias("cust"),
        )
        .select(
            F.col("order_year").alias("yr"),
            F.coalesce("order_year_month", F.lit(UNKNOWN)).alias("mo"),
            F.coalesce("customer_state", F.lit(UNKNOWN)).alias("st"),
            F.coalesce(shown(width), F.lit(UNKNOWN)).alias("cat"),
            F.coalesce("payment_type", F.lit(UNKNOWN)).alias("pay"),
            "orders",
            money(F.col("revenue")).alias("rev"),
            rounded(ratio(F.col("scores"), F.col("scored")), 2).alias("rev_score"),
            "cust",
        )
    )


def year_month_cube(star) -> DataFrame:
    """Year, month, state, category: orders and revenue."""
    return (
        _cells(star, "order_year", "order_year_month")
        .groupBy(F.col("order_year").alias("year"), F.col("order_year_month").alias("month"),
                 F.col("customer_state").alias("state"), "category")
        .agg(F.count("*").alias("orders"), money(total("revenue")).alias("revenue"))
    )
