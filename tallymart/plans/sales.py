"""The grains that the reports share.

Items, payments and reviews all hang off an order. A join of two of them repeats each row of one for
every row of the other. The reports keep that arithmetic, but the repeated rows are never made:
each side is first reduced per order, and a sum over the repeated rows is the product of the two
sides' per-order sums. An order with any number of items and reviews stays a handful of rows.

``revenue``, ``freight`` and ``gmv`` columns at these grains are whole cents.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from tallymart.functions.exprs import cents, wide
from tallymart.operators.joins import lookup_join
from tallymart.session import new_shared_path

DELIVERED = "delivered"


def delivered_orders(star, *columns: str) -> DataFrame:
    return star.orders.where(F.col("order_status") == DELIVERED).select("order_id", "customer_id", *columns)


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("*").alias("n_items"),
        F.sum(cents(F.col("price"))).alias("revenue"),
        F.sum(cents(F.col("freight_value"))).alias("freight"),
        F.sum(cents(F.col("total_item_value"))).alias("gmv"),
    )


ORDER_SALES_COLUMNS = [
    "order_purchase_timestamp", "order_year", "order_year_month", "order_day_of_week", "order_hour", "delivery_days",
    "delivery_delay_days",
]


def store_order_sales(star):
    """The same star with its order totals written to the shared folder, so that the reports which
    start from them scan and shuffle the items once between them.
    """
    totals = order_sales(star, *ORDER_SALES_COLUMNS)
    path = new_shared_path(totals.sparkSession, "order-sales")
    totals.write.parquet(path)
    return replace(star, order_sales=totals.sparkSession.read.schema(totals.schema).parquet(path))


def order_sales(star, *columns: str) -> DataFrame:
    """One row per delivered order that has items: its item totals and the given order columns."""
    if star.order_sales is not None:
        return star.order_sales.select("order_id", "customer_id", *columns, "n_items", "revenue", "freight", "gmv")
    return delivered_orders(star, *columns).join(items_per_order(star.order_items), "order_id")


def scores_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.count("*").alias("n_reviews"),
        F.count("review_score").alias("n_scores"),
        F.sum("review_score").alias("score_sum"),
    )


def with_review_copies(orders: DataFrame, star, reviews: str = "fan_out") -> DataFrame:
    """Left join of the reviews at order grain.

    ``copies`` is how often a left join with the reviews repeats each row of the order. With
    ``reviews="per_order"`` an order's scores count once, as their mean, and nothing repeats.
    """
    joined = orders.join(scores_per_order(star.reviews), "order_id", "left")
    n_scores = F.coalesce("n_scores", F.lit(0))
    score_sum = F.coalesce("score_sum", F.lit(0))
    if reviews == "fan_out":
        copies = F.greatest(F.coalesce("n_reviews", F.lit(0)), F.lit(1))
    elif reviews == "per_order":
        copies = F.lit(1).cast("bigint")
        score_sum = F.when(n_scores > 0, score_sum / n_scores).otherwise(F.lit(0.0))
        n_scores = F.least(n_scores, F.lit(1))
    else:
        raise ValueError(f"reviews must be 'fan_out' or 'per_order', not {reviews!r}")
    return joined.withColumns({"copies": copies, "n_scores": n_scores, "score_sum": score_sum}).drop("n_reviews")


def repeated(total, *times):
    """A whole total counted ``times`` over."""
    value = wide(total)
    for n in times:
        value = (value * n.cast("decimal(12,0)")).cast("decimal(32,0)")
    return value


def per_customer(orders: DataFrame, star, *aggregates, columns: tuple[str, ...]) -> DataFrame:
    """Reduce order rows per customer id, then look the customer up.

    A customer with very many orders is a single row by the time of the join.
    """
    reduced = orders.groupBy("customer_id").agg(*aggregates)
    return reduced.join(star.customers.select("customer_id", *columns), "customer_id")


def order_states(star, orders: DataFrame) -> DataFrame:
    """Order rows with their customer's state (inner join), spreading customers with many orders."""
    states = star.customers.select("customer_id", "customer_state")
    return lookup_join(orders, states, "customer_id", "inner", ["order_id"], star.rows("customers"))


def category_sales(star, orders: DataFrame, how: str = "inner") -> DataFrame:
    """Items of the given orders at (order, category) grain, with the order columns.

    ``how="left"`` keeps items of unknown products. The join leaves rows partitioned by order, so the
    aggregation needs no shuffle of its own; an order with very many items is spread over tasks.
    """
    items = star.order_items.select("order_id", "order_item_id", "product_id", "price")
    names = star.products.select("product_id", F.col("product_category_name_english").alias("category"))
    named = lookup_join(items, names, "product_id", how, ["order_id", "order_item_id"], star.rows("products"))
    sold = lookup_join(named, orders, "order_id", "inner", ["product_id", "order_item_id"], star.rows("orders"), items)
    return sold.groupBy("category", *orders.columns).agg(
        F.count("*").alias("n_items"),
        F.sum(cents(F.col("price"))).alias("revenue"),
        F.sum("order_item_id").alias("item_numbers"),
    )


def distinct_products_and_sellers(star, items: DataFrame | None = None, orders: DataFrame | None = None) -> DataFrame:
    """One row: how many products and sellers the items of delivered orders name.

    ``items`` and ``orders`` narrow the choice. An order with very many items is spread over tasks.
    """
    items = (star.order_items if items is None else items).select("order_id", "product_id", "seller_id")
    kept = (delivered_orders(star) if orders is None else orders).select("order_id")
    sold = lookup_join(items, kept, "order_id", "inner", ["product_id", "seller_id"], star.rows("orders"), star.order_items)
    # Both kinds of id in one column: they are made distinct before the shuffle, and one plain count does for both.
    kinds, columns = sold.schema, {"product_id": "unique_products", "seller_id": "active_sellers"}
    same = kinds["product_id"].dataType == kinds["seller_id"].dataType
    ids = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), (F.col(c) if same else F.col(c).cast("string")).alias("id")) for c in columns]))
    once = sold.select(ids.alias("k")).select("k.*").where("id IS NOT NULL").distinct()
    return once.agg(*[F.count_if(F.col("kind") == c).alias(name) for c, name in columns.items()])
