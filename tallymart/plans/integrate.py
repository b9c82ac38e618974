"""Order-grain summaries and the two wide datasets built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymart.functions.exprs import cents, money, ratio
from tallymart.operators import joins
from tallymart.operators.joins import lookup_join
from tallymart.operators.packed import decode, encode, measure, pack, unpack
from tallymart.plans import clean

# Columns that are 0, not NULL, for an order without items or payments.
ZERO_FILLED = [
    "total_items", "total_price", "total_freight", "total_order_value", "total_payment_value", "num_unique_products",
    "num_unique_sellers",
]
# Order columns of the item-level dataset.
ITEM_ORDER_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_year", "order_month",
    "order_year_month", "order_day_of_week", "delivery_days", "delivery_delay_days",
]


def payments_per_order(payments: DataFrame) -> DataFrame:
    """The primary type is that of the first payment with a type; ``num_payment_methods`` is the last sequence number."""
    kind = F.col("payment_type")
    place = F.when(kind.isNotNull(), F.struct("payment_sequential", "payment_type"))
    return payments.groupBy("order_id").agg(
        money(F.coalesce(F.sum(cents(F.col("payment_value"))), F.lit(0))).alias("total_payment_value"),
        F.max("payment_installments").alias("payment_installments_max"),
        F.min_by(kind, place).alias("payment_type_primary"),
        F.max("payment_sequential").alias("num_payment_methods"),
    )


def items_per_order(items: DataFrame) -> DataFrame:
    """``total_items`` is the highest item number, as delivered by the source."""
    price, freight = F.col("price"), F.col("freight_value")
    # Two distinct counts in one aggregation would triple the items. Items are first reduced to one row per product of an
    # order, and sellers, whose number is small there, are counted from their own reduction.
    products = items.groupBy("order_id", "product_id").agg(
        F.max("order_item_id").alias("last_item"), F.sum(cents(price)).alias("p"), F.sum(cents(freight)).alias("f"),
        F.count(price).alias("n"))
    sellers = items.select("order_id", "seller_id").distinct().groupBy("order_id").agg(F.count("seller_id").alias("num_unique_sellers"))
    return (
        products.groupBy("order_id")
        .agg(
            F.max("last_item").alias("total_items"),
            F.coalesce(F.sum("p"), F.lit(0)).alias("price_cents"),
            F.coalesce(F.sum("f"), F.lit(0)).alias("freight_cents"),
            F.sum("n").alias("n_prices"),
            F.count("product_id").alias("num_unique_products"),
        )
        .join(sellers.withColumnRenamed("order_id", "_order"), F.col("order_id").eqNullSafe(F.col("_order")))
        .select(
            "order_id", "total_items",
            money(F.col("price_cents")).alias("total_price"),
            money(F.col("freight_cents")).alias("total_freight"),
            ratio(money(F.col("price_cents")), F.col("n_prices")).alias("avg_item_price"),
            "num_unique_products", "num_unique_sellers",
            money(F.col("price_cents") + F.col("freight_cents")).alias("total_order_value"),
        )
    )


def review_order():
    """Reviews of an order by creation date, undated ones last, then by review id."""
    return F.struct(F.isnull("review_creation_date"), "review_creation_date", "review_id")


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """The first score of an order, and whether any of its reviews has a comment."""
    scored = F.when(F.col("review_score").isNotNull(), review_order())
    return reviews.groupBy("order_id").agg(
        F.min_by("review_score", scored).alias("review_score"), F.max("has_comment").alias("has_review_comment")
    )


def first_review_per_order(reviews: DataFrame) -> DataFrame:
    first = F.min_by(F.struct("review_id", "review_score", "has_comment"), review_order())
    return reviews.groupBy("order_id").agg(first.alias("first")).select("order_id", "first.*")


def join_order_parts(star) -> DataFrame:
    """Orders with their item, payment, review and customer columns; NULL where a part is missing.

    The order-grain joins share one partitioning by order id. Customers come last, where customers
    with very many orders are spread.
    """
    by_order = (
        star.orders.join(items_per_order(star.order_items), "order_id", "left")
        .join(payments_per_order(star.payments), "order_id", "left")
        .join(reviews_per_order(star.reviews), "order_id", "left")
    )
    return lookup_join(by_order, star.customers, "customer_id", "left", ["order_id"], star.rows("customers"))


def analytical_dataset(star) -> DataFrame:
    """One row per order with everything known about it."""
    return join_order_parts(star).fillna(0, subset=ZERO_FILLED)


def item_level_dataset(star) -> DataFrame:
    """One row per item with its product, seller and order columns.

    Every shuffle carries the items with all they have gathered, and there is one for each side that is too large for a broadcast. So broadcast sides
    and columns made of others come last, before them the orders, which lie by order id already, and what is carried is packed.
    """
    items, products, sellers = star.order_items, star.products_imputed, star.sellers
    columns = [*items.columns, *ITEM_ORDER_COLUMNS, *products.columns, *sellers.columns]
    later = ["product_volume_cm3"] if set(clean.VOLUME_SIDES) <= set(products.columns) else []
    sides = {
        "sellers": (sellers, "seller_id"),
        "products": (products.drop(*later), "product_id"),
        "orders": (star.orders.select(*ITEM_ORDER_COLUMNS), "order_id"),
    }
    small = {name: star.rows(name) <= joins.BROADCAST_ROWS for name in sides}
    small["sellers"] = joins.is_small(sellers, star.rows("sellers"))
    large = [name for name in sides if not small[name]]
    df = items.drop("total_item_value")
    fields, coded = measure(df) if large else [], []
    for name in large:
        side, key = sides[name]
        new = [f for f in fields if f.name != key and f not in coded]
        df = decode(encode(df, new), [f for f in coded if f.name == key])
        coded = [f for f in coded if f.name != key] + new
        df = unpack(lookup_join(pack(df, coded), side, key, "left", None, star.rows(name), keys_from=items, broadcast_rows=0), coded)
        fields += measure(side.drop(key)) if name != large[-1] else []
    df = decode(df, coded)
    for name in (n for n in sides if small[n]):
        df = df.join(F.broadcast(sides[name][0]), sides[name][1], "left")
    df = clean.add_volume(df.withColumn("total_item_value", clean.item_value()))
    return df.select(*dict.fromkeys(["seller_id", "product_id", "order_id", *columns]))


def join_completeness(star) -> DataFrame:
    """Orders, and how many of them find no customer, items, payments or review score."""
    gaps = {
        "customers": "customer_unique_id", "order_items": "total_price", "payments": "total_payment_value",
        "reviews": "review_score",
    }
    counted = join_order_parts(star).agg(
        F.count("*").alias("order_rows"), *[F.count_if(F.isnull(c)).alias(name) for name, c in gaps.items()]
    )
    return counted.unpivot(["order_rows"], list(gaps), "joined_table", "unmatched")
