"""A stored cube that answers the KPIs of any year, state and category without the base tables.

Its cells are year, state and category of delivered items. Sums add up over cells as they are. People, products and sellers
would be counted twice, so a cell has them as bitmaps of numbered ids, which are united where cells are added up. Orders add up over years and
states; since one may hold several categories, there are cells over all categories as well.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallymart.functions.exprs import cents, exact_micros, mean_days, money, ratio, rounded
from tallymart.operators.distinct import bitmaps, counts, numbered, rolled_up
from tallymart.operators.joins import lookup_join
from tallymart.operators.selection import with_row_of
from tallymart.plans.sales import delivered_orders, repeated, with_review_copies
from tallymart.session import checkpointed, new_shared_path

CELL = ["year", "state", "category"]
SUMS = ["orders", "revenue", "freight", "scores", "scored", "days", "timed"]
MEASURES = ("level string, year int, state string, category string, orders bigint, revenue decimal(38,0), freight decimal(38,0), "
            "scores decimal(38,6), scored decimal(38,0), days decimal(38,0), timed decimal(38,0)")
SETS = "kind string, known boolean, year int, state string, category string, bucket bigint, bits binary"


@dataclass
class KpiCube:
    """``measures``: sums by cell, and by cell over all categories (``level``); ``sets``: bitmaps of customers, products and sellers by cell.

    ``known`` is false where an order's customer is not: such orders count for products and sellers only, as in the KPIs from base rows.
    """

    measures: DataFrame
    sets: DataFrame


def sold_items(star, folder: str) -> tuple[DataFrame, DataFrame]:
    """Delivered items with numbered product and seller, and their orders with year, state and numbered person (null: unknown customer)."""
    people = numbered(star.customers, "customer_unique_id", f"{folder}/person_numbers")
    customers = star.customers.select("customer_id", "customer_unique_id", F.col("customer_state").alias("state"), F.lit(True).alias("known"))
    customers = lookup_join(customers, people.withColumnRenamed("number", "person"), "customer_unique_id", "left").drop("customer_unique_id")
    orders = delivered_orders(star, F.col("order_year").alias("year"), "delivery_days")
    orders = lookup_join(orders, customers, "customer_id", "left", ["order_id"], star.rows("customers")).drop("customer_id")
    items = star.order_items.select("order_id", "product_id", "seller_id", "price", "freight_value")
    products = numbered(items, "product_id", f"{folder}/product_numbers").withColumnRenamed("number", "product")
    sellers = numbered(items, "seller_id", f"{folder}/seller_numbers").withColumnRenamed("number", "seller")
    names = star.products.select("product_id", F.col("product_category_name_english").alias("category"))
    products = lookup_join(products, names, "product_id", "left")
    named = lookup_join(items, products, "product_id", "left", ["order_id", "seller_id"])
    named = lookup_join(named, sellers, "seller_id", "left", ["order_id", "product_id"]).drop("product_id", "seller_id")
    return named, orders.withColumn("known", F.coalesce("known", F.lit(False)))


def build(star, folder: str | None = None) -> KpiCube:
    """Writes the cube of a star to ``folder`` (a new one in the shared folder if not given) and returns it as stored."""
    spark = star.orders.sparkSession
    folder = folder or new_shared_path(spark, "kpi-cube")
    items, orders = sold_items(star, folder)
    orders = checkpointed(with_review_copies(orders, star))
    sold = items.groupBy("order_id", "category").agg(
        F.count("*").alias("n_items"), F.sum(cents(F.col("price"))).alias("revenue"), F.sum(cents(F.col("freight_value"))).alias("freight"))
    rows = sold.join(orders.where("known"), "order_id")

    def sums(rows: DataFrame, level: str, cell: list[str]) -> DataFrame:
        copies, days = F.col("copies"), F.col("delivery_days")
        n = repeated(F.col("n_items"), copies)
        made = rows.groupBy(*cell).agg(
            F.count("*").alias("orders"),
            F.sum(repeated(F.col("revenue"), copies)).alias("revenue"),
            F.sum(repeated(F.col("freight"), copies)).alias("freight"),
            F.sum(F.col("score_sum") * F.col("n_items")).alias("scores"),
            F.sum(F.col("n_scores") * F.col("n_items")).alias("scored"),
            F.sum((exact_micros(days) * n).cast("decimal(38,0)")).alias("days"),
            F.sum(F.when(days.isNotNull(), n)).alias("timed"))
        named = made.withColumn("level", F.lit(level))
        for c in CELL:
            named = named if c in cell else named.withColumn(c, F.lit(None).cast("string"))
        return named.selectExpr(*[f"CAST({f.split()[0]} AS {f.split()[1]}) AS {f.split()[0]}" for f in MEASURES.split(", ")])

    whole = rows.groupBy("order_id", "year", "state", "copies", "score_sum", "n_scores", "delivery_days").agg(
        *[F.sum(c).alias(c) for c in ("n_items", "revenue", "freight")])
    sums(rows, "category", CELL).union(sums(whole, "all", CELL[:2])).write.mode("overwrite").parquet(f"{folder}/measures")

    named = lookup_join(items.select("order_id", "category", "product", "seller"), orders.select("order_id", "known", "year", "state", "person"),
                        "order_id", "inner", ["product", "seller"], star.rows("orders"), star.order_items)
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("id")) for k, c in (
        ("customer", "person"), ("product", "product"), ("seller", "seller"))]))
    ids = named.select("known", *CELL, kinds.alias("k")).select("k.kind", "known", *CELL, "k.id")
    bitmaps(ids, "id", ["kind", "known", *CELL]).select(*[F.col(f.split()[0]) for f in SETS.split(", ")]).write.mode("overwrite").parquet(f"{folder}/sets")
    return stored(spark, folder)


def stored(spark: SparkSession, folder: str) -> KpiCube:
    return KpiCube(spark.read.schema(MEASURES).parquet(f"{folder}/measures"), spark.read.schema(SETS).parquet(f"{folder}/sets"))


def _chosen(rows: DataFrame, **wanted) -> DataFrame:
    for name, value in wanted.items():
        if value is not None:
            rows = rows.where(F.col(name) == value)
    return rows


def kpis(cube: KpiCube, year: int | None = None, state: str | None = None, category: str | None = None) -> DataFrame:
    """The nine headline numbers of ``dashboard.kpis`` from the cube alone."""
    cells = _chosen(cube.measures.where(F.col("level") == ("all" if category is None else "category")), year=year, state=state, category=category)
    sets = _chosen(cube.sets, year=year, state=state, category=category)
    if state is not None:
        sets = sets.where("known")
    else:
        sets = sets.where((F.col("kind") != "customer") | F.col("known"))
    return _headline(cells, counts(sets, ["kind"]))


def _headline(cells: DataFrame, named: DataFrame) -> DataFrame:
    def ids(kind: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("bigint")

    revenue, orders = money(F.sum("revenue")), F.sum("orders")
    totals = cells.agg(
        revenue.alias("total_revenue"),
        F.coalesce(orders, F.lit(0)).alias("total_orders"),
        rounded(ratio(revenue, orders), 2).alias("avg_order_value"),
        rounded(ratio(F.sum("scores"), F.sum("scored")), 2).alias("avg_review_score"),
        money(F.sum("freight")).alias("total_freight"),
        rounded(mean_days(F.sum("days"), F.sum("timed")), 1).alias("avg_delivery_days"))
    sets = named.agg(F.struct(ids("customer").alias("unique_customers"), ids("product").alias("unique_products"), ids("seller").alias("active_sellers")))
    return with_row_of(totals, sets, "_sets").select(
        "total_revenue", "total_orders", "_sets.unique_customers", "avg_order_value", "avg_review_score", "total_freight", "avg_delivery_days",
        "_sets.unique_products", "_sets.active_sellers")


def distinct_by(cube: KpiCube, *keys: str) -> DataFrame:
    """Customers, products and sellers of every combination of some of year, state and category, known customers only."""
    pieces = rolled_up(cube.sets.where("known"), ["kind", *keys])
    n = {kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bits"))), F.lit(0)).cast("bigint") for kind in ("customer", "product", "seller")}
    return pieces.groupBy(*keys).agg(n["customer"].alias("customers"), n["product"].alias("products"), n["seller"].alias("sellers"))
