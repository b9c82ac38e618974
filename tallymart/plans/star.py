"""The star schema: cleaned tables behind one object, and the job that writes them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymart.plans import clean
from tallymart.schemas import STAR_TABLES


@dataclass
class Star:
    """Cleaned tables over ``raw`` ones. Everything stays lazy; unused columns and joins are pruned."""

    raw: Mapping[str, DataFrame]
    # Delivered order totals written once for several reports, see sales.store_order_sales.
    order_sales: DataFrame | None = None
    _rows: dict[str, int] = field(default_factory=dict)

    @cached_property
    def customers(self) -> DataFrame:
        return clean.clean_customers(self.raw["customers"])

    @cached_property
    def orders(self) -> DataFrame:
        return clean.clean_orders(self.raw["orders"])

    @cached_property
    def order_items(self) -> DataFrame:
        return clean.clean_order_items(self.raw["order_items"])

    @cached_property
    def payments(self) -> DataFrame:
        return clean.clean_payments(self.raw["payments"])

    @cached_property
    def products(self) -> DataFrame:
        """Products with their category names; measures as delivered (reports do not use them)."""
        return clean.translate_categories(self.raw["products"], self.raw["category_translation"])

    @cached_property
    def products_imputed(self) -> DataFrame:
        return clean.clean_products(self.raw["products"], self.raw["category_translation"])

    @cached_property
    def sellers(self) -> DataFrame:
        return clean.clean_sellers(self.raw["sellers"])

    @cached_property
    def reviews(self) -> DataFrame:
        return clean.clean_reviews(self.raw["reviews"])

    @cached_property
    def geolocation(self) -> DataFrame:
        return clean.clean_geolocation(self.raw["geolocation"])

    def rows(self, name: str) -> int:
        """Row count of a raw table, counted once: the size check in front of a broadcast."""
        if name not in self._rows:
            self._rows[name] = self.raw[name].count()
        return self._rows[name]

    def cleaned(self, name: str) -> DataFrame:
        return self.products_imputed if name == "products" else getattr(self, name)


@dataclass
class StoredStar:
    """The same tables read back from a written star schema."""

    spark: SparkSession
    folder: str
    order_sales: DataFrame | None = None
    _rows: dict[str, int] = field(default_factory=dict)

    def _table(name: str):
        return cached_property(lambda self: self.spark.read.parquet(f"{self.folder}/{name}"))

    customers, orders, order_items = _table("dim_customers"), _table("dim_orders"), _table("fact_order_items")
    payments, products, sellers = _table("fact_payments"), _table("dim_products"), _table("dim_sellers")
    reviews, geolocation = _table("dim_reviews"), _table("ref_geolocation")
    # Stored products have their gaps filled.
    products_imputed = _table("dim_products")

    def rows(self, name: str) -> int:
        if name not in self._rows:
            self._rows[name] = getattr(self, name).count()
        return self._rows[name]


def star_table(star: Star, table: str) -> DataFrame:
    """The columns that both the star table and its cleaned source have.

    Empty review texts are stored as NULL, as they come back from a text file.
    """
    source, columns = STAR_TABLES[table]
    df = star.cleaned(source)
    common = [c for c in columns if c in df.columns]
    texts = {"review_comment_title", "review_comment_message"}
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in common])


def write_star(star: Star, folder: str, tables: list[str] | None = None,
               partition_by: Mapping[str, list[str]] | None = None) -> StoredStar:
    """Replace the star tables in ``folder``; ``partition_by`` names folder columns per table, e.g. the year."""
    for table in tables or STAR_TABLES:
        writer = star_table(star, table).write.mode("overwrite")
        writer.parquet(f"{folder}/{table}", partitionBy=list((partition_by or {}).get(table, [])) or None)
    return StoredStar(star.raw["orders"].sparkSession, folder)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, and the grand total."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts.rollup("table_name").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "row_count"
    )
