"""Cleaning jobs: one function per raw table, DataFrame in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.functions.exprs import days_between, fixed_point, from_fixed_point, ratio, stripped
from tallymart.operators.joins import lookup_join
from tallymart.operators.quantiles import approximate_quantiles, exact_quantiles
from tallymart.operators.selection import with_row_of
from tallymart.schemas import ORDER_TIMESTAMPS, PRODUCT_MEASURES

# Fixed values of the cleaning rules.
UNKNOWN_CATEGORY = "unknown"
UNDEFINED_PAYMENT, OTHER_PAYMENT = "not_defined", "other"

VOLUME_SIDES = ["product_length_cm", "product_height_cm", "product_width_cm"]


def lowered(name: str):
    return F.lower(stripped(F.col(name)))


def uppered(name: str):
    return F.upper(stripped(F.col(name)))


def as_timestamp(name: str):
    """Unreadable text becomes NULL."""
    return F.col(name).try_cast("timestamp_ntz")


def clean_customers(df: DataFrame) -> DataFrame:
    return df.withColumns({"customer_city": lowered("customer_city"), "customer_state": uppered("customer_state")})


def clean_sellers(df: DataFrame) -> DataFrame:
    return df.withColumns({"seller_city": lowered("seller_city"), "seller_state": uppered("seller_state")})


def clean_orders(df: DataFrame) -> DataFrame:
    """Parse times, fill the approval time of delivered orders, derive time and delivery columns.

    The fill looks at the status as delivered by the source; the status is normalised last.
    """
    bought, got = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    approved = F.col("order_approved_at")
    unapproved = approved.isNull() & (F.col("order_status") == "delivered")
    return (
        df.withColumns({c: as_timestamp(c) for c in ORDER_TIMESTAMPS})
        .withColumns({
            "order_approved_at": F.when(unapproved, bought).otherwise(approved),
            "order_year": F.year(bought),
            "order_month": F.month(bought),
            "order_year_month": F.date_format(bought, "yyyy-MM"),
            "order_day_of_week": F.date_format(bought, "EEEE"),
            "order_hour": F.hour(bought),
            "delivery_days": days_between(bought, got),
            "delivery_delay_days": days_between(F.col("order_estimated_delivery_date"), got),
        })
        .withColumn("order_status", lowered("order_status"))
    )


def item_value() -> Column:
    return F.col("price") + F.col("freight_value")


def clean_order_items(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "shipping_limit_date": as_timestamp("shipping_limit_date"),
        "total_item_value": item_value(),
    })


def clean_payments(df: DataFrame) -> DataFrame:
    kind = lowered("payment_type")
    return df.withColumn("payment_type", F.when(kind == UNDEFINED_PAYMENT, F.lit(OTHER_PAYMENT)).otherwise(kind))


def impute_medians(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Fill NULLs of each numeric column with that column's median, which is ``exact`` or met to within 0.1 % in one pass.

    The columns are stacked to (name, value) rows, so one distributed job finds all medians and the
    result has one row per column.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    stacked = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    medians = (
        (exact_quantiles if exact else approximate_quantiles)(stacked.where("value IS NOT NULL"), "value", {"median": 0.5}, ["column"])
        .groupBy()
        .agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in columns])
    )
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_medians.{c}")) for c in columns}
    return with_row_of(df, medians.select(F.struct(*columns)), "_medians").withColumns(filled).drop("_medians")


def translate_categories(df: DataFrame, translation: DataFrame) -> DataFrame:
    """Name missing categories, add the English name; a category without translation keeps its own."""
    named = df.withColumn("product_category_name", F.coalesce("product_category_name", F.lit(UNKNOWN_CATEGORY)))
    joined = lookup_join(named, translation, "product_category_name", "left")
    english = F.coalesce("product_category_name_english", "product_category_name")
    return joined.withColumn("product_category_name_english", english)


def add_volume(df: DataFrame) -> DataFrame:
    if not set(VOLUME_SIDES) <= set(df.columns):
        return df
    length, height, width = (F.col(c) for c in VOLUME_SIDES)
    return df.withColumn("product_volume_cm3", length * height * width)


def clean_products(df: DataFrame, translation: DataFrame) -> DataFrame:
    return add_volume(translate_categories(impute_medians(df, PRODUCT_MEASURES), translation))


def clean_reviews(df: DataFrame) -> DataFrame:
    """Missing texts become '', dates are parsed; a comment of blanks still counts as a comment."""
    return df.withColumns({
        "review_comment_title": F.coalesce("review_comment_title", F.lit("")),
        "review_comment_message": F.coalesce("review_comment_message", F.lit("")),
        "review_creation_date": as_timestamp("review_creation_date"),
        "review_answer_timestamp": as_timestamp("review_answer_timestamp"),
        "has_comment": (F.length(F.coalesce("review_comment_message", F.lit(""))) > 0).cast("int"),
    })


def clean_geolocation(df: DataFrame) -> DataFrame:
    """One row per zip prefix: mean coordinates and the first city and state that are not missing.

    Rows have no order of their own, so "first" means first by (city, state).
    """
    means = {c: (F.sum(fixed_point(F.col(c))), F.count(c)) for c in ("geolocation_lat", "geolocation_lng")}
    place = F.struct(F.isnull("geolocation_city"), "geolocation_city", "geolocation_state")
    return (
        df.withColumns({"geolocation_city": lowered("geolocation_city"), "geolocation_state": uppered("geolocation_state")})
        .groupBy("geolocation_zip_code_prefix")
        .agg(
            *[ratio(from_fixed_point(total), n).alias(c) for c, (total, n) in means.items()],
            F.min("geolocation_city").alias("geolocation_city"),
            F.min_by("geolocation_state", F.when(F.col("geolocation_state").isNotNull(), place)).alias("geolocation_state"),
        )
        .where(F.col("geolocation_zip_code_prefix").isNotNull())
    )
