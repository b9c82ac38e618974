"""Datasets behind the dashboard, and the one document that holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymart.functions.exprs import (
    cents, exact_micros, mean_days, money, percent, ratio, rounded, weekday_number, wide,
)
from tallymart.operators.joins import lookup_join
from tallymart.operators.selection import top_k, trim_edges, with_row_of, with_share
from tallymart.plans.reports import customer_totals, total
from tallymart.plans.sales import (
    category_sales, delivered_orders, distinct_products_and_sellers, items_per_order, order_sales, order_states,
    per_customer, repeated, store_order_sales, with_review_copies,
)
from tallymart.plans.segments import RfmConfig, short_segments


def kpis(star, year: int | None = None, state: str | None = None, category: str | None = None,
         reviews: str = "fan_out") -> DataFrame:
    """The nine headline numbers over delivered items, for all sales or for a year, state and category.

    Distinct counts of a selection cannot be added up from a cube, so they come from the base rows.
    """
    items = star.order_items
    if category is not None:
        chosen = star.products.where(F.col("product_category_name_english") == category).select("product_id")
        items = lookup_join(items, chosen, "product_id", "inner", ["order_id"], star.rows("products"))
    orders = delivered_orders(star, "order_year", "delivery_days")
    if year is not None:
        orders = orders.where(F.col("order_year") == year)

    if year is None and category is None:
        totals = order_sales(star, "delivery_days")
    else:
        totals = orders.join(items_per_order(items), "order_id")
    sold = with_review_copies(totals, star, reviews)
    days, n_rows = F.col("delivery_days"), F.col("n_items") * F.col("copies")
    customers = per_customer(
        sold, star,
        F.count("*").alias("orders"),
        F.sum(repeated(F.col("revenue"), F.col("copies"))).alias("revenue"),
        F.sum(repeated(F.col("freight"), F.col("copies"))).alias("freight"),
        F.sum(F.col("score_sum") * F.col("n_items")).alias("scores"),
        F.sum(F.col("n_scores") * F.col("n_items")).alias("scored"),
        F.sum(exact_micros(days) * n_rows).alias("days"),
        F.sum(F.when(days.isNotNull(), n_rows)).alias("timed"),
        columns=("customer_unique_id", "customer_state"),
    )
    if state is not None:
        customers = customers.where(F.col("customer_state") == state)
        orders = order_states(star, orders).where(F.col("customer_state") == state)
    revenue, n_orders = money(F.sum("revenue")), F.sum("orders")
    named = distinct_products_and_sellers(star, items, orders).select(F.struct("unique_products", "active_sellers"))
    totals = customers.agg(
        revenue.alias("total_revenue"),
        F.coalesce(n_orders, F.lit(0)).alias("total_orders"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        rounded(ratio(revenue, n_orders), 2).alias("avg_order_value"),
        rounded(ratio(F.sum("scores"), F.sum("scored")), 2).alias("avg_review_score"),
        money(F.sum("freight")).alias("total_freight"),
        rounded(mean_days(F.sum("days"), F.sum("timed")), 1).alias("avg_delivery_days"),
    )
    return with_row_of(totals, named, "_named").select(*totals.columns, "_named.*")


def month_totals(star) -> DataFrame:
    return order_sales(star, "order_year_month").groupBy(F.col("order_year_month").alias("month")).agg(
        money(total("revenue")).alias("revenue"),
        F.count("*").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
    )


def monthly_trends(star) -> DataFrame:
    """Months without the first and last one, which may be incomplete."""
    return trim_edges(month_totals(star), "month", only_if_more_than=2).orderBy("month")


def monthly_trends_for_year(star, year: str) -> DataFrame:
    return monthly_trends(star).where(F.col("month").startswith(year))


def category_performance(star, k: int = 15) -> DataFrame:
    by_category = (
        category_sales(star, delivered_orders(star).select("order_id")).groupBy("category")
        .agg(money(total("revenue")).alias("revenue"), F.count("*").alias("orders"))
    )
    return top_k(by_category, k, F.desc("revenue"), F.asc("category"))


def regional_data(star) -> DataFrame:
    return (
        customer_totals(star).groupBy(F.col("customer_state").alias("state"))
        .agg(
            money(total("revenue")).alias("revenue"),
            F.sum("orders").alias("orders"),
            F.count_distinct("customer_unique_id").alias("customers"),
        )
        .orderBy(F.desc("revenue"), "state")
    )


def payment_distribution(star) -> DataFrame:
    return (
        star.payments.groupBy(F.col("payment_type").alias("type"))
        .agg(F.count("*").alias("count"), money(F.sum(wide(cents(F.col("payment_value"))))).alias("value"))
        .orderBy(F.desc("value"), "type")
    )


def payment_share(star) -> DataFrame:
    by_type = payment_distribution(star)
    all_value = by_type.agg(money(F.sum(wide(cents(F.col("value"))))))
    return with_share(by_type.drop("count"), "share_pct", F.col("value"), all_value, 1)


def review_distribution(star) -> DataFrame:
    """All reviews by score."""
    return (
        star.reviews.groupBy(F.col("review_score").alias("score")).agg(F.count("*").alias("count")).orderBy("score")
    )


def review_share(star) -> DataFrame:
    by_score = review_distribution(star)
    return with_share(by_score, "share_pct", F.col("count"), by_score.agg(F.sum("count")), 1)


def delivery_metrics(star) -> DataFrame:
    delay, days = F.col("delivery_delay_days"), F.col("delivery_days")
    timed = delivered_orders(star, "delivery_days", "delivery_delay_days").where(delay.isNotNull())
    return timed.agg(
        F.count_if(delay <= 0).alias("on_time"),
        F.count_if(delay > 0).alias("late"),
        F.count("*").alias("total"),
        rounded(mean_days(F.sum(exact_micros(days)), F.count(days)), 1).alias("avg_delivery_days"),
        rounded(mean_days(F.sum(exact_micros(delay)), F.count(delay)), 1).alias("avg_delay"),
        F.coalesce(rounded(percent(F.count_if(delay <= 0), F.count("*")), 1), F.lit(0.0)).alias("on_time_rate"),
    )


def weekday_orders(star) -> DataFrame:
    return (
        delivered_orders(star, "order_day_of_week").groupBy(F.col("order_day_of_week").alias("day"))
        .agg(F.count("*").alias("orders")).orderBy(weekday_number(F.col("day")))
    )


def weekday_orders_weekend(star) -> DataFrame:
    return weekday_orders(star).withColumn("is_weekend", F.col("day").isin("Saturday", "Sunday").cast("int"))


def yearly_summary(star) -> DataFrame:
    return (
        order_sales(star, "order_year").groupBy(F.col("order_year").alias("year"))
        .agg(money(total("revenue")).alias("revenue"), F.count("*").alias("orders")).orderBy("year")
    )


def kpi_cards(star) -> DataFrame:
    """The numbers on the six cards."""
    delivery = delivery_metrics(star).select(F.struct("on_time_rate", "on_time", "late"))
    n_reviews = star.reviews.agg(F.count("*")).scalar()
    gmv = money(cents(F.col("total_revenue")) + cents(F.col("total_freight")))
    return with_row_of(kpis(star), delivery, "_delivery").select(
        "total_revenue", gmv.alias("total_gmv"), "total_orders", "unique_products", "active_sellers",
        "unique_customers", "avg_order_value", "avg_delivery_days", "avg_review_score",
        n_reviews.alias("total_reviews"),
        "_delivery.*",
    )


def dashboard_document(star, rfm: RfmConfig = RfmConfig()) -> DataFrame:
    """Ten sections, each one JSON object; tables are column-oriented, in report order.

    Every section is a report with a bounded number of rows (months, states, scores), which makes
    gathering its rows into one object safe. Amounts are written with two decimals.
    """
    star = store_order_sales(star)
    parts = [
        _section("kpis", kpis(star), None),
        _section("monthly_trends", monthly_trends(star), [F.col("month")]),
        _section("category_performance", category_performance(star), [-F.col("revenue"), F.col("category")]),
        _section("regional_data", regional_data(star), [-F.col("revenue"), F.col("state")]),
        _section("payment_distribution", payment_distribution(star), [-F.col("value"), F.col("type")]),
        _section("customer_segments", short_segments(star, rfm), [-F.col("revenue"), F.col("segment")]),
        _section("review_distribution", review_distribution(star), [F.col("score")]),
        _section("delivery_metrics", delivery_metrics(star), None),
        _section("dow_patterns", weekday_orders(star), [weekday_number(F.col("day"))]),
        _section("yearly_summary", yearly_summary(star), [F.col("year")]),
    ]
    document = parts[0]
    for part in parts[1:]:
        document = document.unionByName(part)
    return document


def _section(name: str, df: DataFrame, order: list | None) -> DataFrame:
    """``order=None`` writes the single row as an object, otherwise each column becomes a list."""
    written = {
        f.name: F.col(f.name).cast("decimal(38,2)") if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema.fields
    }
    if order is None:
        content = df.select(F.to_json(F.struct(*[c.alias(n) for n, c in written.items()]), {"ignoreNullFields": "false"}))
    else:
        row = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], *[c.alias(n) for n, c in written.items()])
        rows = df.agg(F.sort_array(F.collect_list(row)).alias("rows"))
        content = rows.select(F.to_json(F.struct(*[F.col(f"rows.{n}").alias(n) for n in written])))
    return content.toDF("json").select(F.lit(name).alias("section"), "json")
