"""Follow-on numbers of the written report, and the digest of key findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallymart.functions.exprs import cents, money, percent, rounded, wide
from tallymart.operators.selection import top_k, with_row_of, with_share
from tallymart.plans import reports
from tallymart.plans.dashboard import category_performance, regional_data
from tallymart.plans.sales import store_order_sales
from tallymart.plans.segments import RfmConfig, customer_segmentation


def segment_revenue_share(star, rfm: RfmConfig = RfmConfig(), recovery: float = 0.10) -> DataFrame:
    """Each segment's share of revenue, and what winning back part of it would bring."""
    segments = customer_segmentation(star, rfm)
    everything = segments.agg(money(F.sum(wide(cents(F.col("total_revenue"))))))
    return with_share(segments, "revenue_share_pct", F.col("total_revenue"), everything, 1).select(
        "segment", "total_revenue", "revenue_share_pct",
        rounded(F.col("total_revenue") * recovery, 2).alias("recovery_value"),
    )


def top_n_concentration(star, categories: int = 5, states: int = 3) -> DataFrame:
    """Share of all revenue held by the largest categories and the largest states."""
    everything = reports.all_items_revenue(star)

    def held(df: DataFrame, by: str, n: int, key: str) -> DataFrame:
        largest = top_k(df, n, F.desc("revenue"), F.asc(key))
        total = largest.agg(money(F.sum(wide(cents(F.col("revenue"))))).alias("held"))
        return with_share(total, "revenue_share_pct", F.col("held"), everything, 1).select(
            F.lit(by).alias("dimension"), F.lit(n).alias("top_n"), "revenue_share_pct")

    return held(category_performance(star, categories), "category", categories, "category").unionByName(
        held(regional_data(star), "state", states, "state"))


def positive_review_rate(star) -> DataFrame:
    """Reviews of delivered orders with 4 or 5 stars as a percentage of all reviews."""
    n_reviews = star.reviews.agg(F.count("*").alias("all_reviews"))
    scores = reports.review_analysis(star)
    positive = F.coalesce(F.sum(F.when(F.col("review_score") >= 4, F.col("review_count"))), F.lit(0))
    return with_row_of(scores.agg(positive.alias("positive_reviews")), n_reviews, "all_reviews").withColumn(
        "positive_pct", rounded(percent(F.col("positive_reviews"), F.col("all_reviews")), 1))


def findings_digest(star, rfm: RfmConfig = RfmConfig()) -> DataFrame:
    """Key findings as rows (section, rank, label, metric, value)."""
    star = store_order_sales(star)
    one = F.lit("all").alias("label")
    parts = [
        _findings("overview", reports.overview(star).withColumn("label", one), "label", [F.asc("label")], [
            "total_orders", "total_customers", "total_revenue", "total_gmv", "avg_item_price", "unique_products",
            "active_sellers"]),
        _findings("payments", reports.payment_distribution(star), "payment_type",
                  [F.desc("total_value"), F.asc("payment_type")], ["pct_of_transactions", "total_value"]),
        _findings("categories", reports.category_performance(star, 5), "category",
                  [F.desc("total_revenue"), F.asc("category")], ["total_revenue", "revenue_share_pct"]),
        _findings("segments", customer_segmentation(star, rfm), "segment",
                  [F.desc("total_revenue"), F.asc("segment")], ["customer_count", "total_revenue"]),
        _findings("reviews", reports.review_analysis(star), "review_score", [F.asc("review_score")],
                  ["review_count", "pct", "avg_delivery_days"]),
    ]
    digest = parts[0]
    for part in parts[1:]:
        digest = digest.unionByName(part)
    return digest


def _findings(section: str, report: DataFrame, label: str, order: list, metrics: list[str]) -> DataFrame:
    """``report`` has a bounded number of rows (types, segments, scores), so one window can rank them."""
    ranked = report.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"), F.col(label).cast("string").alias("label"),
        *[F.col(m).cast("double").alias(m) for m in metrics])
    return ranked.unpivot(["rank", "label"], metrics, "metric", "value").select(
        F.lit(section).alias("section"), "rank", "label", "metric", "value")
