"""Customer segments by recency, frequency and spend."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.functions.exprs import (
    cents, days_between, first_match, fixed_point, from_fixed_point, money, ratio, rounded, wide,
)
from tallymart.plans.sales import order_sales, per_customer

# Segment rules in order, as inclusive ranges of the scores for recency, frequency and spend.
SEGMENT_RULES = [
    ("Champions", (4, 5), (3, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (2, 5), (3, 5)),
    ("Recent Customers", (4, 5), (1, 2), (1, 5)),
    ("Potential Loyalists", (3, 5), (1, 5), (3, 5)),
    ("At Risk", (1, 2), (2, 5), (1, 5)),
    ("Lost", (1, 2), (1, 1), (1, 2)),
]
OTHER_SEGMENT = "Others"

# Segment labels of the report and the short labels of the dashboard.
SHORT_LABELS = {"Loyal Customers": "Loyal", "Recent Customers": "Recent", "Potential Loyalists": "Potential"}


@dataclass(frozen=True)
class RfmConfig:
    """Reference date and score limits, best score first."""

    reference_date: str = "2018-10-01"
    recency_days: tuple = (30, 90, 180, 365)
    frequency: tuple = (5, 3, 2)
    monetary: tuple = (500, 200, 100, 50)


def customer_rfm(star, config: RfmConfig) -> DataFrame:
    """One row per person: fractional days since the last order, orders, spend."""
    last = per_customer(
        order_sales(star, "order_purchase_timestamp"), star,
        F.max("order_purchase_timestamp").alias("last_order"),
        F.count("*").alias("orders"),
        F.sum(wide(F.col("revenue"))).alias("revenue"),
        columns=("customer_unique_id",),
    )
    until = F.lit(config.reference_date).cast("timestamp_ntz")
    return last.groupBy("customer_unique_id").agg(
        days_between(F.max("last_order"), until).alias("recency_days"),
        F.sum("orders").alias("frequency"),
        money(F.sum("revenue")).alias("monetary"),
    )


def rfm_scores(star, config: RfmConfig = RfmConfig()) -> DataFrame:
    recency, frequency, monetary = F.col("recency_days"), F.col("frequency"), F.col("monetary")
    return customer_rfm(star, config).withColumns({
        "r_score": first_match([(recency <= d, 5 - i) for i, d in enumerate(config.recency_days)], 1),
        # There is no frequency score of 2.
        "f_score": first_match([(frequency >= n, 5 - i) for i, n in enumerate(config.frequency)], 1),
        "m_score": first_match([(monetary >= m, 5 - i) for i, m in enumerate(config.monetary)], 1),
    })


def segment_of(r: Column, f: Column, m: Column) -> Column:
    """The first rule whose three ranges hold names the segment."""
    rules = [
        (r.between(*r_range) & f.between(*f_range) & m.between(*m_range), name)
        for name, r_range, f_range, m_range in SEGMENT_RULES
    ]
    return first_match(rules, OTHER_SEGMENT)


def customer_segmentation(star, config: RfmConfig = RfmConfig()) -> DataFrame:
    n, spent = F.count("*"), F.sum(wide(cents(F.col("monetary"))))
    return (
        rfm_scores(star, config)
        .withColumn("segment", segment_of(F.col("r_score"), F.col("f_score"), F.col("m_score")))
        .groupBy("segment")
        .agg(
            n.alias("customer_count"),
            rounded(ratio(from_fixed_point(F.sum(fixed_point(F.col("recency_days")))), n), 0).alias("avg_recency"),
            rounded(ratio(F.sum("frequency"), n), 1).alias("avg_frequency"),
            rounded(ratio(money(spent), n), 2).alias("avg_monetary"),
            money(spent).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "segment")
    )


def short_segments(star, config: RfmConfig = RfmConfig()) -> DataFrame:
    """The same segments under the dashboard's labels."""
    short = F.col("segment")
    for label, name in SHORT_LABELS.items():
        short = F.when(F.col("segment") == label, F.lit(name)).otherwise(short)
    return customer_segmentation(star, config).select(
        short.alias("segment"), F.col("customer_count").alias("count"), F.col("total_revenue").alias("revenue")
    )
