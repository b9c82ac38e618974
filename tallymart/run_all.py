"""From raw CSV files to every report: a plain function that calls the jobs."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymart.plans import cubes, dashboard, eda, insights, integrate, quality, reports, segments
from tallymart.plans.publish import save_results
from tallymart.plans.segments import RfmConfig
from tallymart.plans.star import Star, StoredStar, table_counts, write_star
from tallymart.schemas import STAR_TABLES
from tallymart.sources.files import load_tables, load_texts, write_csv, write_json, write_parquet

log = logging.getLogger(__name__)

Jobs = dict[str, Callable[[], DataFrame]]


def named_queries(star, rfm: RfmConfig = RfmConfig()) -> Jobs:
    return {
        "q1_overview": lambda: reports.overview(star),
        "q2_monthly_trends": lambda: reports.monthly_trends(star),
        "q3_yearly_summary": lambda: reports.yearly_summary(star),
        "q4_top_customers": lambda: reports.top_customers(star),
        "q5_category_performance": lambda: reports.category_performance(star),
        "q6_payment_distribution": lambda: reports.payment_distribution(star),
        "q7_delivery_by_state": lambda: reports.delivery_by_state(star),
        "q8_customer_segmentation": lambda: segments.customer_segmentation(star, rfm),
        "q9_seller_performance": lambda: reports.seller_performance(star),
        "q10_review_analysis": lambda: reports.review_analysis(star),
        "q11_regional_performance": lambda: reports.regional_performance(star),
        "q12_dow_patterns": lambda: reports.weekday_patterns(star),
        "q13_hourly_patterns": lambda: reports.hourly_patterns(star),
        "q14_cancellation_analysis": lambda: reports.status_breakdown(star),
        "q15_freight_analysis": lambda: reports.freight_analysis(star),
        "q16_yoy_growth": lambda: reports.yoy_growth(star),
        "q17_category_reviews": lambda: reports.category_reviews(star),
        "findings_digest": lambda: insights.findings_digest(star, rfm),
        "segment_revenue_share": lambda: insights.segment_revenue_share(star, rfm),
        "top_n_concentration": lambda: insights.top_n_concentration(star),
        "positive_review_rate": lambda: insights.positive_review_rate(star),
    }


def exploratory_datasets(star) -> Jobs:
    names = [
        "monthly", "category_revenue", "payment_mix", "review_counts", "delivery_box_by_score", "region_top15",
        "correlation", "purchase_frequency", "spend_histogram", "weekday_revenue", "hourly", "delivery_histogram",
        "ontime_by_state", "price_outliers", "price_histogram", "price_freight_sample", "seller_stats",
        "seller_pareto", "pareto_cutoff", "seller_states", "order_status", "installments", "category_scores",
        "freight",
    ]
    return {name: (lambda job=getattr(eda, name): job(star)) for name in names}


def run(spark: SparkSession, data: str, output: str, rfm: RfmConfig = RfmConfig(), at_once: int = 4) -> StoredStar:
    """Check, clean and store the tables of ``data``, then write every dataset under ``output``, reports ``at_once`` at a time."""
    raw = load_tables(spark, data)
    write_csv(quality.quality_report(load_texts(spark, data)), f"{output}/data_quality_report")
    star = write_star(Star(raw), f"{output}/star", partition_by={"dim_orders": ["order_year"]})
    counts = table_counts({t: getattr(star, source) for t, (source, _) in STAR_TABLES.items()})
    write_csv(counts, f"{output}/table_counts")
    write_parquet(integrate.analytical_dataset(star), f"{output}/analytical_dataset")
    write_parquet(integrate.item_level_dataset(star), f"{output}/item_level_dataset")
    save_results(named_queries(star, rfm), f"{output}/results", at_once)
    save_results(exploratory_datasets(star), f"{output}/exploratory", at_once)
    write_json(dashboard.dashboard_document(star, rfm), f"{output}/dashboard")
    write_json(cubes.state_category_cube(star), f"{output}/cubes/state_category")
    write_json(cubes.sales_cube(star), f"{output}/cubes/sales")
    write_json(cubes.year_month_cube(star), f"{output}/cubes/year_month")
    return star
