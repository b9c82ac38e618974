"""Every job under its name: ``QUERIES[name](spark, folder)`` returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymart.functions.exprs import decimals_as_doubles
from tallymart.plans import clean, cubes, dashboard, eda, insights, integrate, kpi_cube, publish, quality, reports, segments
from tallymart.plans.sales import delivered_orders
from tallymart.plans.segments import RfmConfig
from tallymart.plans.star import Star
from tallymart.schemas import FOREIGN_KEYS, PRIMARY_KEYS, PRODUCT_MEASURES, STAR_TABLES
from tallymart.sources import roles

# Score limits that fit the supplied tables; the defaults of RfmConfig are for the original data.
RFM = RfmConfig(
    reference_date="2001-09-01",
    recency_days=(90, 180, 365, 730),
    frequency=(12, 9, 7),
    monetary=(2_000_000, 1_500_000, 1_000_000, 500_000),
)

Query = Callable[[SparkSession, str], DataFrame]


def star_of(spark: SparkSession, sf_dir: str) -> Star:
    return Star(roles.raw_tables(spark, sf_dir))


def hourly_star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(roles.hourly_tables(spark, sf_dir))


def on(source: Callable, job: Callable, *args, **kwargs) -> Query:
    return lambda spark, sf_dir: decimals_as_doubles(job(source(spark, sf_dir), *args, **kwargs))


def on_star(job: Callable, *args, **kwargs) -> Query:
    return on(star_of, job, *args, **kwargs)


# The declared keys of the star tables on top of the four that every load checks.
ALL_KEYS = PRIMARY_KEYS | {
    "order_items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"],
    "reviews": ["review_id", "order_id"],
}
# The selection that filtered_kpis and the yearly trend use on the supplied tables.
SELECTED = {"year": 1997, "state": "NATION_3", "category": "BRAND#4"}


def raw_checks(check: Callable, *args) -> Query:
    return on(roles.raw_tables, check, *args)


def report_summary(raw) -> DataFrame:
    return quality.status_counts(quality.quality_report(raw, primary_keys=ALL_KEYS))


def report_failures(raw) -> DataFrame:
    return quality.failures(quality.quality_report(raw, primary_keys=ALL_KEYS))


def time_features(star: Star) -> DataFrame:
    return star.orders.select(
        "order_id", "order_purchase_timestamp", "order_year", "order_month", "order_year_month", "order_day_of_week",
        "order_hour")


def delivery_features(star: Star) -> DataFrame:
    return star.orders.select("order_id", "order_status", "delivery_days", "delivery_delay_days")


def filter_delivered(star: Star) -> DataFrame:
    return delivered_orders(star, "order_status", "order_purchase_timestamp")


def impute_median(star: Star) -> DataFrame:
    raw = star.raw["products"].select("product_id", *PRODUCT_MEASURES)
    return clean.impute_medians(raw, PRODUCT_MEASURES)


def domain_values(star: Star) -> DataFrame:
    """The values that occur in the categorical columns."""
    columns = [
        (star.payments, "payment_type"), (star.orders, "order_status"),
        (star.products, "product_category_name_english"), (star.customers, "customer_state"),
    ]
    return quality.union([
        df.select(F.lit(c).alias("domain"), F.col(c).alias("value")).distinct() for df, c in columns])


def cleaned(name: str) -> Query:
    return on_star(lambda star: star.cleaned(name))


def clean_orders_text(star: Star) -> DataFrame:
    return clean.clean_orders(roles.orders_as_text(star.raw))


def from_cube(job: Callable, *args, **kwargs) -> Query:
    """A job on the KPI cube, which is built and stored first."""
    return on_star(lambda star: job(kpi_cube.build(star), *args, **kwargs))


QUERIES: dict[str, Query] = {
    "q1_overview": on_star(reports.overview),
    "q2_monthly_trends": on_star(reports.monthly_trends),
    "q3_yearly_summary": on_star(reports.yearly_summary),
    "q4_top_customers": on_star(reports.top_customers),
    "q5_category_performance": on_star(reports.category_performance),
    "q6_payment_distribution": on_star(reports.payment_distribution),
    "q7_delivery_by_state": on_star(reports.delivery_by_state),
    "q8_customer_segmentation": on_star(segments.customer_segmentation, RFM),
    "rfm_scores": on_star(segments.rfm_scores, RFM),
    "q9_seller_performance": on_star(reports.seller_performance),
    "q10_review_analysis": on_star(reports.review_analysis),
    "q11_regional_performance": on_star(reports.regional_performance),
    "q12_dow_patterns": on_star(reports.weekday_patterns),
    "q13_hourly_patterns": on(hourly_star, reports.hourly_patterns),
    "q14_cancellation_analysis": on_star(reports.status_breakdown),
    "q15_freight_analysis": on_star(reports.freight_analysis),
    "q16_yoy_growth": on_star(reports.yoy_growth),
    "q17_category_reviews": on_star(reports.category_reviews),
    "findings_digest": on_star(insights.findings_digest, RFM),
    # Filters, features, domains
    "filter_delivered": on_star(filter_delivered),
    "time_features": on(hourly_star, time_features),
    "delivery_features": on_star(delivery_features),
    "impute_median": on_star(impute_median),
    "domain_values": on_star(domain_values),
    # Cleaning
    "clean_customers": cleaned("customers"),
    "clean_orders": on_star(clean_orders_text),
    "clean_order_items": cleaned("order_items"),
    "clean_payments": cleaned("payments"),
    "clean_products": cleaned("products"),
    "clean_sellers": cleaned("sellers"),
    "clean_reviews": cleaned("reviews"),
    "geo_by_zip": cleaned("geolocation"),
    # Integration
    "payments_per_order": on_star(lambda star: integrate.payments_per_order(star.payments)),
    "items_per_order": on_star(lambda star: integrate.items_per_order(star.order_items)),
    "reviews_per_order": on_star(lambda star: integrate.reviews_per_order(star.reviews)),
    "first_review_per_order": on_star(lambda star: integrate.first_review_per_order(star.reviews)),
    "analytical_dataset": on_star(integrate.analytical_dataset),
    "item_level_dataset": on_star(integrate.item_level_dataset),
    "join_completeness": on_star(integrate.join_completeness),
    # Data quality
    "dq_schema": raw_checks(quality.check_schemas),
    "dq_primary_keys": raw_checks(quality.check_primary_keys, ALL_KEYS),
    "dq_foreign_keys": raw_checks(quality.check_foreign_keys, FOREIGN_KEYS),
    "dq_duplicates": raw_checks(quality.check_duplicates),
    "dq_nulls": raw_checks(quality.check_nulls),
    "data_quality_report": on(roles.raw_tables, quality.quality_report, primary_keys=ALL_KEYS),
    "dq_summary": raw_checks(report_summary),
    "dq_failures": raw_checks(report_failures),
    # Dashboard
    "kpis": on_star(dashboard.kpis),
    "kpis_per_order_reviews": on_star(dashboard.kpis, reviews="per_order"),
    "filtered_kpis": on_star(dashboard.kpis, **SELECTED),
    "cube_kpis": from_cube(kpi_cube.kpis),
    "cube_filtered_kpis": from_cube(kpi_cube.kpis, **SELECTED),
    "cube_distinct_by_year": from_cube(kpi_cube.distinct_by, "year"),
    "cube_distinct_by_state_category": from_cube(kpi_cube.distinct_by, "state", "category"),
    "kpi_cards": on_star(dashboard.kpi_cards),
    "monthly_trends": on_star(dashboard.monthly_trends),
    "monthly_trends_for_year": on_star(dashboard.monthly_trends_for_year, str(SELECTED["year"])),
    "category_performance": on_star(dashboard.category_performance),
    "regional_data": on_star(dashboard.regional_data),
    "payment_distribution": on_star(dashboard.payment_distribution),
    "payment_share": on_star(dashboard.payment_share),
    "customer_segments": on_star(segments.short_segments, RFM),
    "review_distribution": on_star(dashboard.review_distribution),
    "review_share": on_star(dashboard.review_share),
    "delivery_metrics": on_star(dashboard.delivery_metrics),
    "dow_patterns": on_star(dashboard.weekday_orders),
    "dow_patterns_weekend": on_star(dashboard.weekday_orders_weekend),
    "yearly_summary": on_star(dashboard.yearly_summary),
    "dashboard_document": on_star(dashboard.dashboard_document, RFM),
    # Cubes
    "cube_state_category": on_star(cubes.state_category_cube),
    "sales_cube": on_star(cubes.sales_cube),
    "cube_year_month": on_star(cubes.year_month_cube),
    # Exploratory datasets
    "eda_monthly": on_star(eda.monthly),
    "eda_category_revenue": on_star(eda.category_revenue),
    "eda_payment_mix": on_star(eda.payment_mix),
    "eda_review_counts": on_star(eda.review_counts),
    "delivery_box_by_score": on_star(eda.delivery_box_by_score),
    "eda_region_top15": on_star(eda.region_top15),
    "eda_correlation": on_star(eda.correlation),
    "purchase_frequency": on_star(eda.purchase_frequency),
    "histogram_ltv": on_star(eda.spend_histogram),
    "dow_reindexed": on_star(eda.weekday_revenue),
    "eda_hourly": on(hourly_star, eda.hourly),
    "histogram_delivery": on_star(eda.delivery_histogram),
    "ontime_by_state": on_star(eda.ontime_by_state),
    "price_outliers": on_star(eda.price_outliers),
    "histogram_price": on_star(eda.price_histogram),
    "price_freight_sample": on_star(eda.price_freight_sample),
    "seller_stats": on_star(eda.seller_stats),
    "seller_pareto": on_star(eda.seller_pareto),
    "pareto_cutoff": on_star(eda.pareto_cutoff),
    "seller_state_top10": on_star(eda.seller_states),
    "eda_order_status": on_star(eda.order_status),
    "eda_installments": on_star(eda.installments),
    "eda_category_scores": on_star(eda.category_scores),
    "eda_freight": on_star(eda.freight),
    # Follow-on numbers
    "segment_revenue_share": on_star(insights.segment_revenue_share, RFM),
    "top_n_concentration": on_star(insights.top_n_concentration),
    "positive_review_rate": on_star(insights.positive_review_rate),
    # Sinks and stages
    "table_counts": on_star(publish.star_counts),
    "stage_reload": on_star(publish.stage_reload),
    "csv_roundtrip": on_star(publish.csv_roundtrip),
    "csv_by_name": on_star(publish.csv_by_name),
    "sales_cube_json": on_star(publish.cube_json),
    **{f"star_load_{table}": on_star(publish.star_load, table) for table in STAR_TABLES},
}
