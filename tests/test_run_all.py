"""Raw CSV files to reports, with text ids as in a real delivery."""

import json

import pytest

from oracles.base import statement
from tallymart import run_all
from tallymart.catalog import RFM
from tallymart.schemas import RAW_SCHEMAS
from tests.compare import differences, duck
import __spark_entry__ as spark_entry


@pytest.fixture(scope="module")
def output(spark, sf_dir, tmp_path_factory):
    data, out = tmp_path_factory.mktemp("data"), tmp_path_factory.mktemp("out")
    con = duck(sf_dir)
    for name, schema in RAW_SCHEMAS.items():
        columns = ", ".join(schema.fieldNames())
        con.execute(f"COPY ({statement(f'SELECT {columns} FROM raw_{name}')}) TO '{data}/{name}.csv' (HEADER)")
    run_all.run(spark, str(data), str(out), RFM)
    return str(out)


@pytest.mark.parametrize("name", [
    "q1_overview", "q2_monthly_trends", "q5_category_performance", "q6_payment_distribution", "q7_delivery_by_state",
    "q8_customer_segmentation", "q10_review_analysis", "q15_freight_analysis", "q16_yoy_growth", "q17_category_reviews",
])
def test_results_equal_those_on_typed_tables(spark, sf_dir, output, name):
    want = spark_entry.queries()[name](spark, sf_dir)
    got = spark.read.csv(f"{output}/results/{name}", header=True, schema=want.schema)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_wide_datasets_equal_those_on_typed_tables(spark, sf_dir, output):
    want = spark_entry.queries()["analytical_dataset"](spark, sf_dir)
    got = spark.read.parquet(f"{output}/analytical_dataset")
    got = got.selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in want.dtypes])
    assert differences(got, duck(sf_dir), spark_entry.oracle_sql()["analytical_dataset"]) == []


def test_every_job_left_a_result(spark, output):
    import os

    jobs = {"results": run_all.named_queries(None), "exploratory": run_all.exploratory_datasets(None)}
    for folder, names in jobs.items():
        assert sorted(os.listdir(f"{output}/{folder}")) == sorted(names)
    sections = {r["section"]: json.loads(r["json"]) for r in spark.read.json(f"{output}/dashboard").collect()}
    assert len(sections) == 10
    assert len(sections["monthly_trends"]["month"]) == len(sections["monthly_trends"]["revenue"]) > 0


def test_quality_report_of_the_files(spark, output):
    rows = spark.read.csv(f"{output}/data_quality_report", header=True).collect()
    found = {(r["table"], r["check"]): r["status"] for r in rows}
    assert found[("customers", "PRIMARY_KEY")] == "PASS" and found[("orders", "DUPLICATES")] == "PASS"
    assert found[("orders", "NULLS_order_approved_at")] == "INFO"
