"""The stored KPI cube against the KPIs from base rows, and distinct counts by bitmap."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.catalog import star_of
from tallymart.operators.distinct import bitmaps, counts, numbered, rolled_up
from tallymart.plans import dashboard, kpi_cube
from tallymart.plans.star import Star
from tests.tiny import rows


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    return star_of(spark, sf_dir)


@pytest.fixture(scope="module")
def cube(star, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("cube"))
    kpi_cube.build(star, folder)
    return kpi_cube.stored(star.orders.sparkSession, folder)


@pytest.mark.parametrize("chosen", [
    {}, {"year": 1997}, {"state": "NATION_3"}, {"category": "BRAND#4"}, {"year": 1997, "state": "NATION_3"}, {"year": 1998, "category": "BRAND#5"},
    {"state": "NATION_1", "category": "BRAND#4"}, {"year": 1900}, {"state": "nowhere"},
])
def test_cube_answers_as_the_base_rows_do(star, cube, chosen):
    assert kpi_cube.kpis(cube, **chosen).collect() == dashboard.kpis(star, **chosen).collect()


def test_cube_with_unknown_customers_and_products(spark, star, tmp_path):
    """Orders of customers that are not there, items of products that are not there, and a product without a category."""
    raw = dict(star.raw)
    raw["customers"] = raw["customers"].where(F.col("customer_id") % 5 != 0)
    raw["products"] = raw["products"].where(F.col("product_id") % 7 != 0)
    patchy = Star(raw)
    cube = kpi_cube.build(patchy, str(tmp_path / "cube"))
    for chosen in ({}, {"state": "NATION_3"}, {"category": "BRAND#4"}):
        assert kpi_cube.kpis(cube, **chosen).collect() == dashboard.kpis(patchy, **chosen).collect()


def test_cube_reads_no_base_table(cube):
    plan = kpi_cube.kpis(cube, year=1997, category="BRAND#4")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "orders.parquet" not in plan
    assert "EqualTo(category,BRAND#4)" in plan and "EqualTo(year,1997)" in plan


def test_bitmaps_count_unions_exactly(spark):
    rng = np.random.default_rng(6)
    data = [(str(rng.integers(0, 4)), int(rng.integers(0, 3)), f"id{rng.integers(0, 900)}") for _ in range(5000)] + [("0", 0, None)]
    df = spark.createDataFrame(data, "a string, b int, id string")
    known = numbered(df, "id")
    pairs = {r["id"]: r["number"] for r in known.collect()}
    assert sorted(pairs.values()) == list(range(1, len(pairs) + 1)) and set(pairs) == {d[2] for d in data} - {None}
    # Numbers far apart lie in several pieces.
    wide = known.withColumn("number", F.col("number") * 997)
    pieces = bitmaps(df.join(wide, "id", "left"), "number", ["a", "b"])
    for keys in ([], ["a"], ["b"], ["a", "b"]):
        want = {tuple(k): len({d[2] for d in group if d[2]}) for k, group in (
            (k, list(g)) for k, g in itertools.groupby(sorted(data, key=lambda d: [str(d["ab".index(c)]) for c in keys]), key=lambda d: [d["ab".index(c)] for c in keys]))}
        assert {tuple(r)[:-1]: r["n"] for r in counts(pieces, keys).collect()} == want
        assert {tuple(r)[:-1]: r["n"] for r in counts(rolled_up(pieces, keys), keys).collect()} == want


def test_no_rows_no_ids(spark):
    empty = spark.createDataFrame([], "id string")
    assert rows(numbered(empty, "id")) == []
