import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.functions.exprs import first_match, ratio, rounded, stripped
from tallymart.operators.distributions import box_summary, histogram, outlier_fence
from tallymart.operators.moments import co_moments, correlation_matrix, correlations, merged
from tallymart.operators.quantiles import approximate_quantiles, exact_quantiles, sketch, value_counts, weighted
from tallymart.operators.running import running_total
from tallymart.operators.selection import top_k, trim_edges
from tests.tiny import rows

RNG = np.random.default_rng(7)


def frame(spark, values, name="v"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0, 3.0, 3.0], [1.0, 2.0, 4.0, 8.0, None], list(RNG.normal(size=501)),
    list(np.round(RNG.pareto(1.2, size=800) * 100, 2)),
])
def test_quantiles_match_numpy(spark, values):
    got = exact_quantiles(frame(spark, values), "v", {"a": 0.25, "b": 0.5, "c": 0.75, "d": 1.0, "e": 0.0}, bins=16).first()
    known = [v for v in values if v is not None]
    assert got["n"] == len(known)
    np.testing.assert_allclose(got[:5], np.quantile(known, [0.25, 0.5, 0.75, 1.0, 0.0]), rtol=1e-12)


def test_quantiles_with_groups_and_weights(spark):
    data = [("a", 1.0, 3), ("a", 5.0, 1), ("a", 9.0, 2), ("b", 2.0, 1), ("b", 4.0, 1)]
    df = spark.createDataFrame(data, "g string, v double, w bigint")
    got = {r["g"]: (r["m"], r["n"]) for r in exact_quantiles(df, "v", {"m": 0.5}, ["g"], "w").collect()}
    assert got == {"a": (np.median([1, 1, 1, 5, 9, 9]), 6), "b": (3.0, 2)}


@pytest.mark.parametrize("values", [[4.0, 4.0], list(RNG.integers(0, 1000, size=400)), [0.0, 1.0, 50.0, 100.0, 100.0]])
def test_histogram_matches_numpy(spark, values):
    got = histogram(frame(spark, values), "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=50)
    assert [r["count"] for r in got] == counts.tolist()
    np.testing.assert_allclose([r["bin_start"] for r in got], edges[:-1], atol=1e-9)
    np.testing.assert_allclose([r["bin_end"] for r in got], edges[1:], atol=1e-9)


def test_box_summary_clips_whiskers_to_the_data(spark):
    df = spark.createDataFrame([(1, v) for v in [1.0, 2.0, 3.0, 4.0, 100.0]], "k int, v double")
    r = box_summary(df, "k", "v").first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["n"]) == (2.0, 3.0, 4.0, 1.0, 4.0, 5)


def test_outlier_fence(spark):
    r = outlier_fence(value_counts(frame(spark, [1, 2, 3, 4, 100]), "v")).first()
    assert (r["q1"], r["q3"], r["iqr"], r["upper_bound"], r["outlier_count"]) == (2.0, 4.0, 2.0, 7.0, 1)


def test_running_total_over_many_ranges(spark):
    df = spark.range(500).select("id", (F.col("id") * 7919 % 101).alias("v"))
    got = running_total(df, "v", F.desc("v"), F.asc("id")).orderBy("position").collect()
    want = sorted(((r["id"], r["v"]) for r in df.collect()), key=lambda r: (-r[1], r[0]))
    assert [(r["id"], r["v"]) for r in got] == want
    assert [r["position"] for r in got] == list(range(1, 501))
    assert [int(r["running"]) for r in got] == np.cumsum([v for _, v in want]).tolist()
    assert {int(r["total"]) for r in got} == {sum(v for _, v in want)}


@pytest.mark.parametrize("months, guarded, unguarded", [
    (["a"], ["a"], []), (["a", "b"], ["a", "b"], []), (["a", "b", "c"], ["b"], ["b"]),
])
def test_trim_edges_of_short_series(spark, months, guarded, unguarded):
    df = spark.createDataFrame([(m,) for m in months], "m string")
    assert [r[0] for r in rows(trim_edges(df, "m", only_if_more_than=2).orderBy("m"))] == guarded
    assert [r[0] for r in rows(trim_edges(df, "m").orderBy("m"))] == unguarded


def test_top_k_is_a_merge_of_small_tops(spark):
    df = top_k(spark.range(1000), 3, F.desc("id"))
    assert [r[0] for r in rows(df)] == [999, 998, 997]
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_correlation_matrix(spark):
    x, y = RNG.normal(size=100), RNG.normal(size=100)
    sums = spark.createDataFrame(
        [(100.0, *map(float, (x.sum(), y.sum(), x @ x, x @ y, y @ y)))],
        "n double, s_x double, s_y double, s_x_x double, s_x_y double, s_y_y double")
    got = {(r["x"], r["y"]): r["correlation"] for r in correlation_matrix(sums, ["x", "y"]).collect()}
    assert got[("x", "x")] == 1.0 and got[("x", "y")] == got[("y", "x")]
    assert got[("x", "y")] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)


def test_rounding_is_half_away_from_zero(spark):
    df = frame(spark, [0.125, -0.125, 2.5, -2.5, 1.005, None])
    assert [r[0] for r in rows(df.select(rounded(F.col("v"), 2)))][:2] == [0.13, -0.13]
    assert [r[0] for r in rows(df.select(rounded(F.col("v"), 0)))] == [0.0, -0.0, 3.0, -3.0, 1.0, None]


def test_ratio_by_zero_is_null(spark):
    assert rows(spark.range(1).select(ratio(F.lit(1), F.lit(0)))) == [(None,)]


def test_first_match_is_ordered(spark):
    rule = first_match([(F.col("id") > 1, "big"), (F.col("id") > 0, "some")], "none")
    assert [r[0] for r in rows(spark.range(3).select(rule))] == ["none", "some", "big"]


def test_stripped_takes_tabs_and_line_breaks(spark):
    df = spark.createDataFrame([("\t a b \r\n ",)], "t string")
    assert rows(df.select(stripped(F.col("t")))) == [("a b",)]


def test_histogram_edges_as_in_numpy(spark):
    for values in ([0, .14, .29, .56, .58, 1], (RNG.integers(0, 10_000, size=1000) / 100).tolist()):
        got = histogram(frame(spark, values), "v").orderBy("bin").collect()
        assert [r["count"] for r in got] == np.histogram(values, bins=50)[0].tolist()


def test_quantiles_of_a_heavy_tail(spark):
    values = [float(v) for v in range(4000)] + [1e12]
    got = exact_quantiles(frame(spark, values), "v", {"q1": 0.25, "m": 0.5, "q3": 0.75}).first()
    assert (got["q1"], got["m"], got["q3"]) == tuple(np.quantile(values, [.25, .5, .75]))
    from tallymart.operators.running import running_total
    counts = value_counts(frame(spark, values), "v")
    sizes = running_total(counts, "n", "value").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 2 * len(values) / len(sizes)


def test_large_amounts_are_neither_cut_nor_lost(spark):
    from tallymart.functions.exprs import cents, fixed_point, from_fixed_point, rounded

    df = spark.createDataFrame([(1.5e7,), (1e9,), (-2.5,)], "v double")
    assert df.agg(from_fixed_point(F.sum(fixed_point(F.col("v"))))).first()[0] == 1.5e7 + 1e9 - 2.5
    assert df.select(rounded(F.lit(1e19), 2)).first()[0] == 1e19
    with pytest.raises(Exception, match="out of range"):
        df.select(cents(F.lit(1e18))).collect()


@pytest.mark.parametrize("values", [
    [-5.5, -1e-300, -0.0, 0.0, 1e-300, 2.5, 1e300], list(RNG.normal(size=301)), [1.0 + k * 2.0 ** -52 for k in range(50)],
    [float(v) for v in range(4000)] + [1e12], [7.25] * 500 + [1.0], list(np.round(RNG.lognormal(3, 4, size=3000), 2)),
])
def test_brackets_narrow_down_to_the_value(spark, values):
    """Tiny steps, both signs, heavy tails and many ties: exact also when a bracket is halved many times."""
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}
    for bins in (2, None):
        got = exact_quantiles(frame(spark, values), "v", probs, bins=bins).first()
        np.testing.assert_allclose(got[:5], np.quantile(values, list(probs.values())), rtol=1e-15)


def test_quantiles_of_infinite_values(spark):
    got = exact_quantiles(frame(spark, [float("-inf"), 1.0, 2.0, float("inf"), float("inf")]), "v", {"low": 0.0, "m": 0.5, "q3": 0.75}).first()
    assert (got["low"], got["m"]) == (float("-inf"), 2.0)


def test_quantiles_by_group_against_numpy(spark):
    data = [(str(RNG.integers(0, 5)), float(np.round(RNG.exponential(50), 2)), int(RNG.integers(1, 4))) for _ in range(2000)] + [(None, 1.0, 1), ("x", None, 1)]
    df = spark.createDataFrame(data, "g string, v double, w bigint")
    got = {r["g"]: (r["q"], r["m"], r["n"]) for r in exact_quantiles(df, "v", {"q": 0.25, "m": 0.5}, ["g"], "w").collect()}
    near = {r["g"]: r["m"] for r in approximate_quantiles(df, "v", {"m": 0.5}, ["g"], "w").collect()}
    assert set(got) == {d[0] for d in data} - {None, "x"}
    for g, (q, m, n) in got.items():
        own = np.repeat([d[1] for d in data if d[0] == g], [d[2] for d in data if d[0] == g])
        assert n == len(own)
        np.testing.assert_allclose((q, m), np.quantile(own, [0.25, 0.5]), rtol=1e-15)
        assert near[g] == pytest.approx(m, rel=2e-3)


def test_sketches_of_parts_add_up(spark):
    values = list(RNG.lognormal(size=400))
    whole = sketch(weighted(frame(spark, values), "v"))
    parts = sketch(weighted(frame(spark, values[:100]), "v")).union(sketch(weighted(frame(spark, values[100:]), "v")))
    again = parts.groupBy("bin").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, whole.collect()))


def test_quantile_plans_neither_sort_nor_shuffle_values(spark):
    df = frame(spark, list(RNG.normal(size=100)))
    text = sketch(weighted(df, "v"))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text and "hashpartitioning(_groupingexpression" in text and "hashpartitioning(value" not in text


def test_co_moments_of_parts_with_large_means(spark):
    """Mean 1e9 and spread 1, where sums of squares would cancel."""
    x = 1e9 + RNG.normal(size=900)
    y = 1e9 + 0.7 * (x - 1e9) + 0.7 * RNG.normal(size=900)
    df = spark.createDataFrame([(k % 40, float(a), float(b)) for k, (a, b) in enumerate(zip(x, y))] + [(1, None, 2.0)], "k int, x double, y double")
    want = np.corrcoef(x - 1e9, y - 1e9)[0, 1]
    for parts in (co_moments(df, ["x", "y"], ["k"]), co_moments(df, ["x", "y"])):
        got = {(r["x"], r["y"]): r["correlation"] for r in correlations(merged(parts, ["x", "y"]), ["x", "y"]).collect()}
        assert got["x", "y"] == got["y", "x"] == pytest.approx(want, abs=2e-6) and got["x", "x"] == 1.0
    constant = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "x double, y double")
    assert {r["x"]: r["correlation"] for r in correlations(merged(co_moments(constant, ["x", "y"]), ["x", "y"]), ["x", "y"]).where("x = y").collect()} == {"x": None, "y": 1.0}
