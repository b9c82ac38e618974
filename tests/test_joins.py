import pytest
from pyspark.sql import functions as F

from tallymart.operators import joins
from tallymart.operators.joins import hot_keys, lookup_join, sliced_join


@pytest.fixture(autouse=True)
def few_rows_are_hot(monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 2)


@pytest.fixture
def skewed(spark):
    """Key 7 holds a third of 3000 rows; some keys are missing on the right, some are NULL."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 50 == 1, None).otherwise(n % 100)
    return spark.range(3000).select(key.cast("bigint").alias("k"), n.alias("row"))


@pytest.fixture
def lookup(spark):
    return spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def same(a, b):
    def key(r):
        return repr(r)
    return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.select(*a.columns).collect()), key=key)


def test_hot_keys_finds_the_heavy_key(skewed):
    found = dict(hot_keys(skewed, "k", max_keys=20, slices=40))
    assert found[7] >= 13
    assert len(found) <= 20
    assert hot_keys(skewed.limit(0), "k") == []


def test_a_key_with_few_rows_is_not_hot(skewed, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 1100)
    assert hot_keys(skewed, "k", max_keys=20, slices=40) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sliced_join_equals_plain_join(skewed, lookup, how):
    hot = hot_keys(skewed, "k", max_keys=20, slices=40)
    assert same(sliced_join(skewed, lookup, "k", how, ["row"], hot), skewed.join(lookup, "k", how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sliced_join_with_several_matches_per_key(skewed, lookup, how):
    twice = lookup.unionAll(lookup.withColumn("v", F.col("v") + 1))
    hot = hot_keys(skewed, "k", max_keys=20, slices=40)
    assert same(sliced_join(skewed, twice, "k", how, ["row"], hot), skewed.join(twice, "k", how))


def test_slices_spread_the_hot_key(spark, skewed, lookup):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = hot_keys(skewed, "k", max_keys=20, slices=40)
        joined = sliced_join(skewed, lookup, "k", "inner", ["row"], hot)
        most = joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert most < 1000  # the hot key alone has 1000 rows


def test_lookup_join_takes_every_way(skewed, lookup):
    plain = skewed.join(lookup, "k", "left")
    assert "BroadcastHashJoin" in plan(lookup_join(skewed, lookup, "k", "left"))
    assert same(lookup_join(skewed, lookup, "k", "left"), plain)
    assert same(lookup_join(skewed, lookup, "k", "left", broadcast_rows=10, max_keys=20), plain)
    even = skewed.where("k IS NOT NULL").dropDuplicates(["k"])
    assert same(lookup_join(even, lookup, "k", broadcast_rows=10, max_keys=20), even.join(lookup, "k"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_key_are_spread(spark):
    left = spark.range(20_000).selectExpr("CASE WHEN id % 10 = 0 THEN id % 7 END AS k", "id")
    right = spark.range(7).selectExpr("id AS k", "id * 2 AS v")
    for hot in ([], [(0, 4)]):
        joined = sliced_join(left, right, "k", "left", ["id"], hot)
        assert sorted(tuple(r) for r in joined.select("id", "v").where("v IS NOT NULL").collect()) == [
            (i, i % 7 * 2) for i in range(0, 20_000, 10)]
        assert joined.count() == 20_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in sliced_join(left, right, "k", "left", ["id"], []).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_the_lookup_side_of_even_keys_is_not_shuffled_again(spark, skewed, lookup, monkeypatch):
    """Without hot or many missing keys a left join is by the key alone, so a side that is dealt out by it stays where it is."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(joins, "HOT_ROWS", 2000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        summed = lookup.groupBy("k").agg(F.sum("v").alias("v"))
        joined = lookup_join(skewed, summed, "k", "left")
        assert "_slice" not in plan(joined) and plan(joined).count("Exchange hashpartitioning(k") == 2
        assert same(joined, skewed.join(lookup, "k", "left"))
        missing = skewed.withColumn("k", F.when(F.col("row") % 10 > 0, F.col("k")))
        monkeypatch.setattr(joins, "HOT_ROWS", 300)
        spread = lookup_join(missing, summed, "k", "left", ["row"])
        assert "_slice" in plan(spread) and same(spread, missing.join(lookup, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_side_of_short_rows_may_have_more_of_them(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 100)
    texts = spark.range(300).selectExpr("id AS k", "IF(id % 2 = 0, NULL, repeat('x', 100)) AS t")
    assert joins.size_of(texts) == 300 * 32 + 150 * 100 and joins.size_of(texts.limit(0)) == 0
    assert joins.is_small(texts, 300) and not joins.is_small(texts, 501)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 24_000)
    assert not joins.is_small(texts, 300) and joins.is_small(texts, 100)
