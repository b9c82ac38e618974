"""Packed columns come back as they were, null, odd and extreme values too."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymart.operators.packed import DAY, SECOND, WORD, Field, decode, encode, measure, pack, places, unpack

SCHEMA = "l bigint, i int, whole double, money double, d timestamp_ntz, s timestamp_ntz, m timestamp_ntz, wide bigint, odd double, t string, none bigint"


@pytest.fixture
def table(spark):
    at = datetime(1996, 9, 13)
    return spark.createDataFrame([
        (-7, 3, 25.0, 0.29, at, at.replace(hour=23, second=59), at.replace(microsecond=1), -2**63, 1 / 3, "a", None),
        (2**40, None, -3.0, -1234567.89, datetime(1960, 2, 29), datetime(1969, 12, 31, 23, 59, 59), datetime(1969, 12, 31, 23, 59, 59, 999999), 2**63 - 1, -0.0, "", None),
        (None, -2, None, None, None, None, None, None, None, None, None),
        (0, 0, 0.0, 1.1, datetime(2400, 1, 1), datetime(1600, 1, 1, 1), datetime(9000, 1, 1, 23, 59, 59, 999999), 0, float("nan"), "a", None),
    ], SCHEMA)


def texts(df, names):
    """Values as text: -0.0 and 0.0 differ there, NaN equals NaN."""
    return sorted(map(tuple, df.select([F.col(c).cast("string") for c in names]).collect()), key=repr)


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_what_is_packed_comes_back(spark, table, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        fields = measure(table)
        assert {f.name: f.unit for f in fields} == {"l": 1, "i": 1, "whole": 1, "money": 100, "d": DAY, "s": SECOND, "m": 1, "none": 1}
        small = pack(encode(table, fields), fields)
        assert {"odd", "wide", "t"} < set(small.columns) and not {f.name for f in fields} & set(small.columns)
        again = decode(unpack(small, fields), fields)
        assert dict(again.dtypes) == dict(table.dtypes)
        assert texts(again, table.columns) == texts(table, table.columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_an_empty_table_and_one_without_numbers(spark, table):
    nothing = table.limit(0)
    fields = measure(nothing)
    assert decode(unpack(pack(encode(nothing, fields), fields), fields), fields).count() == 0
    assert measure(table.select("t")) == [] and unpack(pack(encode(table, []), []), []).columns == table.columns


def test_a_column_stays_when_a_single_value_does_not_fit(spark):
    for odd in (0.005, -0.0, 1e300, float("inf"), float("nan")):
        df = spark.range(100).select(F.when(F.col("id") == 50, F.lit(odd)).otherwise(F.col("id") / 100).alias("x"))
        assert measure(df) == [], odd


def test_words_do_not_overlap(table):
    taken = {}
    for field, word, right in places(measure(table)):
        bits = set(range(right, right + field.bits))
        assert max(bits) < WORD and not bits & taken.setdefault(word, set())
        taken[word] |= bits


def test_a_value_that_was_not_measured_is_an_error(spark, table):
    fields = measure(table.select("money", "i"))
    for changed in ({"i": F.lit(4)}, {"i": F.lit(-3)}, {"money": F.lit(1.11)}):
        with pytest.raises(Exception, match="has changed"):
            encode(table.select("money", "i").withColumns(changed), fields).collect()
    assert Field("i", table.schema["i"].dataType, 1, -2, 3) in fields
