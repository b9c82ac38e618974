"""Quantiles from a mergeable sketch, made exact by counting inside its brackets.

The sketch counts values in bins of equal relative width (logarithms of values, as in DDSketch), so partial sketches of any parts of the
data add up, and its number of bins depends on the range of the values and not on how many there are. It tells in which bin
every wanted rank lies. Only values in those bins are looked at again: they are counted in finer, equal bins between the
least and greatest value there, until a bin holds a single value. Data in steps, such as money, need two passes. No pass sorts, shuffles
or stores the values themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallymart.operators.joins import BROADCAST_ROWS
from tallymart.operators.selection import with_row_of
from tallymart.session import checkpointed, settled

# Bins for a factor of e: a bin is 0.1 % wide.
BINS = 1_000
# Natural logarithms of doubles lie within +-LOG_RANGE.
LOG_RANGE = 750
# Parts into which a bracket is divided by each further pass.
PARTS = 65_536


def value_counts(df: DataFrame, value: str, keys: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """How often each value occurs: the keys, ``value`` (double) and ``n``, checkpointed. ``weight`` says how many times a row counts."""
    return checkpointed(weighted(df, value, keys, weight).groupBy(*(keys or []), "value").agg(F.sum("n").alias("n")))


def weighted(df: DataFrame, value: str, keys: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """The keys, ``value`` (double) and ``n`` (how many times the row counts) of the rows that have a value and all keys."""
    times = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    rows = df.where(F.col(value).isNotNull())
    for key in keys or []:
        rows = rows.where(F.col(key).isNotNull())
    return rows.select(*(keys or []), F.col(value).cast("double").alias("value"), times.alias("n"))


def log_bin(value: Column, bins: int = BINS) -> Column:
    """Number of the value's bin: ascending with the value, 0 for zero, the last for infinity and NaN."""
    size = F.abs(value)
    last = LOG_RANGE * 2 * bins + 2
    place = F.floor((F.log(size) + LOG_RANGE) * bins) + 1
    return (F.when(value == 0, F.lit(0)).when(F.isnan(value), F.lit(last + 1)).when(size == float("inf"), F.when(value > 0, last).otherwise(-last))
            .when(value > 0, place).otherwise(-place).cast("bigint"))


def sketch(rows: DataFrame, keys: list[str] | None = None, bins: int = BINS) -> DataFrame:
    """The keys, ``bin``, ``n``, and the least and greatest value in it (``low``, ``high``). Sketches of parts merge by summing ``n`` and widening the range."""
    return rows.groupBy(*(keys or []), log_bin(F.col("value"), bins).alias("bin")).agg(
        F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


def joined_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of their group; groups are broadcast only if they are counted and few."""
    few = groups.select(*keys).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(groups) if few else groups, keys)


def brackets(bins: DataFrame, probs: dict[str, float], keys: list[str]) -> DataFrame:
    """For each group and wanted rank: keys, ``size`` (of the group), ``name``, ``upper``, ``rest`` (rank within the bin), ``low``, ``high``.

    The two ranks around a quantile are ``upper`` false and true. A group's bins meet in one task; there are only so many of them.
    """
    group = Window.partitionBy(*keys)
    placed = bins.withColumn("before", F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    placed = placed.withColumn("size", F.sum("n").over(group))
    ranks = []
    for name, p in probs.items():
        at = F.lit(p) * (F.col("size") - 1)
        ranks += [F.struct(F.lit(name).alias("name"), F.lit(False).alias("upper"), F.floor(at).alias("rank")),
                  F.struct(F.lit(name).alias("name"), F.lit(True).alias("upper"), F.ceil(at).alias("rank"))]
    here = F.filter(F.array(*ranks), lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("before") + F.col("n")))
    return placed.withColumn("r", F.explode(here)).select(
        *keys, "size", "r.name", "r.upper", (F.col("r.rank") - F.col("before")).alias("rest"), "low", "high")


def _refined(rows: DataFrame, wanted: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """``wanted`` with brackets that are ``parts`` times narrower, from one pass over the rows within them."""
    bracket = F.collect_set(F.struct("low", "high")).alias("within")
    if keys:
        # At most two brackets for each wanted quantile of a group.
        near = joined_groups(rows, wanted.groupBy(*keys).agg(bracket), keys)
    else:
        near = with_row_of(rows, wanted.agg(bracket), "within")
    held = F.filter("within", lambda b: F.col("value").between(b["low"], b["high"]))
    inner = near.withColumn("b", F.explode(held)).select(*keys, "value", "n", "b.low", "b.high")
    part = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * parts)
    counted = inner.groupBy(*keys, "low", "high", part.alias("part")).agg(
        F.sum("n").alias("n"), F.min("value").alias("least"), F.max("value").alias("greatest"))
    up_to = Window.partitionBy(*keys, "low", "high").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("before", F.sum("n").over(up_to) - F.col("n"))
    return wanted.join(placed, [*keys, "low", "high"]).where("rest >= before AND rest < before + n").select(
        *keys, "size", "name", "upper", (F.col("rest") - F.col("before")).alias("rest"), F.col("least").alias("low"), F.col("greatest").alias("high"))


def _interpolated(ends: DataFrame, probs: dict[str, float], keys: list[str], value: Column) -> DataFrame:
    sides = ends.groupBy(*keys, "size").agg(
        *[F.max(F.when((F.col("name") == name) & (F.col("upper") == upper), value)).alias(f"_{name}_{int(upper)}") for name in probs for upper in (False, True)])

    def between(name: str, p: float):
        low, high = F.col(f"_{name}_0"), F.col(f"_{name}_1")
        part = F.lit(p) * (F.col("size") - 1) - F.floor(F.lit(p) * (F.col("size") - 1))
        return F.when(low == high, low).otherwise(low + (high - low) * part)

    return sides.select(*keys, *[between(n, p).alias(n) for n, p in probs.items()], F.col("size").alias("n"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    keys: list[str] | None = None,
    weight: str | None = None,
    bins: int | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation, one row per group: the keys, one column per prob, and ``n``.

    Rows without a value or a key are left out. ``df`` is read two times or a few more, so it should be stored if it is costly. ``bins``: parts of a bracket.
    """
    keys, rows = list(keys or []), weighted(df, value, keys, weight)
    wanted = settled(brackets(sketch(rows, keys), probs, keys))
    while not (open_ := wanted.where("low < high")).isEmpty():
        wanted = settled(wanted.where("NOT low < high").union(_refined(rows, open_, keys, bins or PARTS)))
    return _interpolated(wanted, probs, keys, F.col("low"))


def approximate_quantiles(df: DataFrame, value: str, probs: dict[str, float], keys: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """As ``exact_quantiles`` from the sketch alone, in one pass: each value is met to within 0.1 %."""
    keys = list(keys or [])
    ends = brackets(sketch(weighted(df, value, keys, weight), keys), probs, keys)
    return _interpolated(ends, probs, keys, F.col("low") + (F.col("high") - F.col("low")) / 2)
