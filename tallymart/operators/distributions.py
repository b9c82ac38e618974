"""Histograms, box summaries and outlier fences."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymart.operators.quantiles import exact_quantiles, joined_groups, weighted
from tallymart.operators.selection import with_row_of
from tallymart.session import settled

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
FENCE = 1.5


def histogram(df: DataFrame, value: str, bins: int = 50, weight: str | None = None) -> DataFrame:
    """Equal-width bins over the value range: bin, bin_start, bin_end, count.

    The last bin includes its upper edge, empty bins have count 0, and a single value sits in the
    middle of a range of width 1.
    """
    values = df.where(F.col(value).isNotNull()).select(
        F.col(value).cast("double").alias("v"), (F.col(weight) if weight else F.lit(1).cast("bigint")).alias("w"))
    low, high = F.min("v"), F.max("v")
    pad = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    edges = values.agg(F.struct((low - pad).alias("low"), (high + pad).alias("high")))

    low, high = F.col("_edges.low"), F.col("_edges.high")
    width = (high - low) / F.lit(float(bins))
    guess = F.least(F.floor((F.col("v") - low) / (high - low) * F.lit(float(bins))), F.lit(bins - 1))
    # The quotient may round past an edge: what counts is the comparison with the edges themselves.
    place = (F.when(F.col("v") < low + guess * width, guess - 1)
             .when((F.col("v") >= low + (guess + 1) * width) & (guess < bins - 1), guess + 1).otherwise(guess))
    counts = with_row_of(values, edges, "_edges").groupBy(place.alias("bin")).agg(F.sum("w").alias("count"))
    numbered = df.sparkSession.range(bins).withColumnRenamed("id", "bin").join(counts, "bin", "left")
    return with_row_of(numbered, edges, "_edges").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def box_summary(df: DataFrame, key: str, value: str, weight: str | None = None) -> DataFrame:
    """Per group: quartiles, and whiskers at the furthest values within 1.5 interquartile ranges. ``df`` is read three times, so it should be stored if it is costly."""
    rows = weighted(df, value, [key], weight)
    boxes = settled(exact_quantiles(rows, "value", QUARTILES, [key], "n"))
    reach = FENCE * (F.col("q3") - F.col("q1"))
    v = F.col("value")
    whiskers = joined_groups(rows.drop("n"), boxes, [key]).groupBy(key).agg(
        F.min(F.when(v >= F.col("q1") - reach, v)).alias("low"),
        F.max(F.when(v <= F.col("q3") + reach, v)).alias("high"),
    )
    # A whisker never ends inside the box.
    return boxes.join(whiskers, key).select(
        key, F.col("n"), "q1", "median", "q3",
        F.least("low", "q1").alias("whisker_low"),
        F.greatest("high", "q3").alias("whisker_high"),
    )


def outlier_fence(df: DataFrame, value: str = "value", weight: str | None = "n") -> DataFrame:
    """One row: quartiles, upper fence and how many values exceed it."""
    rows = weighted(df, value, None, weight)
    q = exact_quantiles(rows, "value", {"q1": 0.25, "q3": 0.75}, None, "n")
    fence = q.select("q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr")).withColumn(
        "upper_bound", F.col("q3") + FENCE * F.col("iqr"))
    beyond = with_row_of(rows, fence.select("upper_bound"), "_limit").where(F.col("value") > F.col("_limit"))
    return with_row_of(fence, beyond.agg(F.coalesce(F.sum("n"), F.lit(0))), "outlier_count")
