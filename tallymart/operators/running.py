"""Running totals over any number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallymart.functions.exprs import wide
from tallymart.session import checkpointed


def running_total(df: DataFrame, value: str, *order, ranges: int | None = None) -> DataFrame:
    """Adds ``running`` (sum of whole-number ``value`` up to the row), ``position`` (1-based) and the
    overall ``total`` and ``rows``, in the given total order.

    A single window over all rows would run in one task. Instead rows are range-partitioned by the
    order; the placement is checkpointed so that a lost task cannot move rows; each range is summed; the
    few range sums give each range its offset; and a window runs within each range.
    """
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    placed = checkpointed(dealt.withColumn("_range", F.spark_partition_id()))
    up_to_here = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # One row per range: as many as there are partitions.
    offsets = (
        placed.groupBy("_range").agg(F.sum(wide(F.col(value))).alias("_sum"), F.count("*").alias("_n"))
        .select(
            "_range",
            F.coalesce(F.sum("_sum").over(up_to_here), F.lit(0)).alias("_sum_before"),
            F.coalesce(F.sum("_n").over(up_to_here), F.lit(0)).alias("_n_before"),
            F.sum("_sum").over(everything).alias("total"),
            F.sum("_n").over(everything).alias("rows"),
        )
    )
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn("running", F.col("_sum_before") + F.sum(wide(F.col(value))).over(within))
        .withColumn("position", F.col("_n_before") + F.count("*").over(within))
        .drop("_range", "_sum_before", "_n_before")
    )
