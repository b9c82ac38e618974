"""Exact distinct counts that add up: sets of numbered ids as bitmaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymart.operators.running import running_total
from tallymart.session import new_shared_path


def numbered(ids: DataFrame, column: str, path: str | None = None) -> DataFrame:
    """Each distinct value of ``column`` with its ``number``, from 1 without gaps, stored so that it stays the same.

    Dense numbers keep bitmaps full: a set of k ids takes k bits or little more, whatever the ids look like. Nulls have none.
    """
    spark, path = ids.sparkSession, path or new_shared_path(ids.sparkSession, "numbers")
    distinct = ids.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_one", F.lit(1).cast("bigint"))
    rows = running_total(distinct, "_one", column).select(column, F.col("position").cast("bigint").alias("number"))
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def bitmaps(rows: DataFrame, number: str, keys: list[str]) -> DataFrame:
    """The sets of ``number`` per group, in pieces: the keys, ``bucket`` and ``bits``. A piece covers 32,768 numbers, so a large set is no large row."""
    some = rows.where(F.col(number).isNotNull())
    return some.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def rolled_up(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces of the union of sets over all groups that agree in ``keys``."""
    return pieces.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(pieces: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """How many ids the union of sets holds, per group of ``keys``."""
    return rolled_up(pieces, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
