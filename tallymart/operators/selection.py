"""Top-k and edge trimming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.functions.exprs import percent, rounded


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows; each task keeps k rows and only those are merged. ``order`` must be total."""
    return df.orderBy(*order).limit(k)


def with_row_of(df: DataFrame, one: DataFrame, name: str) -> DataFrame:
    """``df`` with the single value of ``one`` as column ``name``: one scalar subquery, run once."""
    return df.withColumn(name, one.scalar())


def with_share(df: DataFrame, name: str, part: Column, whole: DataFrame, digits: int | None = None) -> DataFrame:
    """Adds ``part`` as a percentage of the single value of ``whole``, rounded to ``digits`` if given."""
    share = percent(part, F.col("_whole"))
    share = share if digits is None else rounded(share, digits)
    return with_row_of(df, whole, "_whole").withColumn(name, share).drop("_whole")


def trim_edges(df: DataFrame, key: str, only_if_more_than: int = 0) -> DataFrame:
    """Drop the rows of the smallest and largest ``key`` (the first and last month of a series).

    With ``only_if_more_than`` a series of that many rows or fewer is kept as it is.
    """
    edges = df.agg(F.struct(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("n")))
    inner = (F.col(key) > F.col("_edges.first")) & (F.col(key) < F.col("_edges.last"))
    rows = with_row_of(df, edges, "_edges")
    return rows.where(inner | (F.col("_edges.n") <= only_if_more_than)).drop("_edges")
