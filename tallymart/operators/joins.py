"""Joins that hold up when one key carries a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# A lookup side is broadcast only when its counted rows are at most this many.
BROADCAST_ROWS = 200_000
# One of short rows may have NARROW times as many where its size is measured and at most BROADCAST_BYTES.
NARROW = 5
BROADCAST_BYTES = 64 * 2**20

# A key is split when it holds at least 1/HOT_KEYS of the rows, so there are at most HOT_KEYS of them,
HOT_KEYS = 1_000
# and more rows than one task takes in its stride.
HOT_ROWS = 100_000
# A split key gets its share of this many slices.
SLICES = 4_000


def hot_keys(df: DataFrame, key: str, max_keys: int | None = None, slices: int | None = None) -> list[tuple]:
    """``[(key value, number of slices)]`` for the keys that hold at least 1/max_keys of the rows and HOT_ROWS.

    One pass over the key column with a mergeable heavy-hitter sketch; the driver gets at most
    ``max_keys`` values. The counts are estimates: they steer how rows spread, never the result.
    """
    max_keys, slices = max_keys or HOT_KEYS, slices or SLICES
    found = df.agg(
        F.expr(f"approx_top_k(`{key}`, {max_keys}, {max_keys * 10})").alias("top"),
        F.count("*").alias("n"),
    ).first()
    if not found["n"]:
        return []
    return [
        (row["item"], max(2, -(-row["count"] * slices // found["n"])))
        for row in found["top"] or []
        if row["count"] * max_keys >= found["n"] and row["count"] >= HOT_ROWS
    ]


def size_of(df: DataFrame) -> int:
    """Bytes of a table of numbers, times and texts as rows in memory; one pass over its texts."""
    texts = [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = 8 * (len(df.columns) + len(texts) + 1)
    return df.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(fixed).cast("bigint")))).first()[0] or 0


def is_small(right: DataFrame, rows: int) -> bool:
    """Whether a lookup side of ``rows`` rows may be broadcast; where their number alone does not tell, it is measured."""
    return rows <= BROADCAST_ROWS or (rows <= NARROW * BROADCAST_ROWS and size_of(right) <= BROADCAST_BYTES)


def sliced_join(left: DataFrame, right: DataFrame, key: str, how: str, spread_by: list[str], hot: list[tuple]) -> DataFrame:
    """Equi-join in which the rows of each hot key of ``left`` go to several slices.

    ``right`` rows of a hot key are repeated once per slice: at most SLICES + HOT_KEYS copies
    in all when ``right`` has one row per key. The slice is a hash of ``spread_by``, so a
    recomputed task puts its rows in the same place. Rows of ``left`` without a key are spread too.
    """
    spark = left.sparkSession
    schema = T.StructType([T.StructField(key, left.schema[key].dataType), T.StructField("_slices", T.IntegerType())])
    table = F.broadcast(spark.createDataFrame([(k, int(n)) for k, n in hot if k is not None], schema))
    # A missing key finds nothing, so its rows may go anywhere.
    slices = F.when(F.col(key).isNull(), SLICES).otherwise(F.col("_slices"))
    slice_no = F.pmod(F.xxhash64(*spread_by), slices).cast("int")
    a = left.join(table, key, "left").withColumn("_slice", F.coalesce(slice_no, F.lit(0))).drop("_slices")
    numbers = F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    b = right.join(table, key, "left").withColumn("_slice", F.explode(numbers)).drop("_slices")
    return a.join(b, [key, "_slice"], how).drop("_slice")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    spread_by: list[str] | None = None,
    right_rows: int | None = None,
    keys_from: DataFrame | None = None,
    broadcast_rows: int | None = None,
    max_keys: int | None = None,
) -> DataFrame:
    """Join ``left`` to ``right`` on ``key`` (``how`` inner or left).

    A counted-small ``right`` is broadcast. Otherwise both sides are shuffled, and keys that are hot
    on the left (or missing there in many rows) are split over slices by ``spread_by`` (default: the other columns of ``left``).
    ``right_rows`` is an upper bound for the rows of ``right`` where the caller already knows one.
    ``keys_from`` has the key column of ``left`` from before other joins, to look for hot keys in.
    """
    if right_rows is None:
        right_rows = right.select(key).count()
    if right_rows <= (BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        return left.join(F.broadcast(right), key, how)
    hot = hot_keys(left if keys_from is None else keys_from, key, max_keys)
    # Rows without a key count as a key here. A slice in the join key would shuffle ``right`` again where it is dealt out by its key already.
    if not hot:
        return left.join(right, key, how)
    return sliced_join(left, right, key, how, spread_by or [c for c in left.columns if c != key], hot)
