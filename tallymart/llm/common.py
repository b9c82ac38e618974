"""What the operators share: reading tables, words, and decisions by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# ASCII white space; bytes.split() and bytes.strip() of Python use the same characters.
BLANK = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str = "text") -> Column:
    """The text as bytes, a null as no bytes."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unused(name: str, columns: list[str]) -> str:
    """The name, with as many underscores before it as it takes to begin none of the columns."""
    while any(c.lower().startswith(name) for c in columns):
        name = "_" + name
    return name


def batches_of(rows, names, schema, size: int = 100_000):
    """Arrow batches from an iterator of tuples, ``size`` rows each."""
    import pyarrow as pa

    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema)], names)
