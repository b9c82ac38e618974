"""Columns packed into few whole numbers, without loss, so that a shuffle carries fewer bytes.

What columns hold is measured, not assumed: one pass finds the range of whole numbers, times and amounts, and a value takes the bits
that its column's range needs. Texts, doubles with more than two decimal places and ranges too wide for it stay as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Bits of a packed number: the sign is not used.
WORD = 63
# Doubles count whole numbers one by one up to here.
EXACT = 2.0**53
# No value is this far below the least one.
MISSING = -(2**62)
SECOND, DAY = 1_000_000, 86_400_000_000


@dataclass(frozen=True)
class Field:
    """A packed column: its values are ``low`` .. ``high`` times ``unit`` (parts: divided by it)."""

    name: str
    type: T.DataType
    unit: int
    low: int
    high: int

    @property
    def bits(self) -> int:
        return (self.high - self.low + 1).bit_length()

    @property
    def whole(self) -> Column:
        """The value as a whole number of units."""
        col = F.col(self.name)
        if isinstance(self.type, T.DoubleType):
            return _parts(col, self.unit)
        if isinstance(self.type, T.TimestampNTZType):
            return F.unix_date(col.cast("date")).cast("bigint") if self.unit == DAY else F.expr(f"{_micros(self.name)} div {self.unit}L")
        return col.cast("bigint")

    def value(self, whole: Column) -> Column:
        if isinstance(self.type, T.DoubleType):
            return whole.cast("double") / F.lit(float(self.unit))
        if isinstance(self.type, T.TimestampNTZType):
            rest = F.pmod(whole, F.lit(DAY // self.unit))
            day = F.call_function("div", whole - rest, F.lit(DAY // self.unit)) if self.unit < DAY else whole
            midnight = F.date_from_unix_date(day.cast("int")).cast("timestamp_ntz")
            return midnight if self.unit == DAY else midnight + rest * F.expr(f"INTERVAL '{self.unit / SECOND:f}' SECOND")
        return whole.cast(self.type)


def _parts(col: Column, unit: int) -> Column:
    return F.floor(col * F.lit(float(unit)) + F.lit(0.5))


def _micros(name: str) -> str:
    """A time as microseconds, whatever the session's time zone."""
    minutes = f"(unix_date(CAST(`{name}` AS DATE)) * 24L + hour(`{name}`)) * 60L + minute(`{name}`)"
    return f"(({minutes}) * 60000000L + CAST(extract(SECOND FROM `{name}`) * 1000000 AS BIGINT))"


def measure(df: DataFrame) -> list[Field]:
    """How the columns of ``df`` can be packed; those that cannot be are left out. One pass, one row."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    columns = [f for f in df.schema.fields if isinstance(f.dataType, (*whole, T.DoubleType, T.TimestampNTZType))]
    wanted = []
    for i, f in enumerate(columns):
        col = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            # Negative zero equals zero, but is another value.
            odd = {unit: ~((_parts(col, unit).cast("double") / F.lit(float(unit)) == col) & (F.abs(col) * F.lit(float(unit)) < EXACT))
                   | ((col == 0) & (col.cast("string") == "-0.0")) for unit in (1, 100)}
        elif isinstance(f.dataType, T.TimestampNTZType):
            col = F.expr(_micros(f.name))
            odd = {unit: F.pmod(col, F.lit(unit)) != 0 for unit in (DAY, SECOND, 1)}
        else:
            odd = {1: F.lit(False)}
        wanted += [F.struct(F.min(col).alias("low"), F.max(col).alias("high"), *[F.count_if(o).alias(f"odd_{u}") for u, o in odd.items()]).alias(f"c{i}")]
    if not wanted:
        return []
    found, fields = df.agg(*wanted).first(), []
    for i, f in enumerate(columns):
        range_ = found[f"c{i}"].asDict()
        unit = next((int(name[4:]) for name, n in range_.items() if name.startswith("odd_") and not n), None)
        if unit is None:
            continue
        ends = [0 if x is None else x for x in (range_["low"], range_["high"])]
        if isinstance(f.dataType, T.DoubleType):
            ends = [math.floor(x * unit + 0.5) for x in ends]
        elif isinstance(f.dataType, T.TimestampNTZType):
            ends = [x // unit for x in ends]
        field = Field(f.name, f.dataType, unit, *ends)
        if field.bits < WORD:
            fields.append(field)
    return fields


def places(fields: list[Field]) -> list[tuple[Field, int, int]]:
    """``(field, number of its word, bits to its right)``, widest first, each in the first word with room."""
    used, placed = [], []
    for field in sorted(fields, key=lambda f: -f.bits):
        word = next((i for i, n in enumerate(used) if n + field.bits <= WORD), len(used))
        used += [0] * (word == len(used))
        placed.append((field, word, used[word]))
        used[word] += field.bits
    return placed


# Each step below is a projection of its own, as Spark does not inline what the next one uses twice, and codes are never NULL: that keeps the code it
# generates short enough for the JVM to compile.
def encode(df: DataFrame, fields: list[Field]) -> DataFrame:
    """``df`` with codes in place of values: 0 for NULL, else 1 and more. A value outside the measured range, which would spoil others, is an error."""
    if not fields:
        return df
    above = df.withColumns({f.name: F.coalesce(f.whole - F.lit(f.low), F.lit(MISSING)) for f in fields})
    codes = above.withColumns({
        f.name: F.when(F.col(f.name).between(0, f.high - f.low), F.col(f.name) + F.lit(1)).when(F.col(f.name) == MISSING, F.lit(0)).otherwise(F.lit(-1))
        for f in fields})
    changed = F.raise_error(F.lit("a table has changed since it was measured")).cast("bigint")
    first = F.col(fields[0].name)
    return codes.withColumn(fields[0].name, F.when(reduce(Column.bitwiseOR, [F.col(f.name) for f in fields]) < 0, changed).otherwise(first))


def decode(df: DataFrame, fields: list[Field]) -> DataFrame:
    return df.withColumns({f.name: F.when(F.col(f.name) > 0, f.value(F.col(f.name) + F.lit(f.low - 1))) for f in fields})


def pack(df: DataFrame, fields: list[Field]) -> DataFrame:
    """``df`` with the codes of ``fields`` in columns ``_word0``, ``_word1`` ... instead."""
    words: dict[str, Column] = {}
    for field, word, right in places(fields):
        name, moved = f"_word{word}", F.shiftleft(F.col(field.name), right)
        words[name] = words[name].bitwiseOR(moved) if name in words else moved
    return df.withColumns(words).drop(*[f.name for f in fields])


def unpack(df: DataFrame, fields: list[Field]) -> DataFrame:
    """The codes again, as the last columns."""
    placed = places(fields)
    codes = {f.name: F.shiftright(F.col(f"_word{word}"), right).bitwiseAND(F.lit((1 << f.bits) - 1).cast("bigint")) for f, word, right in placed}
    return df.withColumns(codes).drop(*{f"_word{word}" for _, word, _ in placed})
