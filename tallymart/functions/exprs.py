"""Column expressions shared by all plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Characters that count as surrounding blanks in text columns.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Weekdays in report order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

MICROS_PER_DAY = 86_400_000_000.0


def stripped(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


# Doubles from here on do not fit a bigint: floor() would silently give the largest one.
BIGINT_LIMIT = 9.2e18


def rounded(col: Column, digits: int) -> Column:
    """Round half away from zero on a double, by plain arithmetic so that every engine agrees on ties.

    A double too large for that has no such digits and stays as it is.
    """
    x = col.cast("double")
    scale = 10.0**digits
    near = F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(F.abs(x) * F.lit(scale) < BIGINT_LIMIT, near).otherwise(x)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; NULL when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def cents(amount: Column) -> Column:
    """An amount of money as whole cents: sums of it are exact whatever the order, and cheap. An amount that does not fit is an error."""
    scaled = amount * F.lit(100.0) + F.lit(0.5)
    too_large = F.raise_error(F.concat(F.lit("amount out of range: "), amount.cast("string"))).cast("bigint")
    return F.when(F.abs(scaled) < BIGINT_LIMIT, F.floor(scaled)).when(scaled.isNotNull(), too_large)


def wide(whole: Column) -> Column:
    """A whole number with room for sums over any number of rows."""
    return whole.cast("decimal(22,0)")


def money(total_cents: Column) -> Column:
    return total_cents.cast("double") / F.lit(100.0)


def days_between(start: Column, end: Column) -> Column:
    """Fractional days from ``start`` to ``end``, both ``timestamp_ntz``.

    The interval between them is taken apart, because ``timestamp_diff`` would go through the session's time
    zone and lose or gain an hour where its clocks change.
    """
    gap = end - start
    days, hours, minutes, seconds = (F.extract(F.lit(unit), gap) for unit in ("DAY", "HOUR", "MINUTE", "SECOND"))
    whole = ((days * 24 + hours) * 60 + minutes).cast("bigint") * F.lit(60_000_000)
    micros = whole + (seconds * F.lit(1_000_000)).cast("bigint")
    return micros / F.lit(MICROS_PER_DAY)


def exact_micros(days: Column) -> Column:
    """Fractional days as whole microseconds, so that sums do not depend on row order."""
    return F.round(days * F.lit(MICROS_PER_DAY)).cast("decimal(20,0)")


def mean_days(sum_of_micros: Column, n: Column) -> Column:
    return F.try_divide(sum_of_micros.cast("double"), n.cast("double") * F.lit(MICROS_PER_DAY))


FIXED_POINT = 1e12


def fixed_point(col: Column) -> Column:
    """A double as a whole number of 1e-12 units: sums of it are exact whatever the order. Beyond decimal(28) it is an error."""
    scaled = col * F.lit(FIXED_POINT) + F.lit(0.5)
    small, large = F.floor(scaled).cast("decimal(28,0)"), scaled.cast("decimal(28,0)")
    return F.when(F.abs(scaled) < BIGINT_LIMIT, small).otherwise(large)


def from_fixed_point(col: Column) -> Column:
    return col.cast("double") / F.lit(FIXED_POINT)


def first_match(rules: list[tuple[Column, object]], otherwise) -> Column:
    """The value of the first condition that holds."""
    result = F.lit(otherwise)
    for condition, value in reversed(rules):
        result = F.when(condition, F.lit(value)).otherwise(result)
    return result


def weekday_number(day: Column) -> Column:
    """1 for Monday .. 7 for Sunday, NULL for anything else."""
    return first_match([(day == name, i) for i, name in enumerate(WEEKDAYS, start=1)], None)


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    """Exact sums inside the plans are decimals; results hand out doubles."""
    decimals = {f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"}
    if not decimals:
        return df
    return df.select(*[F.col(c).cast("double").alias(c) if c in decimals else F.col(c) for c in df.columns])
