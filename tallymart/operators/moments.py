"""Pearson correlation from means and co-moments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymart.functions.exprs import rounded
from tallymart.operators.selection import with_row_of


def pairs_of(columns: list[str]) -> list[tuple[str, str]]:
    return [(x, y) for i, x in enumerate(columns) for y in columns[i:]]


def co_moments(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Per group: the keys, ``n``, the mean ``m_<x>`` of each column and the co-moment ``c_<x>_<y>`` of each pair, x not after y.

    A co-moment is the sum of products of deviations from the means. Rows with a null in any column are left out.
    """
    rows = df.dropna(subset=columns).select(*(keys or []), *[F.col(c).cast("double").alias(c) for c in columns])
    return rows.groupBy(*(keys or [])).agg(
        F.count("*").cast("double").alias("n"), *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[(F.covar_pop(x, y) * F.count("*")).alias(f"c_{x}_{y}") for x, y in pairs_of(columns)])


def merged(parts: DataFrame, columns: list[str], near: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row of ``n``, means and co-moments of all parts together.

    The parallel formula: a co-moment of the whole is the sum of the parts' own and of what their means deviate from the
    common mean, weighted by n. Deviations are first taken from a value ``near`` each mean (one-row DataFrames; any value gives the same
    result, one near the mean keeps all digits) and then moved to the mean, so that ``parts`` are read once. Without it the parts' own means are
    taken, which reads them twice. Co-moments that a part lacks are zero.
    """
    near = near or {c: parts.agg(F.sum(F.col("n") * F.col(f"m_{c}")) / F.sum("n")) for c in columns}
    for c in columns:
        parts = with_row_of(parts, near[c], f"near_{c}")
    off = {c: F.col(f"m_{c}") - F.coalesce(f"near_{c}", F.lit(0.0)) for c in columns}
    own = {(x, y): F.coalesce(f"c_{x}_{y}", F.lit(0.0)) if f"c_{x}_{y}" in parts.columns else F.lit(0.0) for x, y in pairs_of(columns)}
    sums = parts.agg(
        F.sum("n").alias("n"), *[F.max(F.coalesce(f"near_{c}", F.lit(0.0))).alias(f"near_{c}") for c in columns],
        *[(F.sum(F.col("n") * off[c]) / F.sum("n")).alias(f"off_{c}") for c in columns],
        *[F.sum(own[x, y] + F.col("n") * off[x] * off[y]).alias(f"s_{x}_{y}") for x, y in pairs_of(columns)])
    return sums.select(
        "n", *[(F.col(f"near_{c}") + F.col(f"off_{c}")).alias(f"m_{c}") for c in columns],
        *[(F.col(f"s_{x}_{y}") - F.col("n") * F.col(f"off_{x}") * F.col(f"off_{y}")).alias(f"c_{x}_{y}") for x, y in pairs_of(columns)])


def correlations(moments: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Long form (x, y, correlation) from one row of co-moments, to ``digits`` digits."""
    rows = [
        f"struct('{a}' AS x, '{b}' AS y, try_divide(c_{x}_{y}, sqrt(c_{x}_{x}) * sqrt(c_{y}_{y})) AS r)"
        for x, y in pairs_of(columns) for a, b in dict.fromkeys([(x, y), (y, x)])
    ]
    return moments.selectExpr(f"inline(array({', '.join(rows)}))").select("x", "y", rounded(F.col("r"), digits).alias("correlation"))


def correlation_matrix(sums: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Long form (x, y, correlation) from one row of plain sums, for where only those are known: they cancel if means are large.

    ``sums`` has ``n``, ``s_<x>`` for each column and ``s_<x>_<y>`` for each pair with x not after y.
    """
    return correlations(sums.selectExpr(*[f"s_{x}_{y} - s_{x} * s_{y} / n AS c_{x}_{y}" for x, y in pairs_of(columns)]), columns, digits)
