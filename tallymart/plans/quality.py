"""Data-quality checks: each gives rows (table, check, status, detail)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallymart.functions.exprs import percent, rounded
from tallymart.operators.selection import with_row_of
from tallymart.schemas import EXPECTED, FOREIGN_KEYS, PRIMARY_KEYS

# Fixed value: a whole number in text form.
WHOLE_NUMBER = "^[+-]?[0-9]+$"

# The type a column of text is read as: a gap turns whole numbers into floating point.
READS_AS = """CASE WHEN filled = 0 THEN 'float64' WHEN whole = filled AND filled = n THEN 'int64'
                   WHEN numeric = filled THEN 'float64' ELSE 'object' END"""


REPORT_SCHEMA = "table string, check string, status string, detail string"


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def report_of(tables: Mapping[str, DataFrame], parts: list[DataFrame]) -> DataFrame:
    """The rows of all checks; none of them may apply to the given tables."""
    spark = next(iter(tables.values())).sparkSession
    return union(parts) if parts else spark.createDataFrame([], REPORT_SCHEMA)


def report_row(table: str, check: str, status: Column, detail: Column) -> list[Column]:
    return [F.lit(table).alias("table"), F.lit(check).alias("check"), status.alias("status"), detail.alias("detail")]


def fixed_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows known from the table declarations alone."""
    made = [F.struct(*[F.lit(v).alias(c) for c, v in zip(("table", "check", "status", "detail"), r)]) for r in rows]
    return spark.range(1).select(F.explode(F.array(*made)).alias("r")).select("r.*")


def with_commas(n: Column) -> Column:
    return F.format_number(n, 0)


def names(columns) -> str:
    return "{" + ", ".join(repr(c) for c in sorted(columns)) + "}"


def profile_expressions(df: DataFrame, column: str, expected: str | None) -> list[str]:
    """SQL for (filled rows, rows that read as a whole number, rows that read as a number).

    Only text needs looking at; a typed column reads as what it is.
    """
    filled, kind = f"count(`{column}`)", dict(df.dtypes)[column]
    if expected is None:
        return [filled, "0L", "0L"]
    if kind == "string":
        text = f"trim(`{column}`)"
        return [filled, f"count_if({text} RLIKE '{WHOLE_NUMBER}')", f"count_if(try_cast({text} AS double) IS NOT NULL)"]
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    number = whole or kind in ("float", "double") or kind.startswith("decimal")
    return [filled, filled if whole else "0L", filled if number else "0L"]


def column_profile(table: str, df: DataFrame, expected: dict[str, str], columns: list[str]) -> DataFrame:
    """One row per column from a single pass: its rows, filled rows, whole numbers and numbers."""
    parts = []
    for c in columns:
        filled, whole, numeric = profile_expressions(df, c, expected.get(c))
        declared = f"'{expected[c]}'" if c in expected else "CAST(NULL AS string)"
        parts.append(f"struct('{c}' AS column, {declared} AS expected, count(*) AS n, {filled} AS filled, "
                     f"{whole} AS whole, {numeric} AS numeric)")
    rows = df.agg(F.expr(f"array({', '.join(parts)})").alias("rows"))
    return rows.selectExpr(f"'{table}' AS table", "inline(rows)")


def column_rows(table: str, df: DataFrame, expected: dict[str, str]) -> list[tuple]:
    missing, extra = set(expected) - set(df.columns), set(df.columns) - set(expected)
    rows = [(table, "MISSING_COLS", "FAIL", names(missing)) if missing
            else (table, "COLUMNS", "PASS", f"{len(df.columns)} columns found")]
    return rows + ([(table, "EXTRA_COLS", "INFO", names(extra))] if extra else [])


def check_profiles(tables: Mapping[str, DataFrame], expected=EXPECTED, schema=True, nulls=True) -> DataFrame:
    """Column, type and missing-value checks, from one pass per table."""
    expected = expected if schema else {}
    profiles, known = [], [(t, "SCHEMA", "FAIL", "File not loaded") for t in expected if t not in tables]
    for table, df in tables.items():
        declared = expected.get(table, {})
        if declared:
            known += column_rows(table, df, declared)
        columns = df.columns if nulls else [c for c in df.columns if c in declared]
        if columns:
            profiles.append(column_profile(table, df, declared, columns))
    checks = f"""inline(array_compact(array(
        CASE WHEN {READS_AS} <> expected THEN named_struct(
            'check', 'DTYPE_' || column, 'status', 'WARN', 'detail', 'Expected ' || expected || ', got ' || {READS_AS}) END,
        CASE WHEN n > filled AND {nulls} THEN named_struct(
            'check', 'NULLS_' || column, 'status', 'INFO',
            'detail', format_number(n - filled, 0) || ' nulls (' || format_string('%.1f', share) || '%)') END)))"""
    share = rounded(percent(F.col("n") - F.col("filled"), F.col("n")), 1)
    parts = [union(profiles).withColumn("share", share).selectExpr("table", checks)] if profiles else []
    if known:
        parts.append(fixed_rows(next(iter(tables.values())).sparkSession, known))
    return report_of(tables, parts)


def check_schemas(tables: Mapping[str, DataFrame], expected=EXPECTED) -> DataFrame:
    """Missing and extra columns, and columns whose values do not read as the expected type."""
    return check_profiles(tables, expected, nulls=False)


def check_nulls(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns with missing values: how many, and the percentage."""
    return check_profiles(tables, schema=False)


def check_primary_keys(tables: Mapping[str, DataFrame], keys: dict[str, list[str]] = PRIMARY_KEYS) -> DataFrame:
    """How many rows share their key with another row."""
    parts = []
    for table, columns in keys.items():
        if table in tables:
            n = F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0))
            shared = tables[table].groupBy(*columns).count().agg(n.alias("n"))
            parts.append(shared.select(*report_row(
                table, "PRIMARY_KEY", F.when(F.col("n") == 0, "PASS").otherwise("FAIL"),
                F.concat(F.lit(f"PK={columns}, duplicates="), F.col("n").cast("string")))))
    return report_of(tables, parts)


def check_foreign_keys(tables: Mapping[str, DataFrame], keys: dict[str, list[tuple]] = FOREIGN_KEYS) -> DataFrame:
    """How many distinct child values are not in the parent."""
    parts = []
    for child, references in keys.items():
        if child not in tables:
            continue
        for column, parent, parent_column in references:
            if parent not in tables:
                parts.append(fixed_rows(tables[child].sparkSession, [
                    (child, f"FK_{column}", "SKIP", f"Parent table {parent} not loaded")]))
                continue
            values = tables[child].select(F.col(column).alias("k")).where("k IS NOT NULL").distinct()
            known = tables[parent].select(F.col(parent_column).alias("k")).distinct().withColumn("known", F.lit(True))
            found = values.join(known, "k", "left").agg(
                F.count("*").alias("n"), F.count_if(F.col("known").isNull()).alias("orphans"))
            parts.append(found.select(*report_row(
                child, f"FK_{column}→{parent}.{parent_column}",
                F.when(F.col("orphans") == 0, "PASS").otherwise("WARN"),
                F.concat(F.col("orphans").cast("string"), F.lit(" orphan values out of "),
                         F.col("n").cast("string"), F.lit(" unique")))))
    return report_of(tables, parts)


def check_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that repeat an earlier row in every column; missing values count as equal."""
    parts = []
    for table, df in tables.items():
        # Rows are told apart by a digest; only those whose digest occurs again are compared column by column.
        missing = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in df.columns])
        marked = df.withColumns({"_h1": F.xxhash64(F.lit(1), missing, *df.columns), "_h2": F.xxhash64(F.lit(2), missing, *reversed(df.columns))})
        digests = marked.groupBy("_h1", "_h2").agg(F.count("*").alias("_n"))
        again = marked.join(digests.where("_n > 1").select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
        repeated = again.groupBy(*df.columns).agg(F.count("*").alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeats"))
        counts = with_row_of(digests.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")), repeated, "repeats")
        repeats = F.col("repeats")
        parts.append(counts.select(*report_row(
            table, "DUPLICATES", F.when(repeats == 0, "PASS").otherwise("WARN"),
            F.concat(repeats.cast("string"), F.lit(" duplicate rows out of "), with_commas(F.col("n"))))))
    return report_of(tables, parts)


def quality_report(tables: Mapping[str, DataFrame], expected=EXPECTED, primary_keys=PRIMARY_KEYS,
                   foreign_keys=FOREIGN_KEYS) -> DataFrame:
    """All checks; columns, types and missing values come from one pass per table."""
    return union([
        check_profiles(tables, expected),
        check_primary_keys(tables, primary_keys),
        check_foreign_keys(tables, foreign_keys),
        check_duplicates(tables),
    ])


def status_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count("*").alias("checks"))


def failures(report: DataFrame) -> DataFrame:
    return report.where(F.col("status") == "FAIL")
