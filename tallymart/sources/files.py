"""Text, JSON and Parquet sources and sinks."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallymart.schemas import RAW_SCHEMAS

log = logging.getLogger(__name__)

# Texts that mean "missing" in a CSV file.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Only these tables hold free text; a file with line breaks inside quotes cannot be split between tasks.
FREE_TEXT_TABLES = {"reviews"}


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV file or folder as it is: the columns its header names, all as text; missing texts are NULL."""
    try:
        df = spark.read.csv(path, header=True, inferSchema=False, multiLine=multi_line, escape='"')
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], "_no_columns string").drop("_no_columns")
    quoted = [f"`{c.replace('`', '``')}`" for c in df.columns]
    return df.select(*[F.when(~F.col(q).isin(MISSING_TEXTS), F.col(q)).alias(c) for q, c in zip(quoted, df.columns)])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns by name; a value that does not read as its type is NULL, and so is a column that is not there."""
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """A CSV file or folder with header, its declared columns found by name; see ``typed``."""
    return typed(read_text_csv(spark, path, multi_line), schema)


def write_csv(df: DataFrame, path: str) -> None:
    """One folder of CSV parts with header; quotes are doubled, so any text survives."""
    writer = df.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    writer.csv(path, header=True, escape='"')


def load_tables(spark: SparkSession, folder: str, schemas: dict[str, T.StructType] = RAW_SCHEMAS) -> dict[str, DataFrame]:
    """The raw tables found as ``folder/<name>.csv``, typed; a missing one is skipped with a warning."""
    return {name: typed(df, schemas[name]) for name, df in load_texts(spark, folder, schemas).items()}


def load_texts(spark: SparkSession, folder: str, schemas: dict[str, T.StructType] = RAW_SCHEMAS) -> dict[str, DataFrame]:
    """The same tables with all their columns as text: what the quality checks look at, so that nothing is lost before they see it."""
    tables = {}
    for name in schemas:
        path = f"{folder}/{name}.csv"
        try:
            tables[name] = read_text_csv(spark, path, name in FREE_TEXT_TABLES)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("table %s not found: %s", name, path)
    return tables


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row."""
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.json(path, schema=schema)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
