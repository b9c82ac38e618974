"""Runs a query on Spark and its SQL on DuckDB, and compares the rows whatever their order."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def _value(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return v + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when columns, row counts and values agree."""
    got_columns = spark_df.columns
    relation = con.sql(sql)
    want_columns = relation.columns
    if sorted(got_columns) != sorted(want_columns):
        return [f"columns {sorted(got_columns)} against {sorted(want_columns)}"]
    got = canonical([tuple(r) for r in spark_df.collect()], got_columns)
    want = canonical(relation.fetchall(), want_columns)
    if len(got) != len(want):
        return [f"{len(got)} rows against {len(want)}", f"{got[:2]}", f"{want[:2]}"]
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    return [f"{len(bad)} of {len(got)} rows differ: {bad[0][0]} against {bad[0][1]}"] if bad else []
