"""Jobs that write results and read them back."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, functions as F

from tallymart.plans.cubes import state_category_cube
from tallymart.plans.star import StoredStar, table_counts, write_star
from tallymart.schemas import STAR_TABLES
from tallymart.session import new_shared_path
from tallymart.sources.files import FREE_TEXT_TABLES, read_csv, read_json, write_csv, write_json, write_parquet

log = logging.getLogger(__name__)


def save_results(jobs: Mapping[str, Callable[[], DataFrame]], folder: str, at_once: int = 1) -> dict[str, DataFrame | None]:
    """Run named jobs, ``at_once`` of them side by side, and save each result as CSV; a job that fails is logged and gives None.

    Small jobs leave executors idle, which others can use meanwhile; results are in the order of ``jobs``.
    """
    def save(name: str) -> DataFrame | None:
        try:
            result = jobs[name]()
            write_csv(result, f"{folder}/{name}")
            return result
        except Exception:
            log.exception("job %s failed", name)
            return None

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(jobs, pool.map(save, jobs)))


def star_load(star, table: str) -> DataFrame:
    """Write one star table and read it back."""
    folder = new_shared_path(star.raw["orders"].sparkSession, "star")
    write_star(star, folder, [table])
    source, _ = STAR_TABLES[table]
    return getattr(StoredStar(star.raw["orders"].sparkSession, folder), source)


def stage_reload(star, name: str = "orders") -> DataFrame:
    """Hand a cleaned table to the next stage as Parquet: types survive, nothing is parsed again."""
    df = star.cleaned(name)
    path = new_shared_path(df.sparkSession, f"stage-{name}")
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def csv_roundtrip(star, name: str = "reviews") -> DataFrame:
    """Write a cleaned table as CSV and read it back; empty texts come back as missing."""
    df = star.cleaned(name)
    path = new_shared_path(df.sparkSession, f"csv-{name}")
    write_csv(df, path)
    return read_csv(df.sparkSession, path, df.schema, name in FREE_TEXT_TABLES)


def csv_by_name(star, name: str = "order_items") -> DataFrame:
    """Write a raw table as CSV with its columns in another order and one more, and load it by its declared columns."""
    df = star.raw[name]
    path = new_shared_path(df.sparkSession, f"csv-{name}")
    write_csv(df.select(*reversed(df.columns), F.lit("x").alias("remark")), path)
    return read_csv(df.sparkSession, path, df.schema, name in FREE_TEXT_TABLES)


def cube_json(star) -> DataFrame:
    """Write the state and category cube as JSON rows and read it back."""
    cube = state_category_cube(star)
    path = new_shared_path(cube.sparkSession, "cube")
    write_json(cube, path)
    return read_json(cube.sparkSession, path, cube.schema)


def star_counts(star) -> DataFrame:
    """Row counts of the eight star tables and their sum."""
    # Filling missing measures does not change how many products there are.
    return table_counts({table: getattr(star, source) for table, (source, _) in STAR_TABLES.items()})
