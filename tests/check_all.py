"""Compares all queries (or those named) with their SQL: python -m tests.check_all sf_dir [name ...]."""

import sys
import time
import traceback

from tallymart.session import build_session
from tests.compare import differences, duck
import __spark_entry__ as spark_entry


def main(sf_dir: str, names: list[str]) -> None:
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = duck(sf_dir), spark_entry.queries(), spark_entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sql:
                found = differences(df, con, sql[name])
                state = "ok" if not found else "DIFF " + " | ".join(found)
            else:
                state = f"no sql, {len(df.collect())} rows"
        except Exception as error:
            state = "ERROR " + "".join(traceback.format_exception_only(error))[:1500]
        failed += not state.startswith(("ok", "no"))
        print(f"{name:32s} {time.time() - start:6.2f}s {state}", flush=True)
    print("failed:", failed, "without query:", sorted(set(sql) - set(queries)))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
