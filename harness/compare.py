"""Run registered queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from harness import registry
from sabermill.session import build_session

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
# How a Spark type is called by the second engine.
TYPES = {
    "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "double": "DOUBLE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """What differs between both engines, or None."""
    df = registry.queries()[name](spark, sf_dir)
    sql = registry.oracle_sql().get(name)
    got = df.toArrow().to_pylist() if df.columns else []
    if sql is None:
        return None
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if names != df.columns:
        return f"columns {df.columns} / {names}"
    kinds = [TYPES[t] for _, t in df.dtypes]
    if kinds != [str(c[1]) for c in cursor.description]:
        return f"types {kinds} / {[str(c[1]) for c in cursor.description]}"
    ours = Counter(tuple(row[n] for n in names) for row in got)
    theirs = Counter(tuple(row) for row in cursor.fetchall())
    if ours == theirs:
        return None if ours else "both are empty"
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"rows {sum(ours.values())} / {sum(theirs.values())}, differing "
        f"{sum(only_ours.values())} / {sum(only_theirs.values())}, e.g. "
        f"{list(only_ours)[:1]} / {list(only_theirs)[:1]} of {names}"
    )


def main(sf_dir: str, prefixes: list[str]) -> int:
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in registry.ENTRIES:
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        began = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{name:40s} {time.time() - began:6.2f}s {problem or 'same'}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
