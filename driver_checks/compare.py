"""Run queries beside their SQL: ``python -m driver_checks.compare FOLDER [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from driver_checks import ORACLES, QUERIES
from driver_checks.base import GIVEN


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return int(value) if isinstance(value, int) else str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for name in GIVEN:
        db.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return db


def compare(spark: SparkSession, db: duckdb.DuckDBPyConnection, folder: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return None
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if got != want:
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; only here {list((got - want).items())[:3]}, "
            f"only there {list((want - got).items())[:3]}"
        )
    return None if got else "no rows on either side"


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.driver.host", "127.0.0.1").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = connect(folder), 0
    for name in names or sorted(QUERIES):
        start = time.time()
        try:
            fault = compare(spark, db, folder, name)
        except Exception as error:  # report and go on with the others
            fault = f"{type(error).__name__}: {str(error)[:600]}"
        if fault:
            bad += 1
            print(f"FAIL {name}: {fault}", flush=True)
        elif time.time() - start > 5:
            print(f"slow {name} {time.time() - start:.1f}s", flush=True)
    print(f"{len(names or QUERIES)} queries, {bad} wrong")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
