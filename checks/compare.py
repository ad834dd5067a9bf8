"""Run queries on Spark and on DuckDB and compare them by value.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the tables of ``sf`` as views."""
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns and rows in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cut = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cut, key=repr)


def compare(spark: SparkSession, con, sf: str, name: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](spark, sf)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    spark_time, start = time.time() - start, time.time()
    cursor = con.execute(ORACLES[name])
    theirs = normal([c[0] for c in cursor.description], cursor.fetchall())
    note = f"{len(ours[1])} / {len(theirs[1])} rows, {spark_time:.1f} s / {time.time() - start:.1f} s"
    if ours[0] != theirs[0]:
        return False, f"{note}, columns {ours[0]} / {theirs[0]}"
    if ours[1] != theirs[1]:
        first = next(((a, b) for a, b in zip(ours[1], theirs[1]) if a != b), None)
        return False, f"{note}, first difference {str(first)[:600]}"
    return True, note


def main() -> int:
    from corpusloom.session import builder

    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = builder("compare").master("local[8]").config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").config(
        "spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, wrong = connect(sf), 0
    for name in names:
        if name not in ORACLES:
            print(f"{name:20s} no oracle, {QUERIES[name](spark, sf).count()} rows", flush=True)
            continue
        try:
            ok, note = compare(spark, con, sf, name)
        except Exception as error:  # report and go on with the other queries
            ok, note = False, str(error)[:600]
        wrong += not ok
        print(f"{name:20s} {'ok' if ok else 'DIFFERENT'}  {note}", flush=True)
    return wrong


if __name__ == "__main__":
    sys.exit(main())
