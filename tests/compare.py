"""Run registered queries next to their SQL in DuckDB and compare whole results.

As a script: python -m tests.compare [sf_dir] [name part ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def make_session(cpus: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stationlake")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    bag = Counter(tuple(_value(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], bag


def differences(spark: SparkSession, sf_dir: str, query, sql: str | None) -> tuple[int, str]:
    """Number of Spark rows, and what differs from the SQL (empty when nothing does)."""
    df = query(spark, sf_dir)
    columns, bag = _bag(df.columns, df.collect())
    if sql is None:
        return sum(bag.values()), ""
    try:
        result = duck(sf_dir).execute(sql)
    except duckdb.InternalException:
        # Some DuckDB versions fail on their own query plan; the plain plan gives the same rows.
        plain = duck(sf_dir)
        plain.execute("PRAGMA disable_optimizer")
        result = plain.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected_columns, expected = _bag(expected_columns, result.fetchall())
    found = sum(bag.values())
    if columns != expected_columns:
        return found, f"columns {columns} instead of {expected_columns}"
    extra, lacking = bag - expected, expected - bag
    if extra or lacking:
        return found, (
            f"{sum(extra.values())} extra such as {next(iter(extra), None)}, "
            f"{sum(lacking.values())} lacking such as {next(iter(lacking), None)}"
        )
    return found, ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    parts = sys.argv[2:]
    spark = make_session()
    spark.sparkContext.setLogLevel("ERROR")
    sqls, failed = oracle_sql(), 0
    for name, query in queries().items():
        if parts and not any(part in name for part in parts):
            continue
        started = time.perf_counter()
        try:
            rows, problem = differences(spark, sf_dir, query, sqls.get(name))
        except Exception as error:  # noqa: BLE001 - every query is tried
            rows, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        note = "" if name in sqls else " (no SQL)"
        print(
            f"{'FAIL' if problem else 'ok  '} {name}{note}: {rows} rows, "
            f"{time.perf_counter() - started:.2f} s {problem}",
            flush=True,
        )
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
