"""Run queries next to their SQL and compare the rows: ``python -m checks.compare [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, records) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    bag = Counter(tuple(_normal(record[i]) for i in order) for record in records)
    return [columns[i] for i in order], bag


def compare(df, connection, sql: str) -> str | None:
    """None when both sides hold the same rows, otherwise what differs."""
    spark_columns, spark_rows = _rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    sql_columns, sql_rows = _rows(names, cursor.fetchall())
    if spark_columns != sql_columns:
        return f"columns {spark_columns} / {sql_columns}"
    if spark_rows != sql_rows:
        extra, missing = spark_rows - sql_rows, sql_rows - spark_rows
        return (
            f"rows {spark_rows.total()} / {sql_rows.total()}, only Spark {list(extra)[:2]}, "
            f"only SQL {list(missing)[:2]}"
        )
    return None


def main(names: list[str]) -> int:
    from checks import batch_queries, file_queries, stream_queries  # noqa: F401
    from checks.registry import QUERIES, SQL
    from tillmetrics.session import build_session

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "compare", master="local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        problem, count = None, ""
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in SQL:
                problem = compare(df, connection, SQL[name])
            else:
                count = f"{df.count()} rows, no SQL"
        except Exception as error:  # report it and go on with the next query
            problem = str(error)[:1500]
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:26s} {time.time() - start:6.2f}s {problem or count}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(main(sys.argv[1:]))
