"""Do clients that sent the same data get the same answers?

    python -m tillmetrics.compare OUTPUT --clients client_1,client_2 [--queries q1,q2] [--format csv] [--show-diffs]

Compares the result sets of every pair of clients regardless of row order (D2) and
exits with status 1 when any pair differs. A question that was never answered is reported as missing and
counts as no comparison, as with ``--no-users``; an answer without rows is an answer. ``--show-diffs`` adds
the first rows of each pair that differ and the number of the others (D4).
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.operators import agreement, diff_sample_pairs, pairwise_verdicts, union_all
from tillmetrics.plans import QUERIES, all_results
from tillmetrics.schemas import CLIENT, DATASETS, MENU_ITEMS, TRANSACTION_ITEMS, TRANSACTIONS, USERS
from tillmetrics.session import build_session
from tillmetrics.sources import has_result, print_rows, read_result

SAMPLE_ROWS = 10


def result_schemas(spark: SparkSession) -> dict[str, T.StructType]:
    """Columns of every result set, as the plans define them; no file has to be looked at."""

    def empty(kind: str) -> DataFrame:
        fields = [*DATASETS[kind].typed_schema.fields, T.StructField(CLIENT, T.StringType())]
        return spark.createDataFrame([], T.StructType(fields))

    inputs = [empty(kind) for kind in (TRANSACTIONS, TRANSACTION_ITEMS, MENU_ITEMS, USERS)]
    return {name: result.schema for name, result in all_results(*inputs).items()}


def stored_result(spark: SparkSession, out: str, query: str, fmt: str = "parquet") -> DataFrame:
    """A result set, its client kept as text whatever it looks like; no rows where there are none."""
    return read_result(spark, result_schemas(spark)[query], query, out, fmt)


def answered(spark: SparkSession, out: str, queries: Sequence[str]) -> list[str]:
    """The questions that have a result set, with rows or without."""
    return [query for query in queries if has_result(spark, query, out)]


def verdicts(
    spark: SparkSession, out: str, clients: Sequence[str], queries: Sequence[str] = QUERIES, fmt: str = "parquet"
) -> DataFrame:
    """One row per answered question and pair of clients."""
    schema = "query string, left_client string, right_client string, left_rows long, right_rows long, differing_rows long, identical boolean"
    reports = [spark.createDataFrame([], schema)]
    for query in answered(spark, out, queries):
        pairs = pairwise_verdicts(stored_result(spark, out, query, fmt), clients)
        reports.append(pairs.select(F.lit(query).alias("query"), "*"))
    return union_all(*reports)


def main() -> int:
    parser = argparse.ArgumentParser(prog="tillmetrics.compare", description=__doc__)
    parser.add_argument("output")
    parser.add_argument("--clients", required=True)
    parser.add_argument("--queries", default=",".join(QUERIES))
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--show-diffs", action="store_true")
    args = parser.parse_args()

    spark = build_session("tillmetrics-compare")
    clients, queries = args.clients.split(","), args.queries.split(",")
    report = verdicts(spark, args.output, clients, queries, args.format)
    print_rows(report.orderBy("query", "left_client", "right_client"))
    found = answered(spark, args.output, queries)
    for query in queries:
        if query not in found:
            print(f"{query}: missing")
    if args.show_diffs:
        for query in found:
            rows = diff_sample_pairs(stored_result(spark, args.output, query, args.format), clients, SAMPLE_ROWS)
            print(query)
            print_rows(rows.orderBy("left_client", "right_client", "place"))
    total = agreement(report).first()
    print(f"{total['comparisons']} comparisons, all identical: {total['all_identical']}")
    return 0 if total["all_identical"] else 1


if __name__ == "__main__":
    sys.exit(main())
