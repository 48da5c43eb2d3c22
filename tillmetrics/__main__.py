"""Answer all questions for a folder of CSV datasets.

    python -m tillmetrics INPUT OUTPUT [--client-id ID] [--landing DIR | --stream DIR] [--show]

INPUT holds the files of one client (with ``--client-id``) or ``client_id=<id>``
folders. OUTPUT gets one folder per question and client. ``--stream`` keeps running
totals and state in a folder, so that the next call only reads new files.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.params import Params
from tillmetrics.plans import all_results, yearly_best_month
from tillmetrics.schemas import CLIENT, MENU_ITEMS, TRANSACTION_ITEMS, TRANSACTIONS, USERS
from tillmetrics.session import build_session
from tillmetrics.sources import (
    delivered_month,
    land,
    preview,
    print_rows,
    read_dataset,
    read_dimension,
    read_landed,
    read_result,
    write_result,
)
from tillmetrics.sources.landing import FILE_MONTH
from tillmetrics.sources.redelivery import has_repeated_names, with_origin
from tillmetrics.sources.shared_files import SharedFiles
from tillmetrics.streaming import run_session

def load(
    spark: SparkSession,
    root: str,
    client_id: str | None = None,
    months: list[str] | None = None,
    landing: str | None = None,
    params: Params = Params(),
    with_users: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """Inputs of :func:`tillmetrics.plans.all_results`, fact data by way of ``landing`` if given.

    What is loaded replaces the landed rows of the same client and the same months of files, of all
    clients and months where these are not given. Files that were delivered twice count once.
    """
    facts = []
    for kind in (TRANSACTIONS, TRANSACTION_ITEMS):
        rows = read_dataset(spark, root, kind, months, client_id)
        if landing:
            scope = {CLIENT: [client_id]} if client_id is not None else {}
            if months is not None:
                scope[FILE_MONTH] = [str(month) for month in months]
            # Most inputs hold every file once; the rows of the others keep their origin.
            repeated = has_repeated_names(spark, root, kind, scope.get(FILE_MONTH))
            land(with_origin(rows) if repeated else rows, f"{landing}/{kind}", scope, delivered_month())
            wanted = {"file_months": scope.get(FILE_MONTH), "clients": scope.get(CLIENT), "once": repeated}
            rows = read_landed(spark, f"{landing}/{kind}", kind, params.years, **wanted)
        facts.append(rows)
    menu = read_dimension(spark, root, MENU_ITEMS, client_id=client_id, deduplicate=False)
    users = read_dimension(spark, root, USERS, client_id=client_id, deduplicate=False) if with_users else None
    return facts[0], facts[1], menu, users


def run(
    spark: SparkSession,
    root: str,
    out: str,
    client_id: str | None = None,
    months: list[str] | None = None,
    landing: str | None = None,
    fmt: str = "parquet",
    params: Params = Params(),
    with_users: bool = True,
) -> dict[str, DataFrame]:
    """Write all result sets and return them as read back.

    With client folders ``out`` is replaced as a whole; with ``client_id`` only the
    results of that client are. The fact files are parsed once: without a ``landing`` copy
    to keep, one for this run alone stands below ``out`` until the answers are written.
    """
    stage = landing or f"{out.rstrip('/')}/_stage-{uuid.uuid4().hex}"
    results = all_results(*load(spark, root, client_id, months, stage, params, with_users), params)
    written = {}
    for name, result in results.items():
        write_result(result, name, out, fmt, whole=client_id is None, clients=[client_id])
        written[name] = read_result(spark, result.schema, name, out, fmt)
    if not landing:
        SharedFiles(spark).delete(stage)
    return written


def run_incremental(
    spark: SparkSession,
    root: str,
    out: str,
    work: str,
    params: Params = Params(),
    with_users: bool = True,
    close: list[str] | None = None,
) -> dict[str, DataFrame]:
    """As :func:`run`, reading only files that arrived since the last call.

    ``close`` lists clients that are complete: what they send later is ignored.
    """
    menu = read_dimension(spark, root, MENU_ITEMS, deduplicate=False)
    users = read_dimension(spark, root, USERS, deduplicate=False) if with_users else None
    closing = spark.createDataFrame([(c,) for c in close], f"{CLIENT} STRING") if close else None
    answers = run_session(spark, root, work, menu, users, params, out, closing)
    return {name: read_result(spark, answer.schema, name, out) for name, answer in answers.items()}


def show(written: dict[str, DataFrame], params: Params) -> None:
    """Print the first rows of Q1 and Q3, the best months of Q2, and the buyers of Q4."""
    order = {
        "q1": ["created_at", "transaction_id"],
        "q3": ["year", "semester", "store_id"],
        "q4": ["store_id", F.desc("count"), F.desc("user_id")],
    }
    for name, result in written.items():
        print(name)
        if name == "q2":
            print_rows(yearly_best_month(result).orderBy(CLIENT, "report", "year"))
        elif name == "q4":
            print_rows(result.orderBy(CLIENT, *order[name]))
        else:
            print_rows(preview(result, [CLIENT, *order[name]], params.preview_rows))


def _list(text: str) -> list[str]:
    return [part.strip() for part in text.split(",") if part.strip()]


def parse_args(arguments: list[str] | None = None) -> tuple[argparse.Namespace, Params]:
    default = Params()
    parser = argparse.ArgumentParser(
        prog="tillmetrics", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--client-id", help="the input folder holds one client's files")
    parser.add_argument("--months", type=_list, help="comma-separated YYYYMM list of files to read")
    parser.add_argument("--landing", help="shared folder for a parquet copy of the fact data")
    parser.add_argument("--stream", help="shared folder for state, to continue from the last call")
    parser.add_argument("--close", type=_list, help="with --stream: clients that are complete")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--no-users", action="store_true", help="answer only the first three questions")
    parser.add_argument("--show", action="store_true", help="print the first rows of each result")
    parser.add_argument("--years", type=_list, default=default.years)
    parser.add_argument("--start-hour", type=int, default=default.start_hour)
    parser.add_argument("--end-hour", type=int, default=default.end_hour)
    parser.add_argument("--min-amount", type=float, default=default.min_amount)
    parser.add_argument("--semesters", type=_list, default=default.semesters)
    parser.add_argument("--top", type=int, default=default.top_n)
    args = parser.parse_args(arguments)
    if args.stream and (args.client_id or args.landing or args.months or args.format != "parquet"):
        parser.error("--stream goes with client folders and parquet results only")
    params = Params(
        years=tuple(int(year) for year in args.years),
        start_hour=args.start_hour,
        end_hour=args.end_hour,
        min_amount=args.min_amount,
        semesters=tuple(args.semesters),
        top_n=args.top,
    )
    return args, params


def main() -> None:
    args, params = parse_args()
    spark = build_session()
    if args.stream:
        written = run_incremental(
            spark, args.input, args.output, args.stream, params, not args.no_users, args.close
        )
    else:
        written = run(
            spark,
            args.input,
            args.output,
            args.client_id,
            args.months,
            args.landing,
            args.format,
            params,
            with_users=not args.no_users,
        )
    if args.show:
        show(written, params)


if __name__ == "__main__":
    main()
