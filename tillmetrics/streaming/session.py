"""A whole streaming session: ingest, running aggregates, final answers.

One query per question serves all clients at once; the client is part of every
state key. Calling :func:`run_session` again continues where the last call stopped:
new files are added to the totals, files seen before are not read again, and files
of closed clients are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.operators import drop_closed, keep_referenced
from tillmetrics.params import Params
from tillmetrics.plans import (
    buyer_counts,
    high_value_transactions,
    item_month_totals,
    rank_buyers,
    rank_items,
    semester_store_totals,
    store_volume,
    transaction_funnel,
    with_birthdays,
)
from tillmetrics.plans.buyers import BUYER
from tillmetrics.plans.items import ITEM_MONTH
from tillmetrics.plans.stores import SEMESTER_STORE
from tillmetrics.schemas import CLIENT, TRANSACTION_ITEMS, TRANSACTIONS
from tillmetrics.sources.landing import landing_schema
from tillmetrics.sources.results import write_result
from tillmetrics.sources.shared_files import SharedFiles
from tillmetrics.sources.versions import VersionedSet
from tillmetrics.streaming.ingest import FOLDERS, LEDGER_SCHEMA, MAX_FILES, land_stream, sender_columns, stream_landed
from tillmetrics.streaming.running import (
    EPOCH,
    current_totals,
    finish,
    read_epochs,
    start_append,
    start_totals,
)

_CLOSED_SCHEMA = T.StructType([T.StructField(CLIENT, T.StringType())])


#: Landed epochs that make a compaction worth while, and folder levels of what it leaves.
COMPACT_EPOCHS = 100
_ARCHIVED = ("through", CLIENT, "year")
#: Fixed value: name of the files in which senders announce the number of their batches.
ANNOUNCED = "announced.csv"


class Answers(dict):
    """Answers by name, and in ``stages`` the rows that went into each stage, per client."""

    def __init__(self, answers: dict[str, DataFrame], stages: DataFrame):
        super().__init__(answers)
        self.stages = stages


@dataclass(frozen=True)
class Session:
    """Folders of a session, all below one shared working folder."""

    work: str

    @property
    def landing(self) -> str:
        return f"{self.work}/landing"

    @property
    def ledger(self) -> str:
        return f"{self.work}/batches"

    @property
    def closed(self) -> str:
        return f"{self.work}/closed"

    def checkpoint(self, name: str) -> str:
        return f"{self.work}/checkpoints/{name}"

    def output(self, name: str) -> str:
        return f"{self.work}/epochs/{name}"


#: Parameters that shape running totals; the others only matter when answers are given.
_SHAPING = ("years", "start_hour", "end_hour", "min_amount", "semesters")


def hold_params(spark: SparkSession, session: Session, params: Params) -> None:
    """Remember what shapes the totals of this folder; refuse to mix them with other values.

    The order of years and semesters does not matter. What is remembered appears at once or not at all.
    """
    shaping = {name: getattr(params, name) for name in _SHAPING}
    shaping = {name: sorted(set(v)) if isinstance(v, (tuple, list)) else v for name, v in shaping.items()}
    given, path, files = json.dumps(shaping, sort_keys=True), f"{session.work}/_params", SharedFiles(spark)
    held = given if files.publish(path, given) else files.read(path)
    if held != given:
        raise ValueError(f"{session.work} holds totals for {held}, not for {given}; take another folder")


def closed_clients(spark: SparkSession, session: Session) -> DataFrame:
    """Clients whose final answer has been given."""
    spark.createDataFrame([], _CLOSED_SCHEMA).write.mode("ignore").parquet(session.closed)
    return spark.read.schema(_CLOSED_SCHEMA).parquet(session.closed)


def close_clients(clients: DataFrame, session: Session) -> None:
    """Rows of these clients that arrive later are ignored."""
    clients.select(CLIENT).distinct().write.mode("append").parquet(session.closed)


def ingest(spark: SparkSession, root: str, session: Session, max_files: int = MAX_FILES) -> None:
    land_stream(
        spark,
        root,
        session.landing,
        session.ledger,
        session.checkpoint("landing"),
        closed_clients(spark, session),
        max_files=max_files,
    )


def batch_counts(spark: SparkSession, session: Session) -> DataFrame:
    """Accepted batches and bytes per client and dataset."""
    ledger = spark.read.schema(f"{LEDGER_SCHEMA}, {EPOCH} BIGINT").parquet(session.ledger)
    return ledger.groupBy(CLIENT, "dataset").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("length").alias("bytes")
    )


def announcements(spark: SparkSession, root: str) -> DataFrame:
    """What senders say they will have delivered: ``client_id``, ``sender``, ``dataset``, ``expected``.

    A sender's folder may hold ``announced.csv`` with a header line and a line ``dataset,batches`` for each
    dataset. A sender that sends it again, in another folder of its own, raises the number.
    """
    reader = spark.read.schema("dataset STRING, expected BIGINT").option("header", True)
    lines = reader.option("recursiveFileLookup", True).option("pathGlobFilter", ANNOUNCED).csv(root)
    path = F.col("_metadata.file_path")
    keyed = lines.select("dataset", "expected", *[column.alias(name) for name, column in sender_columns(path).items()])
    return keyed.groupBy(CLIENT, "sender", "dataset").agg(F.max("expected").alias("expected"))


def completed_clients(spark: SparkSession, root: str, session: Session) -> list[str]:
    """T4: clients of whom every announced batch of every sender is in the ledger, and who are not closed.

    The ledger is the state of this: one row per accepted batch, copies not counted. A client without
    announcements is never complete by itself.
    """
    ledger = spark.read.schema(f"{LEDGER_SCHEMA}, {EPOCH} BIGINT").parquet(session.ledger)
    arrived = ledger.groupBy(CLIENT, "sender", "dataset").agg(F.count(F.lit(1)).alias("arrived"))
    announced = drop_closed(announcements(spark, root), closed_clients(spark, session))
    compared = announced.join(arrived, [CLIENT, "sender", "dataset"], "left")
    whole = compared.groupBy(CLIENT).agg(F.bool_and(F.coalesce("arrived", F.lit(0)) >= F.col("expected")).alias("whole"))
    return [row[CLIENT] for row in whole.filter("whole").select(CLIENT).collect()]


def _archive(spark: SparkSession, session: Session, kind: str) -> VersionedSet:
    return VersionedSet(spark, f"{session.work}/archive/{kind}", _ARCHIVED)


def _archived(spark: SparkSession, session: Session, kind: str) -> int:
    """The last landed epoch that the archive holds."""
    _, loads = _archive(spark, session, kind).current()
    return max([int(value) for load in loads for value in load["scope"]["through"]], default=-1)


def compact_landing(spark: SparkSession, session: Session, epochs: int = COMPACT_EPOCHS) -> None:
    """Move landed epochs that all totals have taken in to an archive of fewer, larger files.

    Only at rest, after :func:`aggregate`. Nothing is done for fewer than so many epochs. Epochs leave the landing area once
    the archive counts them; those that a crash has left there are removed first.
    """
    files = SharedFiles(spark)
    for kind in (TRANSACTIONS, TRANSACTION_ITEMS):
        done = _archived(spark, session, kind)
        landed = [int(name.split("=")[1]) for name in files.names(f"{session.landing}/{kind}") if name.startswith(f"{EPOCH}=")]
        waiting = [epoch for epoch in landed if epoch > done]
        if len(waiting) >= epochs:
            rows = _landed_rows(spark, session, kind).filter(F.col(EPOCH) > done).drop(EPOCH)
            rows = rows.withColumn("through", F.lit(max(waiting)).cast("string")).hint("rebalance", CLIENT, "year")
            _archive(spark, session, kind).load(rows, {"through": [str(max(waiting))]})
            done = max(waiting)
        for epoch in landed:
            if epoch <= done:
                files.delete(f"{session.landing}/{kind}/{EPOCH}={epoch}")


def _landed_rows(spark: SparkSession, session: Session, kind: str) -> DataFrame:
    return spark.read.schema(landing_schema(kind, FOLDERS)).parquet(f"{session.landing}/{kind}")


def read_session(spark: SparkSession, session: Session, kind: str) -> DataFrame:
    """All accepted rows of a dataset, archived or not."""
    fresh = _landed_rows(spark, session, kind).filter(F.col(EPOCH) > _archived(spark, session, kind)).drop(EPOCH)
    archived = _archive(spark, session, kind).read(landing_schema(kind, _ARCHIVED)).drop("through")
    return archived.unionByName(fresh).drop("year")


def _landed(spark: SparkSession, session: Session, kind: str, max_files: int) -> DataFrame:
    return stream_landed(spark, session.landing, kind, max_files)


def aggregate(
    spark: SparkSession, session: Session, params: Params = Params(), max_files: int = MAX_FILES
) -> dict[str, DataFrame]:
    """Bring the running results up to date with the landing area.

    Returns ``q1`` as rows, ``q2`` to ``q4`` as current totals, and ``stages``, the stage counters per client
    (D5). These are running totals like the others, so a repeated micro-batch is not counted
    again. Landing must be at rest, as it is after :func:`ingest`.
    """
    transactions = _landed(spark, session, TRANSACTIONS, max_files)
    items = _landed(spark, session, TRANSACTION_ITEMS, max_files)

    found = high_value_transactions(transactions, params)
    totals = {
        "q2": (item_month_totals(items, params), ITEM_MONTH),
        "q3": (semester_store_totals(transactions, params), SEMESTER_STORE),
        "q4": (buyer_counts(transactions, params), BUYER),
        "stages": (transaction_funnel(transactions, params), (CLIENT,)),
    }
    # The streams run side by side, so one does not wait for another's last tasks.
    queries = [start_append(found, session.output("q1"), session.checkpoint("q1"))]
    for name, (running, keys) in totals.items():
        queries.append(start_totals(running, keys, session.output(name), session.checkpoint(name)))
    finish(*queries)

    current = {"q1": read_epochs(spark, found.schema, session.output("q1")).drop(EPOCH)}
    for name, (running, keys) in totals.items():
        current[name] = current_totals(spark, running.schema, keys, session.output(name))
    return current


def final_answers(
    current: dict[str, DataFrame],
    menu_items: DataFrame,
    users: DataFrame | None,
    params: Params = Params(),
) -> dict[str, DataFrame]:
    """Ranking and lookups over the totals, once input is exhausted."""
    answers = {
        "q1": current["q1"],
        "q2": rank_items(current["q2"], menu_items),
        "q3": store_volume(current["q3"]),
    }
    if users is not None:
        answers["q4"] = with_birthdays(rank_buyers(current["q4"], params), users)
    return answers


def run_session(
    spark: SparkSession,
    root: str,
    work: str,
    menu_items: DataFrame,
    users: DataFrame | None,
    params: Params = Params(),
    out: str | None = None,
    close: DataFrame | None = None,
    max_files: int = MAX_FILES,
    only_complete: bool = False,
    compact_epochs: int = COMPACT_EPOCHS,
) -> Answers:
    """Process everything available below ``root`` and answer the questions.

    ``out`` also writes the result sets, and the stage counters as ``stages``. ``close`` names clients that are
    complete after this call; those whose announcements are fulfilled (see :func:`completed_clients`) are
    complete without being named. ``only_complete`` answers for such clients alone.
    """
    session = Session(work)
    hold_params(spark, session, params)
    ingest(spark, root, session, max_files)
    complete = completed_clients(spark, root, session)
    current = aggregate(spark, session, params, max_files)
    answers = Answers(final_answers(current, menu_items, users, params), current["stages"])
    if only_complete:
        done = spark.createDataFrame([(c,) for c in complete], _CLOSED_SCHEMA)
        kept = {name: keep_referenced(answer, done, [CLIENT]) for name, answer in answers.items()}
        answers = Answers(kept, keep_referenced(answers.stages, done, [CLIENT]))
    if out:
        for name, answer in [*answers.items(), ("stages", answers.stages)]:
            write_result(answer, name, out)
    compact_landing(spark, session, compact_epochs)
    if complete:
        close_clients(spark.createDataFrame([(c,) for c in complete], _CLOSED_SCHEMA), session)
    if close is not None:
        close_clients(close, session)
    return answers
