"""Streams: equal to batch, redelivery, restart, crash in mid-batch, isolation, closed clients."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests import data
from tests.conftest import rows, write_lines
from tests.test_questions import check
from tillmetrics.operators import count_by
from tillmetrics.params import Params
from tillmetrics.schemas import MENU_ITEMS, TRANSACTIONS, USERS
from tillmetrics.sources import read_dimension
from tillmetrics.streaming import (
    Session,
    batch_counts,
    close_clients,
    current_totals,
    finish,
    observed,
    read_epochs,
    run_session,
    start_append,
    start_totals,
    stream_dataset,
    stream_messages,
)
from tillmetrics.streaming import ingest as ingest_module
from tillmetrics.streaming.session import ingest


def dimensions(spark, root):
    return read_dimension(spark, root, MENU_ITEMS), read_dimension(spark, root, USERS, deduplicate=False)


def session_answers(spark, root, work, **options):
    return run_session(spark, root, work, *dimensions(spark, root), **options)


def only(answers, client):
    return {name: df.filter(F.col("client_id") == client) for name, df in answers.items()}


def test_session_equals_batch_for_every_client(spark, folder):
    root = data.write_clients(folder("in"), "client_1", "client_2")
    answers = session_answers(spark, root, folder("work"), max_files=3)
    check(only(answers, "client_1"))
    check(only(answers, "client_2"))


def test_redelivered_files_count_once_even_after_a_restart(spark, folder):
    root, work = data.write_clients(folder("in"), "client_1"), folder("work")
    data.write_client(f"{root}/client_id=client_1/again")
    session_answers(spark, root, work, max_files=2)
    data.write_client(f"{root}/client_id=client_1/later")
    check(session_answers(spark, root, work))
    counts = rows(batch_counts(spark, Session(work)), "client_id", "dataset", "batches")
    assert counts == [("client_1", "transaction_items", 1), ("client_1", "transactions", 2)]


def test_input_in_two_sessions(spark, folder):
    """The second call continues the totals of the first."""
    root, work, parked = data.write_clients(folder("in"), "client_1"), folder("work"), folder("parked")
    Path(parked).mkdir()
    names = ["transactions_202406.csv", "transaction_items_202401.csv"]
    for name in names:
        shutil.move(f"{root}/client_id=client_1/{name}", f"{parked}/{name}")
    first = session_answers(spark, root, work)
    assert first["q2"].count() == 0
    assert first["q3"].filter("store_id = 9").count() == 0
    for name in names:
        shutil.move(f"{parked}/{name}", f"{root}/client_id=client_1/{name}")
    check(session_answers(spark, root, work))


def test_crash_after_the_write_does_not_repeat_rows(spark, folder, monkeypatch):
    root, work = data.write_clients(folder("in"), "client_1"), folder("work")
    original, calls = ingest_module.land, []

    def failing(written, path, partitions):
        original(written, path, partitions)
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("executor lost")

    monkeypatch.setattr(ingest_module, "land", failing)
    with pytest.raises(Exception):
        session_answers(spark, root, work, max_files=1)
    monkeypatch.setattr(ingest_module, "land", original)
    check(session_answers(spark, root, work, max_files=1))


def test_closed_clients_are_ignored(spark, folder):
    root, work = data.write_clients(folder("in"), "client_1", "client_2"), folder("work")
    closed = spark.createDataFrame([("client_1",)], "client_id string")
    session_answers(spark, root, work, close=closed)
    extra = [data.transaction("extra", 1, "10", "100", "2024-02-01 10:00:00")]
    for client in ("client_1", "client_2"):
        write_lines(f"{root}/client_id={client}/transactions_202402.csv", data.TRANSACTION_HEADER, extra)
    answers = session_answers(spark, root, work)
    check(only(answers, "client_1"))
    assert only(answers, "client_2")["q1"].filter("transaction_id = 'extra'").count() == 1


def test_written_answers(spark, folder):
    root, out = data.write_clients(folder("in"), "client_1"), folder("out")
    answers = session_answers(spark, root, folder("work"), out=out)
    check({name: spark.read.schema(df.schema).parquet(f"{out}/{name}") for name, df in answers.items()})


def test_session_without_any_input(spark, folder):
    root = folder("in")
    Path(root).mkdir()
    menu = spark.createDataFrame([], "client_id string, item_id bigint, item_name string")
    answers = run_session(spark, root, folder("work"), menu, None)
    assert {name: df.count() for name, df in answers.items()} == {"q1": 0, "q2": 0, "q3": 0}


def test_same_name_from_another_sender_is_another_batch(spark, folder):
    root = folder("in")
    row = [data.transaction("a", 1, "1", "1", "2024-02-01 10:00:00")]
    for sender in ("s1", "s2"):
        path = f"{root}/client_id=c/sender={sender}/transactions_202402.csv"
        write_lines(path, data.TRANSACTION_HEADER, row)
    session = Session(folder("work"))
    ingest(spark, root, session)
    landed = spark.read.parquet(f"{session.landing}/{TRANSACTIONS}")
    assert rows(landed, "client_id", "transaction_id") == [("c", "a"), ("c", "a")]


def messages(root):
    """Two deliveries of one message, another message, and the same text for another client."""
    first = [data.transaction("a", 1, "1", "1", "2024-02-01 10:00:00"), "short,1"]
    write_lines(f"{root}/client_id=c/m1", None, first)
    write_lines(f"{root}/client_id=c/m2", None, first)
    write_lines(f"{root}/client_id=c/m3", None, first[:1])
    write_lines(f"{root}/client_id=d/m1", None, first[:1])


@pytest.mark.parametrize("key, copies", [("content", 2), ("name", 3)])
def test_messages_are_recognised_by_content_or_name(spark, folder, key, copies):
    root, work = folder("in"), folder("work")
    messages(root)
    stream = stream_messages(spark, root, TRANSACTIONS, key=key, max_files=1)
    finish(start_append(stream, f"{work}/out", f"{work}/checkpoint"))
    found = rows(read_epochs(spark, stream.schema, f"{work}/out"), "client_id", "transaction_id")
    assert found.count(("c", "a")) == copies
    assert found.count(("d", "a")) == 1
    assert found.count(("c", "short")) == copies - 1


@pytest.mark.parametrize("snapshot_every", [1, 2, 100])
def test_messages_into_a_running_total(spark, folder, snapshot_every):
    root, work = folder("in"), folder("work")
    messages(root)
    totals = count_by(stream_messages(spark, root, TRANSACTIONS, max_files=1), ["client_id"], "n")

    def run():
        finish(start_totals(totals, ["client_id"], f"{work}/out", f"{work}/checkpoint", snapshot_every))
        return rows(current_totals(spark, totals.schema, ["client_id"], f"{work}/out"))

    assert run() == [("c", 3), ("d", 1)]
    changes = read_epochs(spark, totals.schema, f"{work}/out/changes")
    assert changes.count() > 2  # the total of client c changed more than once
    snapshots = read_epochs(spark, totals.schema, f"{work}/out/snapshots")
    assert snapshots.select("epoch").distinct().count() == 4 // snapshot_every
    write_lines(f"{root}/client_id=d/m2", None, [data.transaction("b", 1, "1", "1", "2024-02-01 10:00:00")])
    assert run() == [("c", 3), ("d", 2)]


def test_stream_counters(spark, folder):
    root, work = data.write_clients(folder("in"), "client_1"), folder("work")
    stream = observed(stream_dataset(spark, root, TRANSACTIONS), "stage", dated=F.col("created_at").isNotNull())
    seen = []
    query = (
        stream.writeStream.foreachBatch(lambda batch, epoch: seen.append(batch.count()))
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    counters = progress[0]["observedMetrics"]["stage"]
    assert sum(seen) == 26
    assert (counters["rows_in"], counters["dated"]) == (26, 23)


def test_closing_twice_is_harmless(spark, folder):
    session = Session(folder("work"))
    clients = spark.createDataFrame([("a",)], "client_id string")
    close_clients(clients, session)
    close_clients(clients, session)
    from tillmetrics.streaming import closed_clients

    assert rows(closed_clients(spark, session).distinct()) == [("a",)]


def test_other_parameters_are_refused(spark, folder):
    root, work = data.write_clients(folder("in"), "client_1"), folder("work")
    session_answers(spark, root, work, params=Params(min_amount=75.0))
    session_answers(spark, root, work, params=Params(min_amount=75.0, top_n=1))
    with pytest.raises(ValueError, match="another folder"):
        session_answers(spark, root, work, params=Params(min_amount=50.0))


def test_copies_are_listed_and_foreign_names_ignored(spark, folder):
    root, work = data.write_clients(folder("in"), "client_1"), folder("work")
    data.write_client(f"{root}/client_id=client_1/again")
    write_lines(f"{root}/client_id=client_1/old_transactions_backup.csv", "a,b", ["1,2"])
    ingest(spark, root, Session(work))
    assert spark.read.parquet(f"{work}/batches-copies").count() == 3
    names = {row["batch_id"] for row in spark.read.parquet(f"{work}/batches").collect()}
    assert all(name[-10:-4].isdigit() for name in names)
