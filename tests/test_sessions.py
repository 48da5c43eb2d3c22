"""Sessions in several calls: snapshots, single reads, announcements, counters."""


import pytest
from pyspark.sql import functions as F

from tests import data
from tests.conftest import plan, rows, write_lines
from tests.test_streaming import messages, only, session_answers
from tests.test_questions import check
from tillmetrics.__main__ import load, run
from tillmetrics.operators import count_by, diff_sample_pairs, pairwise_verdicts
from tillmetrics.params import Params
from tillmetrics.plans import all_results, transaction_funnel, yearly_best_month
from tillmetrics.schemas import TRANSACTIONS
from tillmetrics.sources import read_dataset
from tillmetrics.sources.shared_files import SharedFiles
from tillmetrics.streaming import Session, current_totals, finish, read_session, start_totals, stream_messages
from tillmetrics.streaming import running


def totals_of(spark, root, work, kept):
    totals = count_by(stream_messages(spark, root, TRANSACTIONS, max_files=1), ["client_id"], "n")

    def go():
        finish(start_totals(totals, ["client_id"], f"{work}/out", f"{work}/checkpoint", 1, kept))

    return totals.schema, go


def epochs(spark, folder):
    return [int(name.split("=")[1]) for name in SharedFiles(spark).names(folder) if name.startswith("epoch=")]


@pytest.mark.parametrize("kept", [0, 1])
def test_covered_generations_are_removed(spark, folder, kept):
    root, work = folder("in"), folder("work")
    messages(root)
    schema, go = totals_of(spark, root, work, kept)
    go()
    out = f"{work}/out"
    marked = running.snapshot_epochs(spark, out)
    assert len(marked) == kept + 1 and epochs(spark, f"{out}/snapshots") == marked
    assert min(epochs(spark, f"{out}/changes")) > marked[-1] - kept - 1
    assert rows(current_totals(spark, schema, ["client_id"], out)) == [("c", 3), ("d", 1)]


def test_a_reader_that_has_begun_finishes(spark, folder):
    root, work = folder("in"), folder("work")
    messages(root)
    schema, go = totals_of(spark, root, work, 3)
    go()
    before = current_totals(spark, schema, ["client_id"], f"{work}/out")
    write_lines(f"{root}/client_id=d/m2", None, [data.transaction("b", 1, "1", "1", "2024-02-01 10:00:00")])
    go()
    assert rows(before) == [("c", 3), ("d", 1)]
    assert rows(current_totals(spark, schema, ["client_id"], f"{work}/out")) == [("c", 3), ("d", 2)]


def test_a_snapshot_without_its_mark_is_not_read(spark, folder, monkeypatch):
    root, work = folder("in"), folder("work")
    messages(root)
    schema, go = totals_of(spark, root, work, 3)

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(SharedFiles, "publish", lost)
    with pytest.raises(Exception):
        go()
    monkeypatch.undo()
    assert running.snapshot_epochs(spark, f"{work}/out") == []
    go()
    assert rows(current_totals(spark, schema, ["client_id"], f"{work}/out")) == [("c", 3), ("d", 1)]


def announce(root, client, batches):
    lines = [f"{dataset},{number}" for dataset, number in batches.items()]
    write_lines(f"{root}/client_id={client}/announced.csv", "dataset,batches", lines)


def test_announced_clients_close_by_themselves(spark, folder):
    root, work = data.write_clients(folder("in"), "client_1", "client_2"), folder("work")
    announce(root, "client_1", {"transactions": 2, "transaction_items": 1})
    announce(root, "client_2", {"transactions": 3})
    first = session_answers(spark, root, work, only_complete=True)
    check(first)
    assert rows(first.stages.select("client_id")) == [("client_1",)]
    extra = [data.transaction("extra", 1, "10", "100", "2024-02-01 10:00:00")]
    for client in ("client_1", "client_2"):
        write_lines(f"{root}/client_id={client}/transactions_202402.csv", data.TRANSACTION_HEADER, extra)
    second = session_answers(spark, root, work)
    check(only(second, "client_1"))
    assert only(second, "client_2")["q1"].filter("transaction_id = 'extra'").count() == 1


def test_stage_counters_equal_the_batch_funnel(spark, folder):
    root, work, out = data.write_clients(folder("in"), "client_1", "client_2"), folder("work"), folder("out")
    data.write_client(f"{root}/client_id=client_1/again")
    answers = session_answers(spark, root, work, max_files=2, out=out)
    batch = transaction_funnel(read_dataset(spark, data.write_clients(folder("in"), "client_1", "client_2"), TRANSACTIONS))
    assert rows(answers.stages, *batch.columns) == rows(batch)
    assert rows(session_answers(spark, root, work).stages, *batch.columns) == rows(batch)
    assert spark.read.parquet(f"{out}/stages").count() == 2


def test_staged_rows_are_published_by_a_rename(spark, folder):
    root, work = data.write_clients(folder("in"), "client_1"), folder("work")
    check(session_answers(spark, root, work))
    landing = Session(work).landing
    assert SharedFiles(spark).names(f"{landing}/_staged") == []
    # The hashes that fingerprints were made of stand in the landed files: they were not written twice.
    assert {"_file", "_mark0"} <= set(spark.read.parquet(f"{landing}/{TRANSACTIONS}").columns)


def test_landed_epochs_are_compacted(spark, folder, monkeypatch):
    root, work = data.write_clients(folder("in"), "client_1"), folder("work")
    session = Session(work)
    check(session_answers(spark, root, work, max_files=1, compact_epochs=2))
    assert epochs(spark, f"{session.landing}/{TRANSACTIONS}") == []
    ids = rows(read_session(spark, session, TRANSACTIONS), "transaction_id")
    assert len(ids) == 26
    extra = [data.transaction("extra", 1, "10", "100", "2024-02-01 10:00:00")]
    write_lines(f"{root}/client_id=client_1/transactions_202402.csv", data.TRANSACTION_HEADER, extra)
    # The archive counts the epoch, then the driver is lost before the epoch is removed.
    remove = SharedFiles.delete

    def lost(self, path):
        if "epoch=" in path and self.exists(path):
            raise RuntimeError("driver lost")
        remove(self, path)

    monkeypatch.setattr(SharedFiles, "delete", lost)
    with pytest.raises(Exception):
        session_answers(spark, root, work, compact_epochs=1)
    monkeypatch.undo()
    assert len(rows(read_session(spark, session, TRANSACTIONS), "transaction_id")) == 27
    answers = session_answers(spark, root, work, compact_epochs=1)
    assert answers["q1"].filter("transaction_id = 'extra'").count() == 1
    assert len(rows(read_session(spark, session, TRANSACTIONS), "transaction_id")) == 27


def test_parameters_in_another_order_are_the_same(spark, folder):
    root, work = data.write_clients(folder("in"), "client_1"), folder("work")
    session_answers(spark, root, work, params=Params(years=(2024, 2025)))
    session_answers(spark, root, work, params=Params(years=(2025, 2024)))


def test_facts_are_parsed_once(spark, folder):
    root, out = data.write_client(folder("in")), folder("out")
    for name, answer in run(spark, root, out, client_id="c").items():
        assert answer.count() >= 0, name
    assert not any(name.startswith("_stage") for name in SharedFiles(spark).names(out))
    landed = all_results(*load(spark, root, client_id="c", landing=folder("landing")))
    assert all("Scan csv" not in plan(landed[name]) for name in ("q1", "q3"))
    assert "Scan csv" in plan(landed["q2"])  # the menu


def test_leaders_are_found_without_sorting(spark, folder):
    root = data.write_client(folder("in"))
    q2 = all_results(*load(spark, root, client_id="c"))["q2"]
    tree = plan(q2).split("\n\n")[0]
    # What sorts is the last row of each item asked for, after the semi join with the leaders.
    assert tree.count("HashAggregate") >= 4
    totals = spark.createDataFrame([("c", 2024, 1, 5, 3, 100), ("c", 2024, 1, None, 3, 200)], "client_id string, year int, month int, item_id bigint, sold_count bigint, total_cents bigint")
    from tillmetrics.plans import rank_items

    menu = spark.createDataFrame([("c", 5, "five")], "client_id string, item_id bigint, item_name string")
    ranked = rank_items(totals, menu)
    assert "SortAggregate" not in plan(ranked) and "SortAggregate" not in plan(yearly_best_month(ranked))
    row = ranked.first()
    assert (row.top_count_item_id, row.top_count_item_name, row.top_sum_item_id, row.top_sum) == (5, "five", None, 2.0)


def test_extreme_measures_keep_their_order(spark):
    from tillmetrics.operators import leader_of

    values = [-(10**17), -1, 0, 1, 10**17]
    ids = [-(2**63), -1, 0, 7, 2**63 - 1, None]
    df = spark.createDataFrame([(m, i) for m in values for i in ids], "m bigint, i bigint")
    for top in values:
        row = df.filter(F.col("m") <= top).agg(leader_of("m", "i").alias("l")).first()["l"]
        assert (row.m, row.i) == (top, -(2**63))
    only_null = df.filter("i is null").agg(leader_of("m", "i").alias("l")).first()["l"]
    assert (only_null.m, only_null.i) == (10**17, None)
    highest = df.filter(f"i is null or i = {2**63 - 1}").agg(leader_of("m", "i").alias("l")).first()["l"]
    assert (highest.m, highest.i) == (10**17, 2**63 - 1)


def test_two_hundred_unlike_clients(spark):
    """Nearly equal clients, each lacking another row, and some with rows of their own."""
    clients = [f"c{k}" for k in range(200)]
    df = spark.range(200 * 60).select(
        F.concat(F.lit("c"), (F.col("id") % 200).cast("string")).alias("client_id"), F.floor(F.col("id") / 200).alias("v"),
        (F.col("id") % 200).alias("k"),
    )
    df = df.filter(F.col("v") != F.col("k") % 60).withColumn("v", F.when(F.col("k") < 5, F.col("v") * 1000 + F.col("k")).otherwise(F.col("v")))
    got = {(r.left_client, r.right_client): r.differing_rows for r in pairwise_verdicts(df.drop("k"), clients).collect()}
    assert len(got) == 200 * 199 // 2
    bags = {c: set() for c in clients}
    for row in df.collect():
        bags[row.client_id].add(row.v)
    assert all(n == len(bags[a] ^ bags[b]) for (a, b), n in got.items())


def test_samples_of_each_pair_tell_what_remains(spark):
    df = spark.createDataFrame([("a", k) for k in range(12)] + [("b", 0), ("b", 0)] + [("c", k) for k in range(12)], "client_id string, v int")
    got = rows(diff_sample_pairs(df, ["a", "b", "c"], 3), "left_client", "right_client", "place", "v", "left_copies", "right_copies", "remaining")
    assert got == [("a", "b", k + 1, k, 1, 2 if k == 0 else 0, 9) for k in range(3)] + [("b", "c", k + 1, k, 2 if k == 0 else 0, 1, 9) for k in range(3)]
