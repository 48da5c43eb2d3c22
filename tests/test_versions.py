"""Versioned sets: what readers see after loads of slices, crashes and removals."""

import pytest
from pyspark.sql import functions as F

from tests import data
from tests.conftest import rows, write_lines
from tests.test_questions import check
from tillmetrics import sources as src
from tillmetrics.__main__ import run
from tillmetrics.compare import answered, verdicts
from tillmetrics.schemas import TRANSACTIONS
from tillmetrics.sources.shared_files import SharedFiles
from tillmetrics.sources.versions import VersionedSet

SCHEMA = "client_id string, month string, v int"


def make(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def versioned(spark, path):
    return VersionedSet(spark, path, ["client_id", "month"])


def seen(spark, path):
    return rows(versioned(spark, path).read(make(spark, ("a", "1", 1)).schema), "client_id", "month", "v")


def test_loads_replace_their_slices(spark, folder):
    path = folder("set")
    assert seen(spark, path) == []
    versioned(spark, path).load(make(spark, ("a", "1", 1), ("a", "2", 1), ("b", "1", 1), ("b", None, 1)))
    versioned(spark, path).load(make(spark, ("a", "2", 2)), {"client_id": ["a"], "month": ["2"]})
    assert seen(spark, path) == sorted([("a", "1", 1), ("a", "2", 2), ("b", "1", 1), ("b", None, 1)], key=repr)
    versioned(spark, path).load(make(spark, ("c", "1", 3)), None)  # the clients it holds
    versioned(spark, path).load(None, {"month": ["1"]})
    assert seen(spark, path) == sorted([("a", "2", 2), ("b", None, 1)], key=repr)
    versioned(spark, path).load(make(spark, ("a", "1", 4)), {"client_id": ["a", "b"]})
    assert seen(spark, path) == [("a", "1", 4)]
    versioned(spark, path).load(make(spark, ("d", "1", 5)))
    assert seen(spark, path) == [("d", "1", 5)]
    assert [name for name in SharedFiles(spark).names(path) if name.startswith("v")] == ["v6"]


def test_a_crash_before_the_manifest_shows_the_old_version(spark, folder, monkeypatch):
    path = folder("set")
    versioned(spark, path).load(make(spark, ("a", "1", 1)))

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(SharedFiles, "publish", lost)
    with pytest.raises(RuntimeError):
        versioned(spark, path).load(make(spark, ("a", "1", 2)))
    monkeypatch.undo()
    assert seen(spark, path) == [("a", "1", 1)]
    versioned(spark, path).load(make(spark, ("b", "1", 3)), {"client_id": ["b"]})
    assert seen(spark, path) == [("a", "1", 1), ("b", "1", 3)]
    versioned(spark, path).load(make(spark, ("b", "1", 4)))  # a load of everything clears up
    assert seen(spark, path) == [("b", "1", 4)]
    assert [name for name in SharedFiles(spark).names(path) if name.startswith("v")] == ["v4"]


def test_two_loads_at_once_keep_both_slices(spark, folder):
    path = folder("set")
    first, second = versioned(spark, path), versioned(spark, path)
    taken = first.current
    # The second commits while the first holds an old manifest in its hands.
    state = {"raced": False}

    def racing():
        found = taken()
        if not state["raced"]:
            state["raced"] = True
            second._commit(50, {"client_id": ["b"]}, False, 0)
        return found

    first.current = racing
    first._commit(49, {"client_id": ["a"]}, False, 0)
    scopes = [load["scope"] for load in versioned(spark, path).current()[1]]
    assert {"client_id": ["a"]} in scopes


def test_readers_that_have_begun_can_finish(spark, folder):
    path = folder("set")
    versioned(spark, path).load(make(spark, ("a", "1", 1)), keep=1)
    before = versioned(spark, path).read(make(spark, ("a", "1", 1)).schema)
    versioned(spark, path).load(make(spark, ("a", "1", 2)), keep=1)
    assert rows(before, "v") == [(1,)] and seen(spark, path) == [("a", "1", 2)]
    versioned(spark, path).load(make(spark, ("a", "1", 3)), keep=1)
    assert [name for name in SharedFiles(spark).names(path) if name.startswith("v")] == ["v2", "v3"]


def test_files_appear_once(spark, folder):
    files, path = SharedFiles(spark), f"{folder('f')}/x/1"
    assert files.publish(path, "é") and not files.publish(path, "other")
    assert files.read(path) == "é" and files.names(path.rsplit("/", 1)[0]) == ["1"]


def test_landing_casts_and_refuses(spark, folder):
    path = folder("landing")
    few = spark.createDataFrame([("c", 7, 5, 9.5)], "client_id string, store_id int, transaction_id long, final_amount double")
    with pytest.raises(ValueError):
        src.land(few, path)
    src.land(few.withColumn("created_at", F.lit("2024-01-05 06:00:00").cast("timestamp_ntz")), path)
    got = src.read_landed(spark, path, TRANSACTIONS).first()
    assert (got.store_id, got.transaction_id, got.final_amount, got.voucher_id) == ("7", "5", 9.5, None)


def test_clients_that_left_the_input_leave_the_landing(spark, folder):
    both, one = data.write_clients(folder("in"), "client_1", "client_2"), data.write_clients(folder("in"), "client_1")
    landing, out = folder("landing"), folder("out")
    run(spark, both, out, landing=landing)
    written = run(spark, one, out, landing=landing)
    check(written)
    assert rows(written["q3"].select("client_id").distinct()) == [("client_1",)]


def test_months_of_files_are_replaced_alone(spark, folder):
    root, landing, out = data.write_clients(folder("in"), "client_1"), folder("landing"), folder("out")
    run(spark, root, out, landing=landing)
    extra = [data.transaction("extra", 1, "10", "100", "2024-03-01 10:00:00")]  # a date of another month than the file's
    write_lines(f"{root}/client_id=client_1/transactions_202406.csv", data.TRANSACTION_HEADER, extra)
    for _ in range(2):
        run(spark, root, out, landing=landing, months=["202406"])
        ids = {r["transaction_id"] for r in src.read_landed(spark, f"{landing}/{TRANSACTIONS}", TRANSACTIONS).collect()}
        assert "extra" in ids and "june" not in ids and "open" in ids


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_missing_and_empty_answers_are_compared(spark, folder, fmt):
    root, out = data.write_clients(folder("in"), "client_1", "client_2"), folder("out")
    run(spark, root, out, fmt=fmt, with_users=False)
    queries = ("q1", "q2", "q3", "q4")
    assert answered(spark, out, queries) == ["q1", "q2", "q3"]
    report = verdicts(spark, out, ["client_1", "client_2", "nobody"], queries, fmt).collect()
    assert len(report) == 9 and all(r.identical == (r.right_client != "nobody") for r in report)
    empty = folder("empty")
    src.write_result(src.read_result(spark, spark.createDataFrame([], "client_id string, year int, semester int, store_id string, tpv double").schema, "q3", out, fmt).limit(0), "q3", empty, fmt, whole=True)
    assert [tuple(r)[3:] for r in verdicts(spark, empty, ["a", "b"], queries, fmt).collect()] == [(0, 0, 0, True)]


def test_files_delivered_twice_count_once_in_a_batch_run(spark, folder):
    root, out = data.write_clients(folder("in"), "client_1"), folder("out")
    data.write_client(f"{root}/client_id=client_1/again")
    check(run(spark, root, out))
    extra = [data.transaction("extra", 1, "10", "100", "2024-03-01 10:00:00")]
    write_lines(f"{root}/client_id=client_1/other/transactions_202406.csv", data.TRANSACTION_HEADER, extra)
    ids = [r["transaction_id"] for r in run(spark, root, out)["q1"].collect()]
    assert ids.count("extra") == 1 and ids.count("open") == 1
