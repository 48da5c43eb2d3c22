"""The four questions on CSV input with edge rows, against answers worked out by hand."""

import pytest

from tests import data
from tests.conftest import plan, rows, write_lines
from tillmetrics import Params
from tillmetrics.__main__ import load, parse_args, run, run_incremental, show
from tillmetrics.compare import verdicts
from tillmetrics.plans import all_results, transaction_funnel, yearly_best_month
from tillmetrics.sources import read_dataset


def check(results):
    assert {row[0] for row in rows(results["q1"], "transaction_id")} == data.Q1_IDS
    q2 = results["q2"].drop("client_id")
    assert rows(q2) == sorted(data.Q2, key=repr)
    q3 = rows(results["q3"], "year", "semester", "store_id", "tpv")
    assert q3 == sorted(((y, s, store, pytest.approx(v)) for y, s, store, v in data.Q3), key=repr)
    q4 = results["q4"].selectExpr("store_id", "user_id", "count", "cast(birthday as string)")
    assert rows(q4) == sorted(data.Q4, key=repr)


def test_one_client(spark, folder):
    root = data.write_client(folder("in"))
    results = all_results(*load(spark, root, client_id="client_1"))
    check(results)
    assert rows(results["q1"].select("client_id").distinct()) == [("client_1",)]
    assert set(results["q1"].columns) == {
        "transaction_id", "store_id", "payment_method_id", "voucher_id", "user_id",
        "original_amount", "discount_applied", "final_amount", "created_at", "client_id",
    }


def test_values_of_a_passing_row(spark, folder):
    root = data.write_client(folder("in"))
    row = all_results(*load(spark, root, client_id="c"))["q1"].filter("transaction_id = 'open'").first()
    assert (row["store_id"], row["voucher_id"], row["user_id"], row["final_amount"]) == ("1", 7, 10, 80.0)
    assert str(row["created_at"]) == "2024-01-05 06:00:00"


def test_best_months(spark, folder):
    root = data.write_client(folder("in"))
    q2 = all_results(*load(spark, root, client_id="c"))["q2"]
    best = yearly_best_month(q2)
    assert rows(best, "report", "year", "year_month", "item_name", "value") == data.Q2B


def test_clients_do_not_mix(spark, folder):
    root = data.write_clients(folder("in"), "client_1", "client_2")
    results = all_results(*load(spark, root))
    for client in ("client_1", "client_2"):
        check({name: df.filter(f"client_id = '{client}'") for name, df in results.items()})


def test_written_results_and_landing(spark, folder, capsys):
    root = data.write_clients(folder("in"), "client_1", "client_2")
    landing, out = folder("landing"), folder("out")
    written = run(spark, root, out, landing=landing)
    check({name: df.filter("client_id = 'client_2'") for name, df in written.items()})
    show(written, Params())
    printed = capsys.readouterr().out
    assert printed.count("2024-01-05 06:00:00") == 2 and "top_profit" in printed


def test_without_users_three_questions(spark, folder):
    root = data.write_client(folder("in"))
    results = all_results(*load(spark, root, client_id="c", with_users=False))
    assert list(results) == ["q1", "q2", "q3"]


def test_file_order_does_not_matter(spark, folder):
    root = folder("in")
    shuffled = list(reversed(data.TRANSACTIONS_JAN + data.TRANSACTIONS_JUN))
    write_lines(f"{root}/transactions_202401.csv", data.TRANSACTION_HEADER, shuffled)
    write_lines(f"{root}/transaction_items_202401.csv", data.ITEM_HEADER, list(reversed(data.ITEMS)))
    write_lines(f"{root}/menu_items.csv", data.MENU_HEADER, data.MENU)
    write_lines(f"{root}/users_202401.csv", data.USER_HEADER, data.USERS_JAN + data.USERS_FEB)
    check(all_results(*load(spark, root, client_id="c")))


def test_funnel(spark, folder):
    root = data.write_client(folder("in"))
    counts = transaction_funnel(read_dataset(spark, root, "transactions", client_id="c")).first().asDict()
    assert counts == {
        "client_id": "c",
        "rows_in": 26,
        "dated": 23,
        "in_years": 21,
        "in_hours": 18,
        "priced": 14,
        "high_value": 4,
    }


def test_command_line_arguments():
    args, params = parse_args(["in", "out", "--years", "2020,2021", "--semesters", "2020-2", "--top", "5"])
    assert (args.input, args.output) == ("in", "out")
    assert params == Params(years=(2020, 2021), semesters=("2020-2",), top_n=5)
    assert parse_args(["in", "out"])[1] == Params()
    with pytest.raises(SystemExit):
        parse_args(["in", "out", "--stream", "s", "--landing", "l"])


def test_clients_with_the_same_files_agree(spark, folder):
    root, out = data.write_clients(folder("in"), "client_1", "client_2", "client_3"), folder("out")
    extra = [data.transaction("extra", 1, "10", "100", "2024-02-01 10:00:00")]
    write_lines(f"{root}/client_id=client_3/transactions_202402.csv", data.TRANSACTION_HEADER, extra)
    run(spark, root, out)
    report = {(r["query"], r["left_client"], r["right_client"]): r for r in verdicts(
        spark, out, ["client_1", "client_2", "client_3"]).collect()}
    assert len(report) == 12
    for query in ("q1", "q2", "q3", "q4"):
        assert report[query, "client_1", "client_2"]["identical"]
        assert report[query, "client_1", "client_3"]["identical"] == (query == "q2")
    assert report["q1", "client_2", "client_3"]["differing_rows"] == 1


def test_incremental_run(spark, folder):
    root, out, work = data.write_clients(folder("in"), "client_1"), folder("out"), folder("work")
    check(run_incremental(spark, root, out, work, close=["client_1"]))
    extra = [data.transaction("extra", 1, "10", "100", "2024-02-01 10:00:00")]
    write_lines(f"{root}/client_id=client_1/transactions_202402.csv", data.TRANSACTION_HEADER, extra)
    check(run_incremental(spark, root, out, work))


def test_a_second_run_replaces_the_first(spark, folder):
    """Answers that vanished are gone: for all clients at once, and for one client's session."""
    root, out = data.write_clients(folder("in"), "client_1", "client_2"), folder("out")
    run(spark, root, out)
    fewer = folder("fewer")
    data.write_client(f"{fewer}/client_id=client_1")
    none = Params(years=(1999,))
    own = run(spark, f"{fewer}/client_id=client_1", out, client_id="client_1", params=none)
    for name, df in own.items():
        assert rows(df.select("client_id").distinct()) == [("client_2",)], name
    check({name: df.filter("client_id = 'client_1'") for name, df in run(spark, fewer, out).items()})
    assert spark.read.parquet(f"{out}/q3").select("client_id").distinct().count() == 1


def test_facts_of_q4_are_read_once(spark, folder):
    """The top list is needed twice; its exchange is reused instead of being computed again."""
    root = data.write_client(folder("in"))
    q4 = all_results(*load(spark, root, client_id="c"))["q4"]
    q4.collect()
    final = plan(q4).split("\n\n")[0].split("Initial Plan")[0]
    assert "ReusedExchange" in final
    assert final.count("Scan csv") == 2  # transactions and users


def test_plans_stay_on_the_jvm_and_join_by_key(spark, folder):
    root = data.write_client(folder("in"))
    for name, df in all_results(*load(spark, root, client_id="c")).items():
        for unwanted in ("Cartesian", "NestedLoop", "PythonUDF", "EvalPython"):
            assert unwanted not in plan(df), name
