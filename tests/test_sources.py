"""CSV files, landing copy and result sets."""

import random

import pytest
from pyspark.sql import functions as F

from tests import data
from tests.conftest import plan, rows, write_lines
from tillmetrics import sources as src
from tillmetrics.functions import in_hours, in_years
from tillmetrics.schemas import DATASETS, MENU_ITEMS, TRANSACTION_ITEMS, TRANSACTIONS, USERS


def test_schema_and_header(spark, folder):
    root = data.write_client(folder("in"))
    for kind, dataset in DATASETS.items():
        df = src.read_dataset(spark, root, kind, client_id="c")
        assert [(f.name, f.dataType) for f in df.schema.fields][: len(dataset.columns)] == list(dataset.columns)
        assert df.columns[-1] == "client_id"
    assert src.read_dataset(spark, root, MENU_ITEMS, client_id="c").count() == 4
    assert src.read_dataset(spark, root, TRANSACTIONS, client_id="c").count() == 26


def test_months_select_files(spark, folder):
    root = data.write_client(folder("in"))
    january = src.read_dataset(spark, root, TRANSACTIONS, months=[202401], client_id="c")
    assert january.count() == len(data.TRANSACTIONS_JAN)
    assert len(january.inputFiles()) == 1
    for bad in ([], ["2024-01"], ["20241"]):
        with pytest.raises(ValueError):
            src.read_dataset(spark, root, TRANSACTIONS, months=bad, client_id="c")


def test_other_files_are_not_read(spark, folder):
    root = data.write_client(folder("in"))
    for name in ("transactions_2024.csv", "my_transactions_202401.csv", "transactions_202401.csv.bak", "notes.txt"):
        write_lines(f"{root}/{name}", data.TRANSACTION_HEADER, data.TRANSACTIONS_JAN)
    assert src.read_dataset(spark, root, TRANSACTIONS, client_id="c").count() == 26


def test_quotes_are_ordinary_characters(spark, folder):
    root = folder("in")
    write_lines(f"{root}/menu_items.csv", data.MENU_HEADER, ['1,"Big" one,c,1,F,,', '2,"open,c,1,F,,', "3,\\,c,1,F,,"])
    names = rows(src.read_dataset(spark, root, MENU_ITEMS, client_id="c"), "item_id", "item_name")
    assert names == [(1, '"Big" one'), (2, '"open'), (3, "\\")]


def test_windows_line_ends_blank_lines_and_accents(spark, folder):
    root = folder("in")
    write_lines(f"{root}/menu_items.csv", data.MENU_HEADER + "\r", ["1,Té helado,c,1,F,,\r", "", "2,x,c,1,F,,x\r"])
    got = rows(src.read_dataset(spark, root, MENU_ITEMS, client_id="c"), "item_id", "item_name", "available_to")
    assert got == [(1, "Té helado", None), (2, "x", "x")]


@pytest.mark.parametrize("columns", [["is_bad_row"], ["store_id", "is_bad_row"], ["transaction_id", "is_bad_row"]])
def test_bad_rows_are_flagged_whatever_is_selected(spark, folder, columns):
    root = data.write_client(folder("in"))
    df = src.read_dataset(spark, root, TRANSACTIONS, client_id="c", bad_rows="flag")
    assert df.select(*columns).filter("is_bad_row").count() == 2
    flagged = rows(df.filter("is_bad_row"), "transaction_id", "store_id", "final_amount")
    assert flagged == [("long", "3", 200.5), ("short", "3", None)]


def test_flagged_and_padded_reads_agree(spark, folder):
    root = data.write_client(folder("in"))
    for kind in DATASETS:
        flagged = src.read_raw(spark, root, kind, client_id="c", bad_rows="flag").drop("is_bad_row").na.fill("")
        padded = src.read_raw(spark, root, kind, client_id="c").na.fill("")
        assert rows(flagged, *padded.columns) == rows(padded)


NASTY = {
    "int": ["5", "", "x", "5.0", "-3", "99999999999"],
    "bigint": ["5", "5.0", "", "x", "nan", "1e3", "-7.9"],
    "double": ["5", "5.5", "", "x", "nan", "inf", "1e3", "9d", "0x1", "-.5", " 7 "],
    "date": ["1990-01-02", "1990-1-2", "", "x", "1990-13-01", "1990-02-30"],
    "timestamp_ntz": ["2024-01-05 07:03:00", "2024-1-5 7:3:0", "", "x", "2024-01-05", "2024-13-05 00:00:00",
                      "2024-01-05T07:03:00", "2024-01-05 07:03", "2024-02-30 07:03:00", "2025-01-05 25:00:00"],
    "string": ["a", "", "é", '"q', "with space"],
}


@pytest.mark.parametrize("kind", list(DATASETS))
def test_scan_and_text_conversion_agree(spark, folder, kind):
    """Whatever is in one field, the scan and the expressions read it alike and keep the other fields."""
    root, rng = folder("in"), random.Random(11)
    types = [t.simpleString() for _, t in DATASETS[kind].columns]
    lines = [",".join(rng.choice(NASTY[t]) for t in types) for _ in range(600)]
    lines += [line.rsplit(",", rng.randrange(1, 3))[0] for line in lines[:50]] + [line + ",x,y" for line in lines[:50]]
    lines = [line for line in lines if line.strip(",")]
    name = f"{kind}.csv" if kind == MENU_ITEMS else f"{kind}_202401.csv"
    write_lines(f"{root}/{name}", ",".join(DATASETS[kind].names), lines)
    by_scan = src.read_dataset(spark, root, kind, client_id="c")
    by_text = src.typed(src.read_raw(spark, root, kind, client_id="c"), kind)
    flagged = src.read_dataset(spark, root, kind, client_id="c", bad_rows="flag").drop("is_bad_row")
    text = lambda df: df.select(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in by_scan.columns])
    expected = rows(text(by_text))
    assert len(expected) == len(lines)
    assert rows(text(by_scan)) == expected
    assert rows(text(flagged)) == expected
    if "created_at" in by_scan.columns:
        chosen = in_years(F.col("created_at"), [2024]) & in_hours(F.col("created_at"), 6, 22)
        assert rows(text(by_scan.filter(chosen))) == rows(text(by_text.filter(chosen)))
        assert by_scan.filter(chosen).count() > 0


def test_client_from_folder_stays_text(spark, folder):
    root = data.write_clients(folder("in"), "1", "client_2")
    df = src.read_dataset(spark, root, TRANSACTIONS)
    assert rows(df.select("client_id").distinct()) == [("1",), ("client_2",)]


def test_dataset_kind_from_name(spark):
    names = {
        "menu_items.csv": MENU_ITEMS,
        "users_202401.csv": USERS,
        "transaction_items_202401.csv": TRANSACTION_ITEMS,
        "transactions_202401.csv": TRANSACTIONS,
        "transaction_items_and_menu_items.csv": MENU_ITEMS,
        "other.csv": None,
    }
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert {r["name"]: r["dataset"] for r in src.with_dataset_kind(df, "name").collect()} == names


def test_lines_of_a_mixed_folder(spark, folder):
    root = data.write_clients(folder("in"), "a", "b")
    counts = src.with_dataset_kind(src.read_lines(spark, root)).groupBy("client_id", "dataset").count()
    per_client = {TRANSACTIONS: 26, TRANSACTION_ITEMS: 11, MENU_ITEMS: 4, USERS: 5}
    assert {(r[0], r[1]): r[2] for r in counts.collect()} == {
        (client, kind): n for client in "ab" for kind, n in per_client.items()
    }


def test_last_row_of_a_file_wins_across_splits(spark, folder):
    """A file large enough for several splits: the order inside the file decides."""
    root = folder("in")
    lines = [f"{i % 7},female,1990-01-{1 + i % 28:02d},2023-07-01 08:13:{i % 60:02d}" for i in range(4000)]
    write_lines(f"{root}/users_202401.csv", data.USER_HEADER, lines)
    write_lines(f"{root}/users_202402.csv", data.USER_HEADER, ["3,male,2001-01-01,2023-06-12 17:25:41"])
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "4096")
    try:
        users = src.read_dimension(spark, root, USERS, client_id="c")
        got = rows(users.selectExpr("user_id", "cast(birthdate as string)"))
    finally:
        spark.conf.unset(key)
    last = {int(line.split(",")[0]): line.split(",")[2] for line in lines}
    last[3] = "2001-01-01"
    assert got == sorted(last.items(), key=repr)


def test_scan_reads_only_the_needed_columns(spark, folder):
    root = data.write_client(folder("in"))
    df = src.read_dataset(spark, root, TRANSACTIONS, client_id="c").select("store_id")
    assert "ReadSchema: struct<store_id:string>" in plan(df)


def test_landing_prunes_folders_and_keeps_undated_rows(spark, folder):
    root, path = data.write_client(folder("in")), folder("landing")
    rows_in = src.read_dataset(spark, root, TRANSACTIONS, client_id="c")
    src.land(rows_in, path)
    back = src.read_landed(spark, path, TRANSACTIONS)
    as_text = [F.col(name).cast("string") for name in rows_in.columns]  # NaN differs from itself
    assert rows(back.select(*as_text)) == rows(rows_in.select(*as_text))
    assert back.filter("created_at IS NULL").count() == 3
    pruned = src.read_landed(spark, path, TRANSACTIONS, years=[2025], months=[3])
    assert pruned.count() == 4
    assert "PartitionFilters: [year#" in plan(pruned) or "PartitionFilters: [isnotnull(" in plan(pruned)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_results_are_replaced_per_client(spark, folder, fmt):
    root = folder("out")
    make = lambda *r: spark.createDataFrame(r, "client_id string, v int")
    src.write_result(make(("a", 1), ("a", 2), ("b", 3)), "q", root, fmt)
    src.write_result(make(("a", 9)), "q", root, fmt)
    schema = make(("a", 1)).schema
    assert rows(src.read_result(spark, schema, "q", root, fmt), "client_id", "v") == [("a", 9), ("b", 3)]
    src.clear_result(spark, schema, "q", root, "b", fmt)
    assert rows(src.read_result(spark, schema, "q", root, fmt), "client_id", "v") == [("a", 9)]


def test_preview_keeps_the_stated_order(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("v"))
    first = src.preview(df, [F.desc("v")], 3)
    assert [r[0] for r in first.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in plan(first)


def test_compact_results_hold_the_same_rows(spark, folder):
    root = folder("out")
    df = spark.range(500).select(F.when(F.col("id") < 400, "a").otherwise("b").alias("client_id"), "id")
    src.write_result(df.repartition(8), "q", root, compact=True)
    back = src.read_result(spark, df.schema, "q", root)
    assert rows(back, "client_id", "id") == rows(df)
    assert len(back.inputFiles()) <= 4


def test_rejected_rows_keep_their_text(spark, folder):
    root = data.write_client(folder("in"))
    raw = src.read_raw(spark, root, TRANSACTIONS, client_id="c")
    bad = src.rejected(raw, TRANSACTIONS, ["created_at", "final_amount"])
    assert rows(bad, "transaction_id", "reason") == [
        ("abc", "final_amount"),
        ("baddate", "created_at"),
        ("dateonly", "created_at"),
        ("java", "final_amount"),
        ("noamount", "final_amount"),
        ("short", "created_at"),
    ]
    assert bad.filter("transaction_id = 'java'").first()["final_amount"] == "99d"
