"""Expressions against plain Python answers."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan
from tillmetrics import functions as fn


def one(spark, values, type_name, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
    return [row[1] for row in sorted(df.select("i", expression(F.col("v")).alias("r")).collect())]


TIMES = {
    "2024-01-05 07:03:00": dt.datetime(2024, 1, 5, 7, 3),
    "2024-1-5 7:3:0": dt.datetime(2024, 1, 5, 7, 3),
    "2024-02-29 00:00:00": dt.datetime(2024, 2, 29),
    "2023-02-29 00:00:00": None,
    "2024-13-01 00:00:00": None,
    "2024-01-05 24:00:00": None,
    "2024-01-05 07:03:60": None,
    "2024-01-05": None,
    "2024-01-05T07:03:00": None,
    "2024-01-05 07:03": None,
    "2024-01-05 07:03:00.5": None,
    "2024-01-05 07:03:00Z": None,
    " 2024-01-05 07:03:00": None,
    "": None,
    "abc": None,
    None: None,
}
NUMBERS = {
    "75.0": 75.0,
    " 75 ": 75.0,
    "-5": -5.0,
    "+.5": 0.5,
    "5.": 5.0,
    "1e3": 1000.0,
    "inf": math.inf,
    "12d": None,
    "12f": None,
    "0x1p3": None,
    "1,5": None,
    "": None,
    "abc": None,
    None: None,
}
IDS = {"10.0": 10, "10": 10, "10.9": 10, "-1.5": -1, "nan": None, "inf": None, "": None, "x": None, None: None}


def test_timestamps(spark):
    assert one(spark, list(TIMES), "string", fn.to_timestamp) == list(TIMES.values())


def test_timestamps_agree_with_strptime(spark):
    texts = [t for t in TIMES if t]

    def python(text):
        try:
            return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
        except ValueError:
            return None

    assert one(spark, texts, "string", fn.to_timestamp) == [python(t) for t in texts]


def test_numbers(spark):
    assert one(spark, list(NUMBERS), "string", fn.to_number) == list(NUMBERS.values())
    assert math.isnan(one(spark, ["nan"], "string", fn.to_number)[0])


def test_ids(spark):
    assert one(spark, list(IDS), "string", fn.to_id) == list(IDS.values())


def test_blank_is_missing(spark):
    assert one(spark, ["a", "", "  ", None], "string", fn.non_blank) == ["a", None, None, None]


def test_amount_predicates(spark):
    values = [75.0, 74.99, 0.0, -5.0, math.nan, None, math.inf]
    at_least = one(spark, values, "double", lambda c: fn.at_least(c, 75))
    assert at_least == [True, False, False, False, False, None, True]
    positive = one(spark, values, "double", fn.positive)
    assert positive == [True, True, False, False, False, None, True]
    assert one(spark, values, "double", fn.is_number) == [True, True, True, True, False, False, True]


def test_cents_are_exact(spark):
    values = [0.1, 0.2, 1.005, 19.99, -0.01, 1e12 + 0.01, math.nan, math.inf, None]
    cents = one(spark, values, "double", fn.to_cents)
    assert cents == [10, 20, 100, 1999, -1, 10**14 + 1, None, None, None]


def test_sum_of_cents_does_not_drift(spark):
    df = spark.range(100000).select(F.lit(0.1).alias("v"))
    assert df.agg(fn.units(fn.total_cents(F.col("v")))).first()[0] == 10000.0


def instants(*texts):
    return [dt.datetime.fromisoformat(text) for text in texts]


def test_years(spark):
    values = instants("2023-12-31 23:59:59", "2024-01-01", "2025-12-31 23:59:59", "2026-01-01", "2027-05-05")
    inside = one(spark, values, "timestamp_ntz", lambda c: fn.in_years(c, [2025, 2024, 2027]))
    assert inside == [False, True, True, False, True]
    assert one(spark, values, "timestamp_ntz", lambda c: fn.in_years(c, [])) == [False] * 5


def test_hours(spark):
    values = instants("2024-01-01 05:59:59", "2024-01-01 06:00:00", "2024-01-01 22:59:59", "2024-01-01 23:00:00")
    inside = one(spark, values, "timestamp_ntz", lambda c: fn.in_hours(c, 6, 22))
    assert inside == [False, True, True, False]


def test_semesters(spark):
    values = instants("2024-06-30 23:59:59", "2024-07-01", "2025-01-01", "2025-12-31", "2026-03-01")
    assert one(spark, values, "timestamp_ntz", fn.semester) == [1, 2, 1, 2, 1]
    chosen = one(spark, values, "timestamp_ntz", lambda c: fn.in_semesters(c, ["semester.2024-2", "2025-1"]))
    assert chosen == [False, True, True, False, False]
    with pytest.raises(ValueError):
        fn.in_semesters(F.col("v"), ["2024-3"])


def test_labels(spark):
    row = spark.range(1).select(
        fn.semester_key(F.lit(2024), F.lit(1)), fn.year_month_label(F.lit(2024), F.lit(3))
    )
    assert tuple(row.first()) == ("semester.2024-1", "2024-3")


def test_fingerprints(spark):
    df = spark.createDataFrame(
        [("x", "s", "c"), ("x", "s", "c"), ("x", "t", "c"), ("x", "s", "d"), ("y", "s", "c"), (None, "s", "c")],
        "content string, sender string, client string",
    )
    keys = [r[0] for r in df.select(fn.batch_fingerprint(F.col("content"), F.col("sender"), F.col("client"))).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == 5


def test_year_filter_reaches_the_scan(spark, folder):
    path = folder("t")
    spark.range(10).select(F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts")).write.parquet(path)
    filtered = spark.read.parquet(path).filter(fn.in_years(F.col("ts"), [2024, 2025]))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00), LessThan(ts,2026-01-01T00:00)" in plan(filtered)
