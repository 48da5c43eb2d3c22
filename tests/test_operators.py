"""Operators against brute force in Python, and the plans they produce."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tillmetrics import operators as op
from tillmetrics.plans import yearly_best_month


@pytest.fixture(scope="module")
def sales(spark):
    """Ties, a hot client with most of the rows, negative amounts."""
    rng = random.Random(7)
    data = [
        ("hot" if rng.random() < 0.7 else f"c{rng.randrange(5)}", rng.randrange(4), rng.randrange(30), rng.randrange(-50, 300) / 4)
        for _ in range(3000)
    ]
    return data, spark.createDataFrame(data, "client_id string, store int, item bigint, amount double")


def grouped(data):
    groups = defaultdict(list)
    for client, store, item, amount in data:
        groups[client, store, item].append(amount)
    return groups


def test_count_and_total(sales):
    data, df = sales
    got = rows(op.count_and_total(df, ["client_id", "store", "item"], F.col("amount")))
    want = [(*k, len(v), round(sum(round(a * 100) for a in v))) for k, v in grouped(data).items()]
    assert got == sorted(want, key=repr)


def test_totals_and_counts(sales):
    data, df = sales
    counts = Counter((client,) for client, *_ in data)
    assert rows(op.count_by(df, ["client_id"])) == sorted(((*k, n) for k, n in counts.items()), key=repr)
    cents = defaultdict(int)
    for client, _, _, amount in data:
        cents[client] += round(amount * 100)
    assert rows(op.total_by(df, ["client_id"], F.col("amount"))) == sorted(cents.items(), key=repr)


def test_leader_prefers_lowest_id(sales):
    data, df = sales
    totals = op.count_and_total(df, ["client_id", "store", "item"], F.col("amount"))
    leaders = totals.groupBy("client_id", "store").agg(
        op.leader_of("sold_count", "item").alias("c"), op.leader_of("total_cents", "item").alias("s")
    )
    got = rows(leaders, "client_id", "store", "c.item", "c.sold_count", "s.item", "s.total_cents")
    per_group = defaultdict(list)
    for (client, store, item), amounts in grouped(data).items():
        per_group[client, store].append((item, len(amounts), sum(round(a * 100) for a in amounts)))
    want = []
    for key, items in per_group.items():
        by_count = min(items, key=lambda i: (-i[1], i[0]))
        by_sum = min(items, key=lambda i: (-i[2], i[0]))
        want.append((*key, by_count[0], by_count[1], by_sum[0], by_sum[2]))
    assert got == sorted(want, key=repr)


def test_best_month_prefers_the_earliest(spark):
    leaders = spark.createDataFrame(
        [("a", 2024, 3, "x", 5, "p", 1.0), ("a", 2024, 1, "y", 5, "q", 0.5), ("a", 2025, 2, "z", 1, "r", -1.0)],
        "client_id string, year int, month int, top_count_item_name string, top_count bigint, "
        "top_sum_item_name string, top_sum double",
    )
    got = rows(yearly_best_month(leaders), "report", "year", "month", "item_name", "value")
    assert got == [
        ("top_profit", 2024, 3, "p", 1.0),
        ("top_profit", 2025, 2, "r", -1.0),
        ("top_selling", 2024, 1, "y", 5.0),
        ("top_selling", 2025, 2, "z", 1.0),
    ]


def brute_top(data, n):
    counts = Counter((client, store, item) for client, store, item, _ in data)
    per = defaultdict(list)
    for (client, store, item), count in counts.items():
        per[client, store].append((count, item))
    return sorted(
        ((*key, item, count) for key, items in per.items() for count, item in sorted(items, reverse=True)[:n]), key=repr
    )


@pytest.mark.parametrize("threshold", ["1000", "2"])
@pytest.mark.parametrize("n", [1, 3, 40])
def test_top_n(spark, sales, n, threshold):
    """Threshold 2 forces the salted form for larger n."""
    data, df = sales
    counts = op.count_by(df, ["client_id", "store", "item"], "count")
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(key, threshold)
    try:
        top = op.top_n_per_group(counts, ["client_id", "store"], [F.desc("count"), F.desc("item")], n)
        assert rows(top, "client_id", "store", "item", "count") == brute_top(data, n)
    finally:
        spark.conf.unset(key)


def test_top_n_is_limited_before_the_shuffle(sales):
    _, df = sales
    counts = op.count_by(df, ["client_id", "store", "item"], "count")
    top = op.top_n_per_group(counts, ["client_id", "store"], [F.desc("count"), F.desc("item")], 3)
    assert plan(top).split("\n\n")[0].count("WindowGroupLimit") == 2


def test_sort_all(spark):
    df = spark.createDataFrame([(2, "a"), (1, "b"), (1, "a")], "x int, y string")
    assert [tuple(r) for r in op.sort_all(df).collect()] == [(1, "a"), (1, "b"), (2, "a")]


def test_lookup(spark):
    facts = spark.createDataFrame([("c", 1), ("c", 2), ("d", 1), ("c", None)], "client_id string, top bigint")
    names = spark.createDataFrame(
        [("c", 1, "one"), ("c", 3, "three"), ("d", 1, None)], "client_id string, item_id bigint, item_name string"
    )
    got = rows(op.lookup_name(facts, names, "top", "name"), "client_id", "top", "name")
    want = [("c", 1, "one"), ("c", 2, "Unknown"), ("c", None, "Unknown"), ("d", 1, "Unknown")]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("threshold, join", [("10485760", "BroadcastHashJoin"), ("-1", "SortMergeJoin")])
def test_lookup_broadcasts_only_small_sides(spark, folder, threshold, join):
    """No hint: beyond the size threshold the join shuffles, and the answer is the same."""
    path = folder("names")
    spark.range(50).selectExpr("'c' client_id", "id item_id", "concat('n', id) item_name").write.parquet(path)
    facts = spark.range(60).selectExpr("if(id < 30, 'c', 'd') client_id", "id top")
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, threshold)
    try:
        named = op.lookup_name(facts, spark.read.parquet(path), "top", "name")
        assert join in plan(named)
        assert named.filter("name = 'Unknown'").count() == 30
    finally:
        spark.conf.unset(key)


def test_last_wins(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, None, 2), (2, None, 1)], "k int, v string, o int")
    assert rows(op.last_wins(df, ["k"], "o"), "k", "v") == [(1, "b"), (2, None)]


def test_keep_and_drop(spark):
    users = spark.createDataFrame([("c", 1), ("c", 2), ("d", 1)], "client_id string, user_id bigint")
    wanted = spark.createDataFrame([("c", 1), ("c", 1), ("e", 2)], "client_id string, user_id bigint")
    assert rows(op.keep_referenced(users, wanted, ["client_id", "user_id"])) == [("c", 1)]
    closed = spark.createDataFrame([("c",)], "client_id string")
    assert rows(op.drop_closed(users, closed)) == [("d", 1)]
    assert rows(op.enrich(wanted.distinct(), users.withColumn("b", F.lit("x")), ["client_id", "user_id"], ["b"])) == [
        ("c", 1, "x"),
        ("e", 2, None),
    ]


def brute_diff(left, right):
    extra, missing = Counter(left) - Counter(right), Counter(right) - Counter(left)
    return sorted(
        [(*k, "left_only", n) for k, n in extra.items()] + [(*k, "right_only", n) for k, n in missing.items()], key=repr
    )


def test_diff_counts_copies_nulls_and_nan(spark):
    nan = float("nan")
    left = [(1, "a", 1.0), (1, "a", 1.0), (2, None, None), (3, "c", nan), (4, "d", -0.0)]
    right = [(1, "a", 1.0), (2, None, None), (3, "c", nan), (4, "d", 0.0), (5, "e", 2.0), (5, "e", 2.0)]
    schema = "i int, s string, d double"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    assert rows(op.diff_rows(a, b)) == [(1, "a", 1.0, "left_only", 1), (5, "e", 2.0, "right_only", 2)]
    assert op.diff_summary(a, b).first().asDict() == {
        "left_rows": 5, "right_rows": 6, "left_only_rows": 1, "right_only_rows": 2,
        "left_columns": 3, "right_columns": 3, "identical": False,
    }
    assert op.diff_summary(a, a.orderBy(F.desc("i"))).first()["identical"]
    assert rows(op.diff_sample(a, b, 1)) == [(1, "a", 1.0, "left_only", 1)]


def test_diff_of_random_sets(spark):
    rng = random.Random(3)
    left = [(rng.randrange(20), rng.choice("ab")) for _ in range(300)]
    right = [(rng.randrange(20), rng.choice("abc")) for _ in range(300)]
    a, b = (spark.createDataFrame(x, "i int, s string") for x in (left, right))
    assert rows(op.diff_rows(a, b)) == brute_diff(left, right)


def test_diff_needs_the_same_columns(spark):
    a, b = spark.range(3), spark.range(4).select("id", F.lit(1).alias("x"))
    with pytest.raises(ValueError):
        op.diff_rows(a, b)
    row = op.diff_summary(a, b).first()
    assert (row["left_rows"], row["right_rows"], row["left_columns"], row["right_columns"]) == (3, 4, 1, 2)
    assert not row["identical"]


def test_pairs_against_brute_force(spark):
    rng = random.Random(5)
    data = [(f"c{rng.randrange(4)}", rng.randrange(6), rng.choice(["x", None])) for _ in range(200)]
    df = spark.createDataFrame(data, "client_id string, i int, s string")
    clients = ["c0", "c1", "c2", "absent"]
    bags = {c: Counter((i, s) for client, i, s in data if client == c) for c in clients}
    want, verdicts = [], []
    for x in range(4):
        for y in range(x + 1, 4):
            a, b = bags[clients[x]], bags[clients[y]]
            differing = [(*k, clients[x], clients[y], a[k], b[k]) for k in set(a) | set(b) if a[k] != b[k]]
            want += differing
            gap = sum(abs(r[4] - r[5]) for r in differing)
            verdicts.append((clients[x], clients[y], a.total(), b.total(), gap, gap == 0))
    got = op.pairwise_diff(df, clients)
    assert rows(got) == sorted(want, key=repr)
    assert rows(op.pairwise_verdicts(df, clients)) == sorted(verdicts, key=repr)
    assert "Cartesian" not in plan(got) and "NestedLoop" not in plan(got)


def test_clients_with_the_same_data_agree(spark):
    df = spark.createDataFrame([(c, i % 3) for c in "ab" for i in range(10)], "client_id string, v int")
    assert op.pairwise_diff(df, ["a", "b"]).count() == 0
    assert tuple(op.agreement(op.pairwise_verdicts(df, ["a", "b"])).first()) == (1, True)
    with pytest.raises(ValueError):
        op.pairwise_diff(df, ["a"])


def test_funnel_stages_apply_in_order(spark):
    df = spark.createDataFrame([("c", 1, 9), ("c", None, 9), ("c", 1, 0), ("d", 1, 9)], "client_id string, a int, b int")
    got = op.stage_funnel(df, {"has_a": F.col("a") > 0, "big_b": F.col("b") > 5})
    assert rows(got) == [("c", 3, 2, 1), ("d", 1, 1, 1)]


def test_hot_groups_are_combined_before_the_shuffle(sales):
    _, df = sales
    text = plan(op.count_and_total(df, ["client_id"], F.col("amount")))
    tree = text.split("\n\n")[0]
    assert tree.index("HashAggregate") < tree.index("Exchange") < tree.rindex("HashAggregate")
    assert "SortAggregate" not in tree
