"""Comparing result sets regardless of row order (D1, D2, D4) and stage counters.

Rows are compared as multisets by counting equal rows, one aggregation over the
data. Rows that agree vanish in it; nothing is sorted, and no row is paired with
another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.operators.leaders import top_n_per_group
from tillmetrics.schemas import CLIENT

LEFT_ONLY = "left_only"
RIGHT_ONLY = "right_only"


def _net_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("both sides need the same columns")
    tagged = left.withColumn("_weight", F.lit(1)).unionByName(right.withColumn("_weight", F.lit(-1)))
    return tagged.groupBy(*left.columns).agg(F.sum("_weight").alias("_net"))


def diff_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows one side has more often, with ``side`` and the number of extra ``copies``."""
    unequal = _net_counts(left, right).filter(F.col("_net") != 0)
    side = F.when(F.col("_net") > 0, F.lit(LEFT_ONLY)).otherwise(F.lit(RIGHT_ONLY))
    return unequal.select(*left.columns, side.alias("side"), F.abs("_net").alias("copies"))


def diff_summary(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with the row and column counts of both sides and the differing rows.

    Sides with different columns are never identical; then only their counts are given.
    """
    same_columns = sorted(left.columns) == sorted(right.columns)
    if same_columns:
        tagged = left.withColumns({"_l": F.lit(1), "_r": F.lit(0)}).unionByName(
            right.withColumns({"_l": F.lit(0), "_r": F.lit(1)})
        )
        per_row = tagged.groupBy(*left.columns).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    else:
        per_row = left.select(F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
            right.select(F.lit(0).alias("_l"), F.lit(1).alias("_r"))
        )
    extra = F.greatest(F.col("_l") - F.col("_r"), F.lit(0))
    missing = F.greatest(F.col("_r") - F.col("_l"), F.lit(0))
    totals = per_row.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(extra), F.lit(0)).alias("left_only_rows"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("right_only_rows"),
    )
    none_left = (F.col("left_only_rows") == 0) & (F.col("right_only_rows") == 0)
    return totals.withColumns(
        {
            "left_columns": F.lit(len(left.columns)),
            "right_columns": F.lit(len(right.columns)),
            "identical": none_left & F.lit(same_columns),
        }
    )


def diff_sample(left: DataFrame, right: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` differing rows, for display."""
    return diff_rows(left, right).orderBy("side", *left.columns).limit(n)


def _leaders(rows: DataFrame, clients: Sequence[Any], client: str) -> dict[Any, tuple[Any, int]]:
    """For each of the given clients the first one with the same rows, and the number of rows.

    One aggregation: per client a count and two order-free sums over its rows.
    """
    if len(set(clients)) < 2:
        raise ValueError("a comparison needs at least two clients")
    columns = [name for name in rows.columns if name != client]
    sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (0, 1)]
    marks = rows.filter(F.col(client).isin(*clients)).groupBy(client).agg(F.count(F.lit(1)), *sums)
    found = {row[0]: tuple(row[1:]) for row in marks.collect()}  # a row for each named client
    first: dict[tuple, Any] = {}
    none = (0, None, None)
    return {c: (first.setdefault(found.get(c, none), c), found.get(c, none)[0]) for c in clients}


def _pairs(rows: DataFrame, clients: Sequence[Any], client: str, leaders: dict) -> DataFrame:
    """The pairs of a report, with the leaders that stand for both sides."""
    kind = rows.schema[client].dataType.simpleString()
    pairs = [
        (a, b, leaders[a][0], leaders[b][0], leaders[a][1], leaders[b][1]) for a, b in combinations(clients, 2)
    ]
    names = ("left_client", "right_client", "_left", "_right")
    schema = ", ".join(f"{name} {kind}" for name in names) + ", left_rows long, right_rows long"
    return rows.sparkSession.createDataFrame(pairs, schema)


def _held(rows: DataFrame, client: str, chosen: Sequence[Any]) -> DataFrame:
    """Content and ``_held``, its holders among the chosen clients with their copies, in the order of clients.

    Rows that all of them hold equally often are left out.
    """
    columns = [name for name in rows.columns if name != client]
    per_client = rows.filter(F.col(client).isin(*chosen)).groupBy(client, *columns).agg(F.count(F.lit(1)).alias("_n"))
    held = per_client.groupBy(*columns).agg(
        F.sort_array(F.collect_list(F.struct(F.col(client).alias("_client"), "_n"))).alias("_held"),
        F.min("_n").alias("_least"), F.max("_n").alias("_most"), F.count(F.lit(1)).alias("_clients"),
    )
    same = (F.col("_clients") == len(chosen)) & (F.col("_least") == F.col("_most"))
    return held.filter(~same).select(*columns, "_held")


def _chosen(leaders: dict) -> list[Any]:
    return list(dict.fromkeys(leader for leader, _ in leaders.values()))


def _leader_diff(rows: DataFrame, client: str, leaders: dict) -> DataFrame:
    """Differing rows of every two unlike leaders, both ways round, with the copies of each side.

    A row differs between its holders and the others, so each holder is set against all leaders: what is made is
    no more than twice what is returned, and rows without a difference are never paired.
    """
    columns = [name for name in rows.columns if name != client]
    held = _held(rows, client, _chosen(leaders)).withColumn("_n", F.map_from_entries("_held"))
    everyone = F.array(*[F.lit(c) for c in _chosen(leaders)])

    def against(holder: Column) -> Column:
        def side(other: Column) -> Column:
            copies = F.coalesce(F.try_element_at("_n", other), F.lit(0).cast("long"))
            here, there = holder["_client"], other
            return F.struct(
                here.alias("_left"), there.alias("_right"), holder["_n"].alias("left_copies"), copies.alias("right_copies")
            )

        return F.filter(F.transform(everyone, side), lambda s: s["left_copies"] != s["right_copies"])

    found = held.select(*columns, F.explode("_held").alias("_holder"), "_n")
    found = found.select(*columns, F.explode(against(F.col("_holder"))).alias("_side")).select(*columns, "_side.*")
    # Where the other side holds the row as well, it turns up as a holder itself.
    turned = found.filter("right_copies = 0").select(
        *columns, F.col("_right").alias("_left"), F.col("_left").alias("_right"),
        F.col("right_copies").alias("left_copies"), F.col("left_copies").alias("right_copies"),
    )
    return found.unionByName(turned)


def _overlaps(rows: DataFrame, client: str, leaders: dict) -> DataFrame:
    """Rows that two unlike leaders share, counted as often as both have them.

    Rows are first gathered by their signature, who holds them how often; only signatures are paired, and of
    these only their holders. Clients that hold the same but for some rows have few signatures, clients with
    rows of their own have signatures of one.
    """
    per_client = rows.filter(F.col(client).isin(*_chosen(leaders)))
    columns = [name for name in rows.columns if name != client]
    per_client = per_client.groupBy(client, *columns).agg(F.count(F.lit(1)).alias("_n"))
    holders = F.sort_array(F.collect_list(F.struct(F.col(client).alias("_client"), "_n"))).alias("_held")
    signatures = per_client.groupBy(*columns).agg(holders).filter(F.size("_held") > 1)
    signatures = signatures.groupBy("_held").agg(F.count(F.lit(1)).alias("_rows"))

    def against(first: Column) -> Column:
        return F.transform(
            F.filter("_held", lambda other: other["_client"] != first["_client"]),
            lambda other: F.struct(
                first["_client"].alias("_left"), other["_client"].alias("_right"),
                F.least(first["_n"], other["_n"]).alias("_both"),
            ),
        )

    pairs = signatures.select("_rows", "_held", F.explode("_held").alias("_first"))
    pairs = pairs.select("_rows", F.explode(against(F.col("_first"))).alias("_pair")).select("_rows", "_pair.*")
    return pairs.groupBy("_left", "_right").agg(F.sum(F.col("_rows") * F.col("_both")).alias("_shared"))


def pairwise_diff(rows: DataFrame, clients: Sequence[Any], client: str = CLIENT) -> DataFrame:
    """For each pair of the given clients the rows they hold a different number of times.

    Clients with the same rows are one: only one of each kind is compared row by row, so
    the work grows with the rows and with the differences returned.
    """
    columns = [name for name in rows.columns if name != client]
    leaders = _leaders(rows, clients, client)
    pairs = _pairs(rows, clients, client, leaders)
    if len(_chosen(leaders)) < 2:
        none = pairs.filter(F.lit(False)).select(
            "left_client", "right_client", F.col("left_rows").alias("left_copies"), F.col("right_rows").alias("right_copies")
        )
        blank = [F.lit(None).cast(rows.schema[name].dataType).alias(name) for name in columns]
        return none.select(*blank, "*")
    found = _leader_diff(rows, client, leaders).join(pairs, ["_left", "_right"])
    return found.select(*columns, "left_client", "right_client", "left_copies", "right_copies")


def pairwise_verdicts(rows: DataFrame, clients: Sequence[Any], client: str = CLIENT) -> DataFrame:
    """One row per pair of clients: row counts, differing rows, and whether they agree.

    What differs is all that both hold, less twice what they share, so no row is compared with another.
    """
    leaders = _leaders(rows, clients, client)
    pairs = _pairs(rows, clients, client, leaders)
    same = F.col("_left") == F.col("_right")
    if len(_chosen(leaders)) > 1:
        pairs = pairs.join(_overlaps(rows, client, leaders), ["_left", "_right"], "left")
    else:
        pairs = pairs.withColumn("_shared", F.lit(0).cast("long"))
    apart = F.col("left_rows") + F.col("right_rows") - 2 * F.coalesce("_shared", F.lit(0).cast("long"))
    verdicts = pairs.withColumn("differing_rows", F.when(same, F.lit(0).cast("long")).otherwise(apart))
    verdicts = verdicts.withColumn("identical", F.col("differing_rows") == 0)
    return verdicts.select("left_client", "right_client", "left_rows", "right_rows", "differing_rows", "identical")


def diff_sample_pairs(rows: DataFrame, clients: Sequence[Any], n: int = 10, client: str = CLIENT) -> DataFrame:
    """D4 for each pair: its first ``n`` differing rows, and how many more there are.

    A row of the report is numbered by ``place``; ``remaining`` is the number of differing rows that the pair has
    beyond the ones shown. Each task sends at most ``n`` rows and one count per pair.
    """
    found = pairwise_diff(rows, clients, client)
    pair = ["left_client", "right_client"]
    columns = [name for name in rows.columns if name != client]
    shown = top_n_per_group(found, pair, [F.col(name) for name in columns], n, "place")
    counts = found.groupBy(*pair).agg(F.count(F.lit(1)).alias("_all"))
    remaining = F.greatest(F.col("_all") - n, F.lit(0).cast("long")).alias("remaining")
    return shown.join(counts, pair).select(*pair, "place", *columns, "left_copies", "right_copies", remaining)


def agreement(verdicts: DataFrame) -> DataFrame:
    """Overall line of the report: comparisons made, and whether all were identical."""
    return verdicts.agg(
        F.count(F.lit(1)).alias("comparisons"),
        F.coalesce(F.bool_and("identical"), F.lit(True)).alias("all_identical"),
    )


def stage_funnel(
    rows: DataFrame, stages: Mapping[str, Column], keys: Sequence[str] = (CLIENT,)
) -> DataFrame:
    """Rows in, and rows left after each stage, per key in one pass.

    Stages apply one after another: a row counts for a stage when it passed all
    stages up to it.
    """
    counters = [F.count(F.lit(1)).alias("rows_in")]
    passed = F.lit(True)
    for name, predicate in stages.items():
        passed = passed & F.coalesce(predicate, F.lit(False))
        counters.append(F.count_if(passed).alias(name))
    return rows.groupBy(*keys).agg(*counters)
