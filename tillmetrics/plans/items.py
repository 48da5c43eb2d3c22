"""Q2: per month the item sold most often and the item earning most; Q2b: their best months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions import in_years, is_number, units, year_month_label
from tillmetrics.operators import count_and_total, last_wins, leader_of, lookup_name, top_n_per_group
from tillmetrics.params import Params
from tillmetrics.schemas import CLIENT
from tillmetrics.sources.csv_files import ARRIVAL

ITEM_MONTH = (CLIENT, "year", "month", "item_id")
MONTH = (CLIENT, "year", "month")


def item_month_totals(transaction_items: DataFrame, params: Params = Params()) -> DataFrame:
    """Rows sold and revenue (in cents) per client, month and item.

    Grouped by the full key: a month with a third of all rows is spread over its items.
    """
    created, subtotal = F.col("created_at"), F.col("subtotal")
    rows = transaction_items.filter(in_years(created, params.years) & is_number(subtotal))
    keyed = rows.select(
        CLIENT, F.year(created).alias("year"), F.month(created).alias("month"), "item_id", "subtotal"
    )
    return count_and_total(keyed, ITEM_MONTH, subtotal)


def rank_items(totals: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Both leaders of every month in one aggregation, then their names.

    Only the items that lead are looked for in ``menu_items``. It may hold several rows per item when it has an ``arrival``
    column: the last row of each then counts.
    """
    leaders = totals.groupBy(*MONTH).agg(
        leader_of("sold_count", "item_id").alias("by_count"),
        leader_of("total_cents", "item_id").alias("by_sum"),
    )
    flat = leaders.select(
        *MONTH,
        F.col("by_count.item_id").alias("top_count_item_id"),
        F.col("by_count.sold_count").alias("top_count"),
        F.col("by_sum.item_id").alias("top_sum_item_id"),
        units(F.col("by_sum.total_cents")).alias("top_sum"),
    )
    names = _names_of(menu_items, flat)
    named = lookup_name(flat, names, "top_count_item_id", "top_count_item_name")
    named = lookup_name(named, names, "top_sum_item_id", "top_sum_item_name")
    return named.select(
        *MONTH,
        "top_count_item_id",
        "top_count_item_name",
        "top_count",
        "top_sum_item_id",
        "top_sum_item_name",
        "top_sum",
    )


def _names_of(menu_items: DataFrame, leaders: DataFrame) -> DataFrame:
    """The menu rows of items that lead; with an arrival column the last row of each item.

    A menu of any size meets the few leaders while it is read, so no task holds it as a whole.
    """
    keys = [CLIENT, "item_id"]
    asked = leaders.select(
        F.col(CLIENT).alias("asking"), F.explode(F.array("top_count_item_id", "top_sum_item_id")).alias("asked_id")
    )
    # The null-safe client adds no filter below the totals, so they are worked out once for this join and for the answer.
    wanted = menu_items[CLIENT].eqNullSafe(asked["asking"]) & (menu_items["item_id"] == asked["asked_id"])
    rows = menu_items.join(asked, wanted, "left_semi")
    if ARRIVAL not in menu_items.columns:
        return rows
    return last_wins(rows.select(*keys, "item_name", ARRIVAL), keys, ARRIVAL).drop(ARRIVAL)


def monthly_item_leaders(
    transaction_items: DataFrame, menu_items: DataFrame, params: Params = Params()
) -> DataFrame:
    """Q2. Equal counts or sums go to the lowest item id."""
    return rank_items(item_month_totals(transaction_items, params), menu_items)


def yearly_best_month(leaders: DataFrame) -> DataFrame:
    """Q2b (A5) from the result of Q2, one row per client, year and report.

    ``report`` is ``top_selling`` (by count) or ``top_profit`` (by revenue); the
    earliest month wins a tie.
    """
    lines = [
        F.struct(
            F.lit(report).alias("report"),
            F.col(name).alias("item_name"),
            F.col(value).cast("double").alias("value"),
        )
        for report, name, value in (
            ("top_selling", "top_count_item_name", "top_count"),
            ("top_profit", "top_sum_item_name", "top_sum"),
        )
    ]
    # At most twelve rows a year: the limit before the shuffle leaves one of each task.
    flat = leaders.select(CLIENT, "year", "month", F.inline(F.array(*lines)))
    best = top_n_per_group(flat, [CLIENT, "report", "year"], [F.desc("value"), F.asc("month")], 1)
    label = year_month_label(F.col("year"), F.col("month")).alias("year_month")
    return best.select(CLIENT, "report", "year", "month", label, "item_name", "value")
