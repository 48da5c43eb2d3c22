"""All questions over one set of inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillmetrics.params import Params
from tillmetrics.plans.buyers import top_buyers_per_store
from tillmetrics.plans.high_value import high_value_transactions
from tillmetrics.plans.items import monthly_item_leaders
from tillmetrics.plans.stores import semester_store_tpv

QUERIES = ("q1", "q2", "q3", "q4")


def all_results(
    transactions: DataFrame,
    transaction_items: DataFrame,
    menu_items: DataFrame,
    users: DataFrame | None,
    params: Params = Params(),
) -> dict[str, DataFrame]:
    """Lazy results by name. Without users only the first three are answered."""
    results = {
        "q1": high_value_transactions(transactions, params),
        "q2": monthly_item_leaders(transaction_items, menu_items, params),
        "q3": semester_store_tpv(transactions, params),
    }
    if users is not None:
        results["q4"] = top_buyers_per_store(transactions, users, params)
    return results
