"""Q4: the most frequent buyers of every store, with their birthday."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions import in_years
from tillmetrics.operators import count_by, enrich, keep_referenced, last_wins, top_n_per_group
from tillmetrics.params import Params
from tillmetrics.schemas import CLIENT
from tillmetrics.sources.csv_files import ARRIVAL

STORE = (CLIENT, "store_id")
BUYER = (CLIENT, "store_id", "user_id")


def buyer_counts(transactions: DataFrame, params: Params = Params()) -> DataFrame:
    """Purchases per client, store and user; rows without store or user are left out."""
    rows = transactions.filter(
        in_years(F.col("created_at"), params.years)
        & F.col("store_id").isNotNull()
        & F.col("user_id").isNotNull()
    )
    return count_by(rows, BUYER, "count")


def rank_buyers(counts: DataFrame, params: Params = Params()) -> DataFrame:
    """Top buyers by (count, user id), both descending."""
    order = [F.col("count").desc(), F.col("user_id").desc()]
    top = top_n_per_group(counts, STORE, order, params.top_n)
    return top.select(*BUYER, "count")


def with_birthdays(top: DataFrame, users: DataFrame) -> DataFrame:
    """Second phase: keep only the users asked for, last row per user, then look up.

    ``users`` may hold several rows per user when it has an ``arrival`` column.
    """
    keys = [CLIENT, "user_id"]
    arrival = [ARRIVAL] if ARRIVAL in users.columns else []
    profiles = users.select(*keys, "birthdate", *arrival)
    profiles = last_wins(profiles, keys, ARRIVAL, asked=top) if arrival else keep_referenced(profiles, top, keys)
    profiles = profiles.select(*keys, F.col("birthdate").alias("birthday"))
    return enrich(top, profiles, keys, ["birthday"]).select(*BUYER, "count", "birthday")


def top_buyers_per_store(
    transactions: DataFrame, users: DataFrame, params: Params = Params()
) -> DataFrame:
    """Q4. A buyer without a user row keeps a null birthday."""
    return with_birthdays(rank_buyers(buyer_counts(transactions, params), params), users)
