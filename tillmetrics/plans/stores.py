"""Q3: payment volume per year, semester and store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions import in_hours, in_semesters, in_years, positive, semester, units
from tillmetrics.operators import total_by
from tillmetrics.params import Params
from tillmetrics.schemas import CLIENT

SEMESTER_STORE = (CLIENT, "year", "semester", "store_id")


def semester_store_totals(transactions: DataFrame, params: Params = Params()) -> DataFrame:
    """Volume in cents; semesters nobody asked for are not read at all."""
    created, amount = F.col("created_at"), F.col("final_amount")
    rows = transactions.filter(
        in_years(created, params.years)
        & in_semesters(created, params.semesters)
        & in_hours(created, params.start_hour, params.end_hour)
        & positive(amount)
    )
    keyed = rows.select(
        CLIENT,
        F.year(created).alias("year"),
        semester(created).alias("semester"),
        "store_id",
        "final_amount",
    )
    return total_by(keyed, SEMESTER_STORE, amount)


def store_volume(totals: DataFrame) -> DataFrame:
    return totals.select(*SEMESTER_STORE, units(F.col("total_cents")).alias("tpv"))


def semester_store_tpv(transactions: DataFrame, params: Params = Params()) -> DataFrame:
    """Q3: sum of the positive amounts."""
    return store_volume(semester_store_totals(transactions, params))
