"""Q1: which transactions of the chosen years, in opening hours, reach an amount?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions import at_least, in_hours, in_years
from tillmetrics.params import Params


def high_value_transactions(transactions: DataFrame, params: Params = Params()) -> DataFrame:
    """All transaction columns; a filter over one scan, no shuffle.

    Rows without a valid date or amount have nulls there and do not pass (F7).
    """
    created = F.col("created_at")
    return transactions.filter(
        in_years(created, params.years)
        & in_hours(created, params.start_hour, params.end_hour)
        & at_least(F.col("final_amount"), params.min_amount)
    )
