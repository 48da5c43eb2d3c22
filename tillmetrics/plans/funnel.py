"""Stage counters of the transaction questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions import at_least, in_hours, in_years, is_number
from tillmetrics.operators import stage_funnel
from tillmetrics.params import Params


def transaction_funnel(transactions: DataFrame, params: Params = Params()) -> DataFrame:
    """Per client: rows in, with a valid date, in the years, in the hours, of enough value.

    The differences between neighbours are the rows each stage dropped, so rejected
    rows (F7) are ``rows_in - dated`` and ``in_hours - priced``.
    """
    created, amount = F.col("created_at"), F.col("final_amount")
    return stage_funnel(
        transactions,
        {
            "dated": created.isNotNull(),
            "in_years": in_years(created, params.years),
            "in_hours": in_hours(created, params.start_hour, params.end_hour),
            "priced": is_number(amount),
            "high_value": at_least(amount, params.min_amount),
        },
    )
