"""The four questions. Inputs are typed DataFrames that carry ``client_id``."""

from tillmetrics.plans.buyers import buyer_counts, rank_buyers, top_buyers_per_store, with_birthdays
from tillmetrics.plans.funnel import transaction_funnel
from tillmetrics.plans.high_value import high_value_transactions
from tillmetrics.plans.items import item_month_totals, monthly_item_leaders, rank_items, yearly_best_month
from tillmetrics.plans.report import QUERIES, all_results
from tillmetrics.plans.stores import semester_store_totals, semester_store_tpv, store_volume

__all__ = [
    "QUERIES",
    "all_results",
    "buyer_counts",
    "high_value_transactions",
    "item_month_totals",
    "monthly_item_leaders",
    "rank_buyers",
    "rank_items",
    "semester_store_totals",
    "semester_store_tpv",
    "store_volume",
    "top_buyers_per_store",
    "transaction_funnel",
    "with_birthdays",
    "yearly_best_month",
]
