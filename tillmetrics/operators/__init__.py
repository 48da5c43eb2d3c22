"""Relational building blocks of the plans. All take and return DataFrames."""

from tillmetrics.operators.aggregates import count_and_total, count_by, total_by, union_all
from tillmetrics.operators.leaders import leader_of, sort_all, top_n_per_group
from tillmetrics.operators.lookups import drop_closed, enrich, keep_referenced, last_wins, lookup_name
from tillmetrics.operators.reconcile import (
    agreement,
    diff_rows,
    diff_sample,
    diff_sample_pairs,
    diff_summary,
    pairwise_diff,
    pairwise_verdicts,
    stage_funnel,
)

__all__ = [
    "agreement",
    "count_and_total",
    "count_by",
    "diff_rows",
    "diff_sample",
    "diff_sample_pairs",
    "diff_summary",
    "drop_closed",
    "enrich",
    "keep_referenced",
    "last_wins",
    "leader_of",
    "lookup_name",
    "pairwise_diff",
    "pairwise_verdicts",
    "sort_all",
    "stage_funnel",
    "top_n_per_group",
    "total_by",
    "union_all",
]
