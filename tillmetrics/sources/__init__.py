"""Where rows come from and where results go."""

from tillmetrics.sources.csv_files import (
    dataset_glob,
    delivered_month,
    read_dataset,
    read_dimension,
    read_lines,
    read_raw,
    rejected,
    typed,
    with_client,
    with_dataset_kind,
)
from tillmetrics.sources.landing import land, read_landed
from tillmetrics.sources.results import clear_result, has_result, preview, print_rows, read_result, write_result
from tillmetrics.sources.versions import VersionedSet

__all__ = [
    "VersionedSet",
    "clear_result",
    "dataset_glob",
    "delivered_month",
    "has_result",
    "land",
    "preview",
    "print_rows",
    "read_dataset",
    "read_dimension",
    "read_landed",
    "read_lines",
    "read_raw",
    "read_result",
    "rejected",
    "typed",
    "with_client",
    "with_dataset_kind",
    "write_result",
]
