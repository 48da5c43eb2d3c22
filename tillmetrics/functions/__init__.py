"""Column expressions; all built-in, so they stay inside whole-stage codegen."""

from tillmetrics.functions.amounts import at_least, is_number, positive, to_cents, total_cents, units
from tillmetrics.functions.calendar import (
    in_hours,
    in_semesters,
    in_years,
    semester,
    semester_key,
    year_month_label,
)
from tillmetrics.functions.fingerprints import batch_fingerprint
from tillmetrics.functions.parsing import non_blank, to_date, to_id, to_integer, to_number, to_timestamp, whole

__all__ = [
    "at_least",
    "batch_fingerprint",
    "in_hours",
    "in_semesters",
    "in_years",
    "is_number",
    "non_blank",
    "positive",
    "semester",
    "semester_key",
    "to_cents",
    "to_date",
    "to_id",
    "to_integer",
    "to_number",
    "to_timestamp",
    "total_cents",
    "units",
    "whole",
    "year_month_label",
]
