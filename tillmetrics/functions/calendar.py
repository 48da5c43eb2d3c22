"""Dates: year, semester and hour predicates and labels.

Year and semester filters are written as closed-open timestamp ranges rather than
``year(ts) IN (...)``: a range on the bare column reaches the parquet scan and
skips row groups, a function of the column does not. Columns are TIMESTAMP_NTZ.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_MONTH_OF_SECOND_SEMESTER = 7
_SEMESTER = re.compile(r"^(?:semester\.)?(\d{4})-([12])$")


def _half_years(halves: Iterable[int], ts: Column) -> Column:
    """Rows whose timestamp lies in one of the half years ``2 * year + (0 | 1)``."""
    wanted = sorted(set(halves))
    if not wanted:
        return F.lit(False)
    ranges: list[list[int]] = []
    for half in wanted:
        if ranges and ranges[-1][1] == half:
            ranges[-1][1] = half + 1
        else:
            ranges.append([half, half + 1])

    def instant(half: int) -> Column:
        month = FIRST_MONTH_OF_SECOND_SEMESTER if half % 2 else 1
        return F.lit(f"{half // 2:04d}-{month:02d}-01 00:00:00").cast("timestamp_ntz")

    parts = [(ts >= instant(low)) & (ts < instant(high)) for low, high in ranges]
    return reduce(lambda left, right: left | right, parts)


def in_years(ts: Column, years: Iterable[int]) -> Column:
    """adjacent years collapse into one range."""
    return _half_years((2 * year + part for year in years for part in (0, 1)), ts)


def in_semesters(ts: Column, semesters: Iterable[str]) -> Column:
    """F8: semesters given as ``2024-1`` or ``semester.2024-1``; all others vanish."""
    halves = []
    for name in semesters:
        match = _SEMESTER.match(name)
        if not match:
            raise ValueError(f"not a semester: {name!r}")
        halves.append(2 * int(match[1]) + int(match[2]) - 1)
    return _half_years(halves, ts)


def in_hours(ts: Column, start_hour: int, end_hour: int) -> Column:
    """closed range on the hour field, so 22:59:59 is inside 6-22."""
    return F.hour(ts).between(start_hour, end_hour)


def semester(ts: Column) -> Column:
    """January to June is 1, July to December is 2."""
    return F.when(F.month(ts) < FIRST_MONTH_OF_SECOND_SEMESTER, F.lit(1)).otherwise(F.lit(2))


def semester_key(year: Column, half: Column) -> Column:
    """``semester.2024-1``."""
    return F.format_string("semester.%d-%d", year, half)


def year_month_label(year: Column, month: Column) -> Column:
    """E5: ``2024-1``, month not zero padded."""
    return F.concat_ws("-", year.cast("string"), month.cast("string"))
