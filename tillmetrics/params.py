"""Parameters of the four questions."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """Every threshold is an argument; the values below are the deployed ones."""

    # The thresholds the published results are defined with.
    years: tuple[int, ...] = (2024, 2025)
    start_hour: int = 6
    end_hour: int = 22
    min_amount: float = 75.0
    semesters: tuple[str, ...] = ("2024-1", "2025-1")
    top_n: int = 3
    preview_rows: int = 5
