"""Settings shared by every stage, held in one frozen dataclass.

The defaults are the values the finance pipeline ships with. A caller whose
data covers other years replaces the bounds with ``dataclasses.replace``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# Canonical transaction status -> spellings accepted for it
# (compared in lower case). Every other spelling is invalid.
STATUS_SPELLINGS: dict[str, tuple[str, ...]] = {
    "completed": ("completed", "complete", "done"),
    "pending": ("pending",),
    "failed": ("failed",),
}

# Spending categories by (group, flow direction).
CATEGORY_GROUPS: dict[tuple[str, str], tuple[str, ...]] = {
    ("Income", "Inflow"): ("Salary", "Investment", "Transfer"),
    ("Essential", "Outflow"): ("Rent", "Groceries", "Utilities", "Healthcare"),
    ("Discretionary", "Outflow"): ("Travel", "Entertainment", "Miscellaneous"),
}


@dataclass(frozen=True)
class Settings:
    """Knobs of the pipeline; immutable, so a plan cannot change under a caller."""

    # Transactions outside these days are rejected. The bounds are absolute on
    # purpose: a rerun next year must give the same split.
    first_valid_date: date = date(2023, 1, 1)
    last_valid_date: date = date(2024, 12, 31)

    # The date dimension reaches past the valid days as a safety net.
    spine_start: date = date(2023, 1, 1)
    spine_end: date = date(2026, 12, 31)

    # Years shown by the monthly trend.
    trend_years: tuple[int, ...] = (2023, 2024)

    # Two rows that agree on these columns are the same business event.
    business_key: tuple[str, ...] = ("account_id", "transaction_date", "amount", "category")

    status_spellings: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(STATUS_SPELLINGS))
    category_groups: dict[tuple[str, str], tuple[str, ...]] = field(default_factory=lambda: dict(CATEGORY_GROUPS))

    # By default duplicates are ranked over all rows, so an invalid row can be
    # the survivor. Set to rank valid rows among themselves only.
    dedup_after_validation: bool = False

    # Keep the date and status text as it arrived in _raw_date and _raw_status.
    keep_raw_values: bool = False
