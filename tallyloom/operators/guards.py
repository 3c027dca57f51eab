"""Checks that stop a load before it writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(rows: DataFrame, *columns: str) -> DataFrame:
    """NULLs per column as ``null_<column>``, one row, one pass."""
    return rows.agg(*[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in columns])


def require_zero(counts: DataFrame, problem: str) -> None:
    """Raise if any count in a one-row frame is not 0."""
    found = {name: count for name, count in counts.first().asDict().items() if count}
    if found:
        raise ValueError(f"{problem}: {found}")
