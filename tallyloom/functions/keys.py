"""Deterministic keys: the same natural key gives the same key in every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(natural_key: Column) -> Column:
    """SHA-256 hex digest of the natural key as text; NULL stays NULL."""
    return F.sha2(natural_key.cast("string"), 256)


def category_key(name: Column) -> Column:
    """Categories are keyed without regard to case."""
    return surrogate_key(F.lower(name))


def date_key(day: Column) -> Column:
    """Calendar day as yyyyMMdd text; dropping the dashes is far cheaper than a formatter."""
    return F.translate(day.cast("string"), "-", "")
