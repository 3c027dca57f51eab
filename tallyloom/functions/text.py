"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def title_case(text: Column) -> Column:
    """Upper-case first letter of each space-separated word, the rest lower."""
    return F.initcap(text)


def standardise(rows: DataFrame) -> DataFrame:
    """Trim the four text columns of a transaction; settle the case of two of them.

    Only spaces are trimmed. A description keeps its case, a status is settled later
    by its own lookup.
    """
    return rows.withColumns(
        {
            "category": title_case(F.trim("category")),
            "description": F.trim("description"),
            "transaction_type": F.lower(F.trim("transaction_type")),
            "status": F.trim("status"),
        }
    )
