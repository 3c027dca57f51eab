"""Assertions on a table, reported instead of enforced."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.config import Settings


def contract_report(rows: DataFrame, contracts: Mapping[str, Column]) -> DataFrame:
    """Checked and failed rows per named contract; all contracts share one pass.

    A row for which the condition is NULL does not meet it.
    """
    failures = [F.count_if(~F.coalesce(holds, F.lit(False))) for holds in contracts.values()]
    results = [
        F.struct(F.lit(name).alias("contract"), failed.alias("failed_rows"))
        for name, failed in zip(contracts, failures)
    ]
    totals = rows.agg(F.count(F.lit(1)).alias("checked_rows"), F.array(*results).alias("results"))
    return totals.select("checked_rows", F.inline("results")).select(
        "contract", "checked_rows", "failed_rows", (F.col("failed_rows") == 0).alias("passed")
    )


def clean_contracts(settings: Settings) -> dict[str, Column]:
    """What every accepted transaction promises to the model."""
    known = [name for names in settings.category_groups.values() for name in names]
    return {
        "amount_not_negative": F.col("amount") >= 0,
        "category_known": F.col("category").isin(known),
        "date_in_bounds": F.col("transaction_date").between(
            F.lit(settings.first_valid_date), F.lit(settings.last_valid_date)
        ),
        "date_unambiguous": ~F.col("_date_ambiguous"),
        "status_canonical": F.col("status").isin(list(settings.status_spellings)),
        "type_credit_or_debit": F.col("transaction_type").isin("credit", "debit"),
    }
