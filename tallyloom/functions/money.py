"""Amounts: sign correction, exact totals and averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Double sums depend on the order in which partitions arrive. Amounts are summed as
# decimals, wide enough for six decimal places, and only the result becomes a double.
EXACT = "decimal(28,6)"
# Amounts from here on are no amounts: they would not fit the sum of a large table.
TOO_LARGE = 1e15


def correct_amount(rows: DataFrame) -> DataFrame:
    """Make amounts positive and flag the rows whose sign was changed.

    What is not a finite number below ``TOO_LARGE`` becomes NULL, so it is rejected by name
    instead of missing from sums; its text stays in the raw layer.
    """
    number = F.col("amount").try_cast("double")
    amount = F.when(F.abs(number) < TOO_LARGE, number)  # NaN is greater than any number
    return rows.withColumns(
        {
            "_amount_corrected": F.coalesce(amount < 0, F.lit(False)),
            "amount": F.abs(amount),
        }
    )


def exact(amount: Column | str) -> Column:
    return F.col(amount).cast(EXACT) if isinstance(amount, str) else amount.cast(EXACT)


def cents(total: Column) -> Column:
    """Round an exact total to two places and hand it out as a double."""
    return F.round(total, 2).cast("double")


def total(amount: Column | str) -> Column:
    return cents(F.sum(exact(amount)))


def average(amount: Column | str) -> Column:
    """Exact sum over the number of amounts that are present, then rounded."""
    value = exact(amount)
    # These operand types leave the quotient 16 decimal places, so rounding it to cents
    # cannot meet a tie that an earlier rounding made.
    return cents(F.try_divide(F.sum(value).cast(EXACT), F.count(value).cast("decimal(18,0)")))


def total_where(amount: Column | str, condition: Column) -> Column:
    """Exact, unrounded total of the rows that meet the condition; 0 if none does."""
    return F.sum(F.when(condition, exact(amount)).otherwise(F.lit(0).cast(EXACT)))


def share(part: Column, whole: Column, places: int) -> Column:
    """Percentage of ``part`` in ``whole``; NULL for an empty whole."""
    return F.round(F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)")), places).cast("double")
