"""Transactions that repeat each other nearly: what the duplicate rank leaves apart."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.config import Settings
from tallyloom.functions import money
from tallyloom.operators import bands, rules

CENT = Decimal("0.01")


def near_repeats(labelled: DataFrame, settings: Settings, days: int = 1, amount: Decimal = CENT) -> DataFrame:
    """Pairs of business keys of one account whose days and amounts differ by at most the given widths.

    Rows that break no rule count, repeats among them: rows of one key are one class, named by its
    least transaction id and with its number of rows, so exact copies are never paired. Both keys
    of a pair differ in day, amount or category.
    """
    valid = labelled.filter(F.col(rules.REASON).isNull() | (F.col(rules.REASON) == "DUPLICATE"))
    classes = valid.groupBy(*settings.business_key).agg(F.min("transaction_id").alias("first_id"), F.count(F.lit(1)).alias("rows"))
    classes = classes.withColumns({"cents": money.exact("amount"), "day": F.datediff("transaction_date", F.lit("1970-01-01"))})
    pairs = bands.near_pairs(classes, ["account_id"], {"day": days, "cents": amount}, "first_id")
    return pairs.select(
        F.col("left.account_id").alias("account_id"),
        F.col("left.first_id").alias("left_id"),
        F.col("right.first_id").alias("right_id"),
        F.col("left.rows").alias("left_rows"),
        F.col("right.rows").alias("right_rows"),
        (F.col("right.day") - F.col("left.day")).alias("days_apart"),
        money.cents(F.col("right.cents") - F.col("left.cents")).alias("amount_apart"),
    )
