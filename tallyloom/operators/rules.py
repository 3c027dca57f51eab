"""Ordered rejection rules and the two sides they split the rows into."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.config import Settings
from tallyloom.functions import money
from tallyloom.operators.dedup import RANK
from tallyloom.operators.references import ORPHAN
from tallyloom.schemas import CORRUPT

REASON = "_rejection_reason"
HELPERS = (RANK, ORPHAN, REASON)


class Rule(NamedTuple):
    reason: str
    broken: Column


def row_rules(settings: Settings, from_file: bool = False) -> list[Rule]:
    """Rules that need nothing but the row and its account, first match first.

    A line of a file that could not be read as a whole breaks the last one, unless a cell that
    is missing for that already has a name of its own.
    """
    # The names of the reasons.
    day = F.col("transaction_date")
    unread = [Rule("MALFORMED_LINE", F.col(CORRUPT).isNotNull())] if from_file else []
    return [
        Rule("NULL_DATE", day.isNull()),
        Rule("OUT_OF_RANGE_DATE", ~day.between(F.lit(settings.first_valid_date), F.lit(settings.last_valid_date))),
        Rule("NULL_CATEGORY", F.coalesce(F.col("category"), F.lit("")) == ""),
        Rule("NULL_AMOUNT", F.col("amount").isNull()),
        Rule("NULL_TRANSACTION_TYPE", F.col("transaction_type").isNull()),
        Rule("INVALID_STATUS", F.col("status").isNull()),
        Rule("ORPHANED_ACCOUNT_ID", F.col(ORPHAN)),
        *unread,
    ]


def duplicate_rule() -> Rule:
    return Rule("DUPLICATE", F.col(RANK) > 1)


def first_reason(rules: Sequence[Rule]) -> Column:
    """Name of the first broken rule, NULL if none is. A NULL condition is not broken.

    One CASE, so the rules after the first broken one are not evaluated.
    """
    first, *others = rules
    named = F.when(first.broken, first.reason)
    for rule in others:
        named = named.when(rule.broken, rule.reason)
    return named


def clean(labelled: DataFrame) -> DataFrame:
    """Accepted rows, without the columns that only served the rules."""
    return labelled.filter(F.col(REASON).isNull()).drop(*HELPERS, CORRUPT)


def quarantine(labelled: DataFrame) -> DataFrame:
    """Rejected rows with the columns that explain why, stamped with the time."""
    return labelled.filter(F.col(REASON).isNotNull()).withColumn("_quarantined_at", F.current_timestamp())


def profile(quarantined: DataFrame) -> DataFrame:
    """Rejected rows by reason, most frequent first."""
    return quarantined.groupBy(REASON).count().orderBy(F.desc("count"), REASON)


def split_counts() -> dict[str, Column]:
    """Aggregates over labelled rows; also usable as metrics observed during a write."""
    return {
        "bronze_rows": F.count(F.lit(1)),
        "clean_rows": F.count_if(F.col(REASON).isNull()),
        "rejected_rows": F.count_if(F.col(REASON).isNotNull()),
    }


def dq_summary(labelled: DataFrame) -> DataFrame:
    """Input, accepted and rejected rows and their shares, in one pass."""
    counts = labelled.agg(*[count.alias(name) for name, count in split_counts().items()])
    return counts.withColumns(
        {
            "clean_pct": money.share(F.col("clean_rows"), F.col("bronze_rows"), 1),
            "rejected_pct": money.share(F.col("rejected_rows"), F.col("bronze_rows"), 1),
        }
    )
