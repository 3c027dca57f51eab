"""Cleaned layer: from raw transactions to rows labelled with a rejection reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.config import Settings
from tallyloom.functions.codes import canonicalise
from tallyloom.functions.dates import parse_mixed_date
from tallyloom.functions.money import correct_amount
from tallyloom.functions.text import standardise
from tallyloom.operators import dedup, references, rules
from tallyloom.schemas import CORRUPT


def clean_columns(raw: DataFrame, settings: Settings) -> DataFrame:
    """Row-local cleaning; one projection over the scan, so unused columns are not read.

    The text of a line that the reader could not take apart stays beside it for the rules.
    """
    rows = raw
    if settings.keep_raw_values:
        rows = rows.withColumns({"_raw_date": F.col("transaction_date"), "_raw_status": F.col("status")})
    parsed = standardise(rows).withColumn("_parsed", parse_mixed_date(F.col("transaction_date")))
    dated = parsed.withColumns(
        {
            "transaction_date": F.col("_parsed.date"),
            "_date_ambiguous": F.col("_parsed.ambiguous"),
            "status": canonicalise(F.col("status"), settings.status_spellings),
        }
    ).drop("_parsed")
    return correct_amount(dated)


def label(raw: DataFrame, accounts: DataFrame, settings: Settings) -> DataFrame:
    """Every raw row, cleaned and with its rejection reason, or NULL if accepted.

    The same lazy plan at every size: no job starts here and nothing is written. The account
    check and the ranking both cut what belongs to one account or one key into parts. Rows of
    earlier parts of a key are counted from the cleaned key columns, so accounts are met once.
    """
    cleaned = clean_columns(raw, settings)
    tests = rules.row_rules(settings, CORRUPT in cleaned.columns)
    keys = list(settings.business_key)
    checked = references.flag_orphans(cleaned, accounts, "account_id")
    counted = cleaned
    if settings.dedup_after_validation:
        keys.append("_valid")
        counted = checked = checked.withColumn("_valid", rules.first_reason(tests).isNull())
    ranked = dedup.dedup_rank(checked, keys, counted=counted)
    reason = rules.first_reason([*tests, rules.duplicate_rule()])
    return ranked.select(*cleaned.columns, dedup.RANK, references.ORPHAN, reason.alias(rules.REASON))
