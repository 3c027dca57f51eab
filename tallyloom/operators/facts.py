"""The fact table and the audit of its foreign keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.keys import category_key, date_key, surrogate_key


def fact(clean: DataFrame) -> DataFrame:
    """Accepted transactions with keys in place of the natural ids."""
    return clean.select(
        surrogate_key(F.col("transaction_id")).alias("transaction_key"),
        surrogate_key(F.col("account_id")).alias("account_key"),
        date_key(F.col("transaction_date")).alias("date_key"),
        category_key(F.col("category")).alias("category_key"),
        "amount",
        "transaction_type",
        "status",
        "_amount_corrected",
        "_date_ambiguous",
        "_ingested_at",
    )


def _members(dimension: DataFrame, key: str) -> DataFrame:
    return dimension.select(F.col(key).alias(f"_known_{key}")).distinct()


def fk_audit(facts: DataFrame, accounts: DataFrame, dates: DataFrame, categories: DataFrame) -> DataFrame:
    """Fact rows without a row in each dimension, as one row of counts; NULL keys count.

    One scan: the day and category keys are looked up in broadcasts that the settings
    bound, then rows are summed by account, so a busy account reaches the join with the
    unbounded account dimension as a single row.
    """
    checked = facts.join(
        F.broadcast(_members(dates, "date_key")), F.col("date_key") == F.col("_known_date_key"), "left"
    ).join(
        F.broadcast(_members(categories, "category_key")),
        F.col("category_key") == F.col("_known_category_key"),
        "left",
    )
    per_account = checked.groupBy("account_key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_known_date_key").isNull()).alias("no_date"),
        F.count_if(F.col("_known_category_key").isNull()).alias("no_category"),
    )
    matched = per_account.join(
        _members(accounts, "account_key"), F.col("account_key") == F.col("_known_account_key"), "left"
    )
    none = F.lit(0).cast("long")
    no_account = F.when(F.col("_known_account_key").isNull(), F.col("rows")).otherwise(none)
    return matched.agg(
        F.coalesce(F.sum(no_account), none).alias("orphaned_accounts"),
        F.coalesce(F.sum("no_date"), none).alias("orphaned_dates"),
        F.coalesce(F.sum("no_category"), none).alias("orphaned_categories"),
    )
