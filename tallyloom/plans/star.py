"""Modelled layer: the star as linked frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.config import Settings
from tallyloom.operators.dimensions import account_dim, category_dim, date_dim
from tallyloom.operators.facts import fact


@dataclass(frozen=True)
class Star:
    facts: DataFrame
    dates: DataFrame
    accounts: DataFrame
    categories: DataFrame


def star(spark: SparkSession, clean: DataFrame, raw_accounts: DataFrame, settings: Settings) -> Star:
    """The four frames of the star, not yet evaluated."""
    return Star(
        facts=fact(clean),
        dates=date_dim(spark, settings),
        accounts=account_dim(raw_accounts),
        categories=category_dim(spark, settings),
    )


def usage(dimension: DataFrame, key: str, facts: DataFrame) -> DataFrame:
    """Rows of a dimension with the number of facts that refer to each."""
    used = facts.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return dimension.join(used, key, "left").withColumn("fact_rows", F.coalesce("fact_rows", F.lit(0)))
