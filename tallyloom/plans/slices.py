"""The fact in folders by month, read through the date dimension: only the months asked for are opened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import money

MONTH = "month_key"


def month_key(date_key: Column) -> Column:
    """yyyyMM of a day's yyyyMMdd."""
    return F.substring(date_key, 1, 6)


def write_by_month(facts: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Store a fact in one folder a month, each sorted by day; a month's rows are dealt to several tasks by account.

    Rows without a day share a folder that no month reaches.
    """
    spread = facts.withColumn(MONTH, month_key(F.col("date_key"))).repartition(MONTH, F.pmod(F.xxhash64("account_key"), F.lit(8)))
    spread.sortWithinPartitions(MONTH, "date_key").write.mode(mode).partitionBy(MONTH).parquet(folder)


def read_by_month(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema, T.StructField(MONTH, T.StringType())])).parquet(folder)


def spend_by_day(by_month: DataFrame, dates: DataFrame, asked: Column) -> DataFrame:
    """Debits of the days that a condition on the date dimension picks.

    The months of these days meet the folders' months first. That join prunes folders when the
    query runs (dynamic partition pruning), so the condition may be about any column of the
    dimension and the fact still opens nothing but the months it touches.
    """
    days = dates.filter(asked).select("date_key", month_key(F.col("date_key")).alias(MONTH))
    # The dimension is bounded by the settings' date spine.
    return (
        by_month.filter(F.col("transaction_type") == "debit")
        .join(F.broadcast(days), ["date_key", MONTH])
        .groupBy("date_key")
        .agg(money.total("amount").alias("total_spend"), F.count(F.lit(1)).alias("transaction_count"))
    )
