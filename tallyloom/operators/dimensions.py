"""The three dimensions of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.config import Settings
from tallyloom.functions.dates import parse_mixed_date
from tallyloom.functions.keys import category_key, date_key, surrogate_key
from tallyloom.functions.text import title_case


def date_dim(spark: SparkSession, settings: Settings) -> DataFrame:
    """One row per day of the spine. Weeks are ISO weeks, years calendar years."""
    length = (settings.spine_end - settings.spine_start).days + 1
    day = F.col("full_date")
    days = spark.range(0, length, 1, 1).select(
        F.date_add(F.lit(settings.spine_start), F.col("id").cast("int")).alias("full_date")
    )
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        (F.dayofmonth(F.date_add(day, 1)) == 1).alias("is_month_end"),
        (F.dayofmonth(day) == 1).alias("is_month_start"),
    )


def account_dim(raw_accounts: DataFrame) -> DataFrame:
    """Raw accounts with settled text, a parsed opening date and their key."""
    return raw_accounts.select(
        surrogate_key(F.col("account_id")).alias("account_key"),
        "account_id",
        *[F.trim(title_case(F.col(name))).alias(name) for name in ("customer_name", "account_type", "region")],
        parse_mixed_date(F.col("created_date"))["date"].alias("created_date"),
    )


def category_dim(spark: SparkSession, settings: Settings) -> DataFrame:
    """Business grouping of the categories, which no source system holds.

    The rows are one literal in the plan, read by one task however big the cluster is.
    """
    rows = [
        F.struct(
            F.lit(name).alias("category_name"), F.lit(group).alias("category_group"), F.lit(flow).alias("category_type")
        )
        for (group, flow), names in settings.category_groups.items()
        for name in names
    ]
    named = spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
    return named.select(category_key(F.col("category_name")).alias("category_key"), *named.columns)
