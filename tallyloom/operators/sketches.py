"""Distinct counts of any period from sketches stored by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRECISION = 12  # 2^12 registers: a standard error of 1.04 / 64 of the count, 2 kB a day
# Four standard errors; small counts are nearly exact.
BOUND = 4 * 1.04 / 2 ** (PRECISION / 2)


def by_day(rows: DataFrame, value: str, day: str) -> DataFrame:
    """(day, sketch): a mergeable sketch of the distinct values of each day. NULL values do not count."""
    return rows.groupBy(day).agg(F.hll_sketch_agg(value, F.lit(PRECISION)).alias("sketch"))


def distinct_in(daily: DataFrame, period: Column, name: str) -> DataFrame:
    """(name, distinct): about how many distinct values each period holds, from the days' sketches alone."""
    merged = daily.groupBy(period.alias(name)).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(name, F.hll_sketch_estimate("sketch").alias("distinct"))
