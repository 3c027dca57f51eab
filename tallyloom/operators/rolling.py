"""Sums over the days before each row, and running sums, with busy keys cut into pieces of time."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling(rows: DataFrame, key: str, day: str, order: str, windowed: Mapping[str, Column], running: Mapping[str, Column], days: int) -> DataFrame:
    """Add each ``windowed`` value summed over the last ``days`` days, and each ``running`` value summed up to the row.

    A window holds the row's day and the ``days`` - 1 before it, with all rows of these days. A
    running sum follows the day and, within a day, ``order``. Values must be exact (decimals), so
    the sums do not depend on how rows are partitioned; a NULL value counts as 0. Rows without a
    day get NULL sums; NULL keys are a key of their own.

    The rows of a key are cut into pieces of time as wide as the window. A window reaches back at
    most into the piece before, whose sums by day are carried over as boundary rows; a running sum
    adds the totals of earlier pieces, from an aggregate of one row a piece. So no task needs all
    rows of a busy key.
    """
    piece = F.floor(F.datediff(F.col(day), F.lit(date(1970, 1, 1))) / days)
    names = {f"_value_{k}": value for k, value in enumerate([*windowed.values(), *running.values()])}
    in_window, in_running = list(names)[: len(windowed)], list(names)[len(windowed) :]
    zero = {name: F.coalesce(value, F.lit(0)) for name, value in names.items()}
    placed = rows.withColumns({**zero, "_piece": piece, "_number": F.datediff(F.col(day), F.lit(date(1970, 1, 1)))})

    dated = placed.filter(F.col(day).isNotNull())
    by_day = dated.groupBy(F.col(key).alias("_key"), "_piece", "_number").agg(*[F.sum(name).alias(name) for name in in_window])
    carried = by_day.withColumns({"_piece": F.col("_piece") + 1, "_own": F.lit(False)})
    own = placed.select("*", F.col(key).alias("_key"), F.lit(True).alias("_own"))
    both = own.unionByName(carried, allowMissingColumns=True)

    last_days = Window.partitionBy("_key", "_piece").orderBy("_number").rangeBetween(-(days - 1), 0)
    so_far = Window.partitionBy("_key", "_piece").orderBy("_number", order).rowsBetween(Window.unboundedPreceding, 0)
    summed = both.withColumns(
        {name: F.sum(held).over(last_days) for name, held in zip(windowed, in_window)}
        | {name: F.sum(held).over(so_far) for name, held in zip(running, in_running)}
    ).filter("_own")

    totals = dated.groupBy(F.col(key).alias("_total_key"), F.col("_piece").alias("_total_piece")).agg(*[F.sum(name).alias(f"_total{name}") for name in in_running])
    earlier = Window.partitionBy("_total_key").orderBy("_total_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_total_key", "_total_piece", *[F.sum(f"_total{name}").over(earlier).alias(f"_before{name}") for name in in_running])
    joined = summed.join(before, F.col("_key").eqNullSafe(F.col("_total_key")) & (F.col("_piece") == F.col("_total_piece")), "left")
    full = {name: F.col(name) + F.coalesce(F.col(f"_before{held}"), F.lit(0)) for name, held in zip(running, in_running)}
    sums = {name: F.col(name) for name in windowed} | full
    return joined.select(*rows.columns, *[F.when(F.col(day).isNotNull(), value).alias(name) for name, value in sums.items()])
