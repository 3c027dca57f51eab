"""History of account attributes, one row per version (a type 2 dimension)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.keys import surrogate_key


def account_history(snapshots: DataFrame, tracked: Sequence[str], day: str = "snapshot_date") -> DataFrame:
    """Versions of each account from dated snapshots of all accounts.

    A version starts on the day its tracked columns differ from the snapshot before and
    ends the day before the next one starts; the last one is open. An account counts
    once per day, which pre-aggregates copies and bounds its group by the number of days.
    """
    daily = snapshots.groupBy("account_id", day).agg(F.max(F.struct(*tracked)).alias("state"))
    by_day = Window.partitionBy("account_id").orderBy(day)
    previous = F.lag("state").over(by_day)
    versions = (
        daily.withColumn("previous", previous)
        .withColumn("first", F.lag(day).over(by_day).isNull())
        .filter(F.col("first") | ~F.col("state").eqNullSafe(F.col("previous")))
    )
    next_start = F.lead(day).over(by_day)
    return versions.select(
        surrogate_key(F.concat_ws("|", F.col("account_id"), F.col(day))).alias("account_version_key"),
        surrogate_key(F.col("account_id")).alias("account_key"),
        "account_id",
        *[F.col("state")[name].alias(name) for name in tracked],
        F.row_number().over(by_day).alias("version"),
        F.col(day).alias("valid_from"),
        F.date_sub(next_start, 1).alias("valid_to"),
        next_start.isNull().alias("is_current"),
    )
