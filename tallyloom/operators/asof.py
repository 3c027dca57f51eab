"""As-of join: each row meets the version of its key that was valid on its day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(rows: DataFrame, versions: DataFrame, key: str, day: str, take: Sequence[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Rows with the columns ``take`` of the version that started last on or before their day.

    They are NULL if the key has no such version, if that version ended before the day (an open
    one has a NULL end), or if key or day are NULL. Of versions that start on one day the greater
    by value counts. Every row comes back once.

    No row is compared with all versions of its key: versions are laid into the months in which
    they start, the one in force when a month begins is carried into it, and inside a month the
    last start before each day counts. All that is done once for each key and day that occurs, so
    a busy key is as many small groups as it has months; then rows fetch their day by equality,
    where adaptive execution can split a busy one.
    """
    version = F.struct(F.col(start).alias("_start"), F.col(end).alias("_end"), *[F.col(name).alias(f"_take_{k}") for k, name in enumerate(take)])
    starts = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(start).alias("_day")).agg(F.max(version).alias("_version"))
    days = rows.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).select(F.col(key).alias("_key"), F.col(day).alias("_day")).distinct()
    month = F.trunc("_day", "month")

    last = F.max_by("_version", "_day").alias("_last")
    months = starts.groupBy("_key", month.alias("_month")).agg(last).unionByName(
        days.select("_key", month.alias("_month")).distinct(), allowMissingColumns=True
    ).groupBy("_key", "_month").agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    carried = months.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).select("_key", "_month", "_carried")

    events = starts.withColumn("_asked", F.lit(False)).unionByName(days.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    inside = Window.partitionBy("_key", "_month").orderBy("_day", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    found = events.withColumn("_month", month).withColumn("_found", F.last("_version", ignorenulls=True).over(inside)).filter("_asked")
    resolved = found.join(carried, ["_key", "_month"], "left").select("_key", "_day", F.coalesce("_found", "_carried").alias("_in_force"))
    valid = F.col("_in_force._end").isNull() | (F.col("_in_force._end") >= F.col("_day"))
    resolved = resolved.select("_key", "_day", F.when(valid, F.col("_in_force")).alias("_in_force"))

    joined = rows.join(resolved, (F.col(key) == F.col("_key")) & (F.col(day) == F.col("_day")), "left")
    return joined.select(*rows.columns, *[F.col(f"_in_force._take_{k}").alias(name) for k, name in enumerate(take)])
