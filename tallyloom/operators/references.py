"""Checks of one table's references against another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORPHAN = "_orphaned_account"


def flag_orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Flag the rows whose ``key`` no parent has; a NULL key is an orphan.

    The parents may outgrow memory, so there is no broadcast hint: Spark broadcasts the ids
    when they are under its size threshold and else joins by sorting. There, adaptive execution
    splits the partition of a busy parent by its measured size (``session.SESSION_CONF``) and
    reads that parent's one id once for each part; all other parents are read once.
    """
    known = parents.select(F.col(key).alias("_parent")).filter(F.col("_parent").isNotNull()).distinct()
    joined = rows.join(known, F.col(key) == F.col("_parent"), "left")
    return joined.withColumn(ORPHAN, F.col("_parent").isNull()).drop("_parent")
