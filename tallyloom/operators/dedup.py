"""Ranking of rows that share a business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_dedup_rank"
# Transaction ids of one piece of a key: the most rows of distinct ids that one task has to sort for it.
IDS_A_PIECE = 1_000_000


def newest_first() -> list[Column]:
    """Latest load first; within a load the lowest id, as its rows share one timestamp."""
    return [F.col("_ingested_at").desc(), F.col("transaction_id").asc()]


def dedup_rank(
    rows: DataFrame, keys: Sequence[str], ids_a_piece: int = IDS_A_PIECE, newest: bool = True, counted: DataFrame | None = None
) -> DataFrame:
    """Number the rows of each key from 1, in the order of ``newest_first`` (or oldest load first). NULL keys form groups like any other value.

    A key may hold a large part of all rows. Its rows are cut into pieces by load time and by
    ranges of the id, which keep the order; a window numbers each piece, and the count of the
    rows in earlier pieces of the key, from an aggregate over key columns only, shifts it. One
    plan serves every size: nothing is counted beforehand, and keys of one piece need no shift.
    ``counted`` may name a cheaper source of the same rows for that aggregate, such as a frame
    from before a join that keeps every row once.
    """
    piece = F.struct(F.col("_ingested_at"), F.floor(F.col("transaction_id") / ids_a_piece).alias("ids"))

    def place(frame: DataFrame) -> DataFrame:
        return frame.withColumns({"_key": F.struct(*keys), "_piece": piece})

    loaded = F.col("_piece._ingested_at")
    earlier = (
        Window.partitionBy("_key")
        .orderBy(loaded.desc() if newest else loaded.asc(), F.col("_piece.ids").asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        place(rows if counted is None else counted)
        .groupBy("_key", "_piece")
        .count()
        .withColumn("_before", F.sum("count").over(earlier))
        .filter(F.col("_before") > 0)
        .select("_key", "_piece", "_before")
    )
    within = Window.partitionBy("_key", "_piece").orderBy(F.col("transaction_id").asc())
    numbered = place(rows).withColumn(RANK, F.row_number().over(within)).join(shifts, ["_key", "_piece"], "left")
    return numbered.withColumn(RANK, (F.col(RANK) + F.coalesce("_before", F.lit(0))).cast("int")).select(*rows.columns, RANK)
