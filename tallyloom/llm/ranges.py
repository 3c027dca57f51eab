"""Key ranges of like weight, the same for the same rows however they are partitioned."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = -(1 << 63)  # stands for a null key: first in the order
FAN = 256


def _settled(key: Column | str) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(column.cast("long"), F.lit(LEAST))


def _weights(rows: DataFrame, open_ranges: list[tuple[int, int, int]]) -> dict[int, int]:
    """Weight by the first key of each part of the open ranges; a range is cut in parts of one width."""
    lows, highs = (np.array([r[k] for r in open_ranges], dtype=np.int64) for k in (0, 1))
    widths = np.array([(high - low) // FAN + 1 for low, high, _ in open_ranges], dtype=np.uint64)

    @F.pandas_udf("long")
    def part(keys: pd.Series) -> pd.Series:
        key = keys.to_numpy(np.int64)
        at = np.maximum(np.searchsorted(lows, key, "right") - 1, 0)
        inside = (key >= lows[at]) & (key <= highs[at])
        steps = (key.view(np.uint64) - lows[at].view(np.uint64)) // widths[at]  # differences may pass 63 bits, not 64
        first = (lows[at].view(np.uint64) + steps * widths[at]).view(np.int64)
        return pd.Series(first).where(pd.Series(inside)).astype("Int64")

    parts = rows.select(part("key").alias("part"), "weight").filter("part is not null")
    return {r.part: r.weight for r in parts.groupBy("part").agg(F.sum("weight").alias("weight")).toLocalIterator()}


def cuts(rows: DataFrame, key: Column | str, weight: Column, shards: int) -> list[int]:
    """First keys of the second and all later of at most ``shards`` ranges of about equal weight.

    Weights are summed exactly by parts of the key space, and a part that is heavier than a
    quarter of a shard is cut in 256 again until it is light or one key. So the cuts depend on the
    rows alone, not on a sample, and at most 256 sums for each quarter of a shard reach the driver.
    Null keys come first; one key is never cut, its range may be heavier. No rows, no cuts.
    """
    narrow = rows.select(_settled(key).alias("key"), weight.cast("long").alias("weight"))
    low, high, total = narrow.agg(F.min("key"), F.max("key"), F.sum("weight")).first()
    if not total:
        return []
    most, light, heavy = max(total // (4 * shards), 1), [], [(low, high, total)]
    while heavy:
        parts = _weights(narrow, heavy)
        starts, found = [r[0] for r in heavy], []
        for first, held in parts.items():
            low, high, _ = heavy[bisect_right(starts, first) - 1]
            width = (high - low) // FAN + 1
            found.append((first, min(first + width - 1, high), held))
        light += [r for r in found if r[2] <= most or r[0] == r[1]]
        heavy = sorted(r for r in found if r[2] > most and r[0] < r[1])
    chosen, before, last = [], 0, 0
    for first, _, held in sorted(light):
        shard = min((before + held // 2) * shards // total, shards - 1)
        if shard > last and before:
            chosen.append(first)
        last, before = shard, before + held
    return chosen


def shard_of(key: Column | str, chosen: list[int]) -> Column:
    """Number of the range that a key falls in, from 0."""
    firsts = np.array(chosen, dtype=np.int64)

    @F.pandas_udf("int")
    def number(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(firsts, keys.to_numpy(np.int64), "right").astype(np.int32))

    return number(_settled(key)) if chosen else F.lit(0)


def by_shard(rows: DataFrame, key: str, chosen: list[int], order: list[str | Column], shard: str = "shard") -> DataFrame:
    """The rows with their range's number, one partition for each range, sorted in it."""
    placed = rows.withColumn(shard, shard_of(key, chosen))
    return placed.repartitionById(len(chosen) + 1, F.col(shard)).sortWithinPartitions(shard, *order)
