"""Contracts across rows and runs: repeated keys, broken references, and shifts against the last run's histogram."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Population stability index from which a distribution counts as shifted.
SHIFTED = 0.2


def histogram(rows: DataFrame, bins: Mapping[str, Column]) -> DataFrame:
    """(subject, bin, rows) of every named expression, from one pass; a NULL is a bin of its own.

    This is what a run stores for the next one: as many rows as there are bins.
    """
    each = [F.struct(F.lit(name).alias("subject"), value.cast("string").alias("bin")) for name, value in bins.items()]
    return rows.select(F.explode(F.array(*each)).alias("one")).groupBy("one.subject", "one.bin").agg(F.count(F.lit(1)).alias("rows"))


def shifts(now: DataFrame, before: DataFrame, limit: float = SHIFTED) -> DataFrame:
    """(contract, subject, value, passed): how far each subject's bins moved between two histograms.

    The index sums (p - q) ln(p / q) over the bins of either run, p and q being their shares with
    half a row added to each bin, so that a bin that only one run has counts and no share is 0.
    """
    both = now.select("subject", "bin", F.col("rows").alias("n")).join(
        before.select(F.col("subject").alias("_subject"), F.col("bin").alias("_bin"), F.col("rows").alias("m")),
        F.col("subject").eqNullSafe(F.col("_subject")) & F.col("bin").eqNullSafe(F.col("_bin")), "full",
    )
    both = both.select(F.coalesce("subject", "_subject").alias("subject"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("m", F.lit(0)).alias("m"))
    totals = both.groupBy("subject").agg(F.sum("n").alias("all_n"), F.sum("m").alias("all_m"), F.count(F.lit(1)).alias("bins"))
    p = (F.col("n") + 0.5) / (F.col("all_n") + 0.5 * F.col("bins"))
    q = (F.col("m") + 0.5) / (F.col("all_m") + 0.5 * F.col("bins"))
    index = both.join(totals, "subject").groupBy("subject").agg(F.round(F.sum((p - q) * F.ln(p / q)), 6).alias("value"))
    return index.select(F.lit("no_shift").alias("contract"), "subject", "value", (F.col("value") < limit).alias("passed"))


def repeats(rows: DataFrame, keys: Sequence[str], subject: str) -> DataFrame:
    """(contract, subject, value, passed): rows beyond the first of their key. Keys are counted in tasks first, so a busy one is no hot group."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    value = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("double")
    return counted.agg(value.alias("value")).select(F.lit("unique").alias("contract"), F.lit(subject).alias("subject"), "value", (F.col("value") == 0).alias("passed"))


def unmatched(rows: DataFrame, key: str, parents: DataFrame, subject: str, most_share: float = 0.0) -> DataFrame:
    """(contract, subject, value, passed): the share of rows whose key no parent has; rows are summed by key before they meet the parents."""
    by_key = rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    known = parents.select(F.col(key).alias("_parent")).filter(F.col("_parent").isNotNull()).distinct()
    lost = F.sum(F.when(F.col("_parent").isNull(), F.col("n")).otherwise(0))
    share = F.round(F.coalesce(lost / F.sum("n"), F.lit(0.0)), 6)
    joined = by_key.join(known, F.col("_key") == F.col("_parent"), "left")
    return joined.agg(share.alias("value")).select(F.lit("known").alias("contract"), F.lit(subject).alias("subject"), "value", (F.col("value") <= most_share).alias("passed"))
