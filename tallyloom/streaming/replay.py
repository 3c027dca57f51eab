"""Replay of quarantine: rows rejected for an unknown account are taken up when the account arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import references, rules
from tallyloom.schemas import CORRUPT

ORPHANED = "ORPHANED_ACCOUNT_ID"
WAIT = "30 days"


def taken_up(labelled: DataFrame, accounts: DataFrame, wait: str = WAIT) -> DataFrame:
    """Stream of the orphaned rows that are settled: their account came, or did not come in time.

    ``labelled`` is a stream of labelled rows and ``accounts`` one of arriving accounts, both with
    their load time. A row whose account arrives within ``wait`` before or after it comes out at
    once, with the reason that is left (a line that could not be read) or none. A row whose account
    does not come out keeps its reason and is given up when the watermark has passed ``wait``; the
    state holds rows and account ids no longer than that. An account that is sent again while it
    is remembered counts once; rows without an account id are orphans for good and are not held.
    """
    orphans = labelled.filter((F.col(rules.REASON) == ORPHANED) & F.col("account_id").isNotNull()).withWatermark("_ingested_at", wait)
    arrived = (
        accounts.filter(F.col("account_id").isNotNull())
        .select(F.col("account_id").alias("_arrived"), F.col("_ingested_at").alias("_arrived_at"))
        .withWatermark("_arrived_at", wait)
        .dropDuplicatesWithinWatermark(["_arrived"])
    )
    in_time = F.col("_arrived_at").between(F.col("_ingested_at") - F.expr(f"INTERVAL {wait}"), F.col("_ingested_at") + F.expr(f"INTERVAL {wait}"))
    joined = orphans.join(arrived, (F.col("account_id") == F.col("_arrived")) & in_time, "leftOuter")
    left_over = F.when(F.col(CORRUPT).isNotNull(), "MALFORMED_LINE") if CORRUPT in labelled.columns else F.lit(None).cast("string")
    came = F.col("_arrived").isNotNull()
    settled = joined.withColumns({rules.REASON: F.when(came, left_over).otherwise(F.col(rules.REASON)), references.ORPHAN: ~came})
    return settled.select(*labelled.columns)


def with_replays(labelled: DataFrame, replayed: DataFrame) -> DataFrame:
    """Stored labelled rows with the orphans that were taken up in their new state; every row is there once.

    All waiting rows of an account come out together with it, so an account among the replayed
    rows has none left waiting.
    """
    accounts = replayed.select(F.col("account_id").alias("_settled")).distinct()
    waiting = labelled.filter(F.col(rules.REASON) == ORPHANED).join(accounts, F.col("account_id") == F.col("_settled"), "left_anti")
    rest = labelled.filter(F.col(rules.REASON).isNull() | (F.col(rules.REASON) != ORPHANED))
    return rest.unionByName(waiting).unionByName(replayed)
