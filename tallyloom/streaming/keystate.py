"""Incremental settlement by key state: a lot reads only the key buckets that its own keys fall in.

Accepted business keys lie in folders by bucket: the month of the key's day and a hash of the
key. A lot looks up its keys there, so its cost follows what is new and the months it touches,
not all that was ever stored. Each lot writes folders of its own, which a second attempt of the
same lot replaces.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.config import Settings
from tallyloom.operators import dedup, rules

BUCKET, LOT, HELD = "_bucket", "_lot", "_held"
HASHES = 16  # hash buckets of a month


@dataclass(frozen=True)
class KeyState:
    """Where the rows and the accepted keys of a stream are stored."""

    spark: SparkSession
    folder: str
    keys: tuple[str, ...]
    day: str | None = None  # the part of the key that tells the month; without one, buckets are hashes alone
    hashes: int = HASHES

    @classmethod
    def of(cls, spark: SparkSession, folder: str, settings: Settings) -> KeyState:
        day = "transaction_date" if "transaction_date" in settings.business_key else None
        return cls(spark, folder, settings.business_key, day)

    def bucket(self) -> Column:
        mark = F.pmod(F.xxhash64(*self.keys), F.lit(self.hashes)).cast("string")
        return F.concat_ws("-", F.substring(F.col(self.day).cast("string"), 1, 7), mark) if self.day else mark

    def rows(self) -> DataFrame:
        """Every row of every lot, settled."""
        return self.spark.read.parquet(f"{self.folder}/rows").drop(LOT)

    def runs(self) -> DataFrame:
        """One row a lot: its number, rows, accepted rows, buckets it fell in and keys it read there."""
        return self.spark.read.parquet(f"{self.folder}/runs").withColumnRenamed(LOT, "lot")

    def accepted(self, spark: SparkSession, schema: T.StructType, before: int, buckets: list[str]) -> DataFrame:
        """Keys that earlier lots accepted, in the given buckets alone: folders of others are not opened."""
        fields = T.StructType([*(schema[name] for name in self.keys), T.StructField(BUCKET, T.StringType()), T.StructField(LOT, T.LongType())])
        if not before:
            return spark.createDataFrame([], fields)
        stored = spark.read.schema(fields).parquet(f"{self.folder}/keys")
        return stored.filter((F.col(LOT) < before) & F.col(BUCKET).isin(buckets))


def settle_lot(lot: DataFrame, state: KeyState, number: int) -> dict[str, int]:
    """Store the labelled rows of one lot, with repeats of accepted keys named DUPLICATE; returns its figures.

    Of the valid rows of a key the first stays: by lot, and within a lot by load and then by id.
    Rows that break a rule keep their reason and neither take part nor claim their key. An empty
    lot stores no rows. Keys may hold NULLs.
    """
    spark, valid = lot.sparkSession, F.col(rules.REASON).isNull()
    placed = lot.withColumns({"_valid": valid, BUCKET: F.when(valid, state.bucket())}).persist()
    try:
        # As many values as the lot has months, times the hashes of one.
        buckets = [row[0] for row in placed.filter("_valid").select(BUCKET).distinct().collect()]
        held = state.accepted(spark, lot.schema, number, buckets)
        keys_read = held.count()  # of the files' footers
        known = held.select(*[F.col(name).alias(f"{HELD}_{name}") for name in state.keys], F.col(BUCKET).alias(HELD))
        ranked = dedup.dedup_rank(placed, [*state.keys, "_valid"], newest=False, counted=placed)
        same = F.col(BUCKET) == F.col(HELD)  # NULL for rows that break a rule, so these meet nothing
        for name in state.keys:
            same = same & F.col(name).eqNullSafe(F.col(f"{HELD}_{name}"))
        repeated = (F.col(dedup.RANK) > 1) | F.col(HELD).isNotNull()
        reason = F.coalesce(F.col(rules.REASON), F.when(repeated, F.lit("DUPLICATE")))
        settled = ranked.join(known, same, "left").withColumn(rules.REASON, reason).select(*lot.columns, BUCKET)
        settled.drop(BUCKET).write.mode("overwrite").parquet(f"{state.folder}/rows/{LOT}={number}")
    finally:
        placed.unpersist()
    stored = spark.read.schema(lot.schema).parquet(f"{state.folder}/rows/{LOT}={number}")
    fresh = stored.filter(valid).select(*state.keys, state.bucket().alias(BUCKET)).repartition(BUCKET)
    fresh.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{state.folder}/keys/{LOT}={number}")
    rows, accepted = stored.agg(F.count(F.lit(1)), F.count_if(valid)).first()
    figures = {"rows": rows, "accepted": accepted, "buckets": len(buckets), "keys_read": keys_read}
    run = spark.createDataFrame([tuple(figures.values())], ", ".join(f"{name} long" for name in figures))
    run.write.mode("overwrite").parquet(f"{state.folder}/runs/{LOT}={number}")
    return figures


def settle_available(labelled: DataFrame, state: KeyState, checkpoint: str) -> None:
    """Settle what a stream of labelled rows has now, then stop; a batch of the stream is a lot.

    A batch that failed half-way comes again under its number and replaces what it left.
    """
    (
        labelled.writeStream.foreachBatch(lambda lot, number: settle_lot(lot, state, number) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
