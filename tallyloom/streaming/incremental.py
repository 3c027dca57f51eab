"""Incremental ingest and cleaning of files as they arrive.

Each call handles what is new since the last one and ends. The checkpoint remembers
the files already read and the keys already accepted, and makes the sink exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.config import Settings
from tallyloom.operators import dedup, references, rules
from tallyloom.plans.silver import clean_columns
from tallyloom.sources.csv import READ_OPTIONS, CsvSource, stamp


def arriving(spark: SparkSession, landing: str, source: CsvSource, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the stamped rows of one source, whose files arrive in its folder."""
    reader = spark.readStream.schema(schemas.with_corrupt_column(source.schema)).options(**READ_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return stamp(reader.csv(f"{landing}/{source.file}"), source.file)


def append_available(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Append the rows available now to a Parquet folder, then stop."""
    (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def label_stream(rows: DataFrame, accounts: DataFrame, settings: Settings) -> DataFrame:
    """Clean a stream and give each row the reason of the first row rule it breaks.

    Duplicates are not ranked here: that needs all rows of a key, which a stream never
    has. ``settle`` ranks what has been stored; ``accepted_once`` remembers keys instead.
    """
    checked = references.flag_orphans(clean_columns(rows, settings), accounts, "account_id")
    return checked.withColumn(rules.REASON, rules.first_reason(rules.row_rules(settings, schemas.CORRUPT in checked.columns)))


def accepted_once(labelled: DataFrame, settings: Settings, remember: str) -> DataFrame:
    """Accepted rows, the first of each business key within the time remembered.

    State is kept per key for that time only, so it stays bounded on an endless stream.
    """
    return (
        labelled.filter(labelled[rules.REASON].isNull())
        .drop(references.ORPHAN, rules.REASON)
        .withWatermark("_ingested_at", remember)
        .dropDuplicatesWithinWatermark(list(settings.business_key))
    )


def settle(stored: DataFrame, settings: Settings) -> DataFrame:
    """Stored rows of ``label_stream`` with repeats named DUPLICATE; every landed row is there once.

    Of the valid rows of a business key the first to arrive stays, by load and then by id, so a
    row that was accepted once is never displaced by a later one. Rows that break a row rule do
    not take part: unlike the batch, which ranks all rows before their validity counts.
    """
    valid = stored.withColumn("_valid", F.col(rules.REASON).isNull())
    ranked = dedup.dedup_rank(valid, [*settings.business_key, "_valid"], newest=False)
    reason = F.coalesce(F.col(rules.REASON), F.when(F.col(dedup.RANK) > 1, F.lit("DUPLICATE")))
    return ranked.withColumn(rules.REASON, reason).select(*stored.columns)
