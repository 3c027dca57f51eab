"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import shared_folder

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends, nothing is computed twice."""
    spark = frame.sparkSession
    path = scratch(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def kept_on_disk(frame: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame on the executors' disks while it is read more than once.

    Unlike ``stored`` that writes no file for each task, so no executor starts a process to set the
    rights of one, as Hadoop's local file system does. What a lost executor held is computed again.
    """
    frame.persist(StorageLevel.DISK_ONLY)
    try:
        yield frame
    finally:
        frame.unpersist()


def held_out(doc_id: Column) -> Column:
    """Rows that no model of this subpackage may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(labels: DataFrame, documents: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled texts to learn from: (doc_id, text, y), none of them held out.

    Rows are taken in the order of a hash of doc_id, so the sample is the same on each run.
    Labels other than 0 and 1 and repeated ids with differing labels are left out.
    """
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("other"))
        .filter(F.col("y") == F.col("other"))
        .select("doc_id", "y")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `most` ids
    first = F.min_by("text", F.xxhash64("text"))
    return texts.groupBy("doc_id").agg(first.alias("text"), F.first("y").alias("y")).filter("text is not null")


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """Values of a binary column, null as empty."""
    return [value or b"" for value in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Gather tuples into record batches."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
