"""Batch ingest of the raw CSV files into the raw layer."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import schemas
from tallyloom.sources.tables import RAW, Layers, View


@dataclass(frozen=True)
class CsvSource:
    """A header CSV in the landing folder: one file, or a folder of part files."""

    file: str
    schema: T.StructType


SOURCES: dict[str, CsvSource] = {
    "transactions": CsvSource("transactions_raw.csv", schemas.TRANSACTIONS),
    "accounts": CsvSource("accounts_raw.csv", schemas.ACCOUNTS),
    "budget": CsvSource("budget_raw.csv", schemas.BUDGET),
}

# Blank cells read as NULL; a line that does not fit keeps its text in the corrupt
# column. A header that differs from the declared names is an error, not a silent
# shift of columns.
READ_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "enforceSchema": "false",
    "columnNameOfCorruptRecord": schemas.CORRUPT,
    # A query for few columns must still see that a line has too many or too few cells.
    "columnPruning": "false",
}


def stamp(rows: DataFrame, file: str) -> DataFrame:
    """Provenance: one load timestamp for all rows and the name of their source."""
    return rows.withColumns({"_ingested_at": F.current_timestamp(), "_source_file": F.lit(file)})


def read_csv(spark: SparkSession, landing: str, source: CsvSource) -> DataFrame:
    """Stamped rows of one source; a single pass, since nothing is inferred."""
    reader = spark.read.schema(schemas.with_corrupt_column(source.schema)).options(**READ_OPTIONS)
    return stamp(reader.csv(f"{landing}/{source.file}"), source.file)


def write_csv(rows: DataFrame, landing: str, source: CsvSource, mode: str = "overwrite") -> None:
    """Write rows in the layout ``read_csv`` reads, blanks around text included."""
    (
        rows.select(source.schema.names)
        .write.mode(mode)
        .options(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .csv(f"{landing}/{source.file}")
    )


def ingest(layers: Layers, landing: str, sources: Mapping[str, CsvSource] = SOURCES) -> dict[str, int]:
    """Replace the raw tables by their files, all at once; returns the rows written per table."""
    layers.create(RAW)
    version = layers.new_version()
    staged = {table: layers.stage(RAW, table, read_csv(layers.spark, landing, source), version) for table, source in sources.items()}
    layers.publish(RAW, version, {table: View(rows) for table, rows in staged.items()})
    return {table: rows.counts["rows"] for table, rows in staged.items()}
