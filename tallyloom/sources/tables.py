"""Tables of the three layers, addressed as [catalog.]layer.table.

The tables a reader knows are views. Each run writes a version of its own beside those before,
and the views show the version that the layer's ``published`` table names last. So the tables of
a layer change together, by one appended row, and until then readers see the version before.
"""

from __future__ import annotations

import time
import uuid
import zlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RAW, CLEANED, MODELLED = "bronze", "silver", "gold"
VERSION, PUBLISHED = "_version", "published"


@dataclass(frozen=True)
class Staged:
    """One version of a table that no reader sees yet, and figures of its write."""

    table: str
    rows: DataFrame
    counts: dict[str, int]


@dataclass(frozen=True)
class View:
    """Columns and rows of a staged table that a reader knows under the view's name."""

    of: Staged
    columns: Sequence[str] | None = None
    condition: str = "true"


@dataclass(frozen=True)
class Layers:
    """Where the layers live. ``location`` puts table files under a folder of its own."""

    spark: SparkSession
    catalog: str | None = None
    location: str | None = None
    format: str = "parquet"
    prefix: str = ""  # of the layers' names, for runs beside each other

    def name(self, layer: str, table: str | None = None) -> str:
        return ".".join(part for part in (self.catalog, f"{self.prefix}{layer}", table) if part)

    def create(self, layer: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.name(layer)}")

    def drop(self, *layers: str) -> None:
        """Remove layers and what they hold in the catalog; files under ``location`` stay."""
        for layer in layers:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.name(layer)} CASCADE")

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def _save(self, layer: str, table: str, rows: DataFrame, mode: str, partition_by: Sequence[str], metrics: Mapping[str, Column]) -> dict[str, int]:
        """Write a table and return metrics gathered by the write itself.

        The metrics sit directly below the write, in the stage whose tasks count once
        even if an executor is lost, so no second read is needed for the row counts.
        """
        observed = Observation()
        writer = rows.observe(observed, *[metric.alias(name) for name, metric in metrics.items()]).write.format(self.format).mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.location:
            writer = writer.option("path", f"{self.location}/{layer}/{table}")
        writer.saveAsTable(self.name(layer, table))
        return observed.get

    def write(self, layer: str, table: str, rows: DataFrame) -> int:
        """Overwrite a plain table, which has no versions and is missing while it is replaced."""
        return self._save(layer, table, rows, "overwrite", (), {"rows": F.count(F.lit(1))})["rows"]

    def new_version(self) -> str:
        """A name for the next version, greater than those before."""
        return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def stage(
        self, layer: str, table: str, rows: DataFrame, version: str, metrics: Mapping[str, Column] | None = None, partition_by: Sequence[str] = ()
    ) -> Staged:
        """Write a version of a table for ``publish``. Versions of one table share their columns; others begin a table of their own."""
        stored = f"{table}_{zlib.crc32(rows.schema.simpleString().encode()):08x}"
        marked = rows.withColumn(VERSION, F.lit(version))
        counts = self._save(layer, stored, marked, "append", [VERSION, *partition_by], metrics or {"rows": F.count(F.lit(1))})
        return Staged(stored, self.read(layer, stored).filter(F.col(VERSION) == version).select(*rows.columns), counts)

    def publish(self, layer: str, version: str, views: Mapping[str, View]) -> None:
        """Show a version: all views of the layer turn to it with one appended row.

        Views are defined anew only if their text changes, so a run with the columns of the last
        one changes nothing but that row. Versions before the last two are removed.
        """
        pointer = self.name(layer, PUBLISHED)
        place = f" LOCATION '{self.location}/{layer}/{PUBLISHED}'" if self.location else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {pointer} (version STRING) USING {self.format}{place}")
        for name, view in views.items():
            columns = ", ".join(f"`{column}`" for column in view.columns or view.of.rows.columns)
            self._define(layer, name, f"SELECT {columns} FROM {self.name(layer, view.of.table)} WHERE {VERSION} = (SELECT max(version) FROM {pointer}) AND {view.condition}")
        self._commit(pointer, version)
        self._remove_old(layer, {view.of.table for view in views.values()}, version)

    def _define(self, layer: str, name: str, text: str) -> None:
        mark = f"{zlib.crc32(text.encode()):08x}"
        full = self.name(layer, name)
        if self.spark.catalog.tableExists(full):
            known = self.spark.sql(f"SHOW TBLPROPERTIES {full}").filter("key = 'definition'").first()
            if known and known.value == mark:
                return
        self.spark.sql(f"CREATE OR REPLACE VIEW {full} TBLPROPERTIES ('definition' = '{mark}') AS {text}")

    def _commit(self, pointer: str, version: str) -> None:
        self.spark.range(0, 1, 1, 1).select(F.lit(version).alias("version")).write.insertInto(pointer)

    def _remove_old(self, layer: str, tables: set[str], version: str) -> None:
        """Keep the published version and the one before, which a reader may still be reading."""
        shown = sorted(row[0] for row in self.read(layer, PUBLISHED).collect())[-2:]
        for table in tables:
            full = self.name(layer, table)
            parts = {row[0].split("/")[0].partition("=")[2] for row in self.spark.sql(f"SHOW PARTITIONS {full}").collect()}
            for old in sorted(part for part in parts if part not in shown and part < version):
                self.spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION ({VERSION} = '{old}')")
                if self.location:  # files of a table at a given place outlive its partitions
                    path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.location}/{layer}/{table}/{VERSION}={old}")
                    path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
