"""Tables of one row a key, merged by rewriting only the buckets that a change falls in."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import shared_folder

BUCKET, OUTCOME = "_bucket", "_outcome"


@dataclass(frozen=True)
class KeyedTable:
    """Parquet files under ``folder``, in folders by a hash of the key; ``version`` orders the states of a key."""

    spark: SparkSession
    folder: str
    schema: T.StructType
    keys: tuple[str, ...]
    version: str
    buckets: int = 256

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        """Rows with their bucket; none before the first merge."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fields = T.StructType([*self.schema, T.StructField(BUCKET, T.IntegerType())])
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], fields)
        return self.spark.read.schema(fields).parquet(self.folder)

    def read(self) -> DataFrame:
        return self._stored().select(*self.schema.names)

    def merge(self, changes: DataFrame) -> dict[str, int]:
        """Insert new keys, replace rows by changes of a higher version, leave the rest; returns the counts.

        Of several changes of a key the highest version counts, of equal ones the greater by
        value. A change whose version is not above the stored one is stale. Changes without a
        whole key or a version are not merged, and counted as such.

        The next state of the buckets that gain something is written aside, then replaces their
        folders (dynamic partition overwrite). Other buckets are neither read nor touched. A merge
        that failed can be run again: what it had applied is stale then.
        """
        others = [name for name in self.schema.names if name not in (*self.keys, self.version)]
        whole = F.lit(True)
        for name in (*self.keys, self.version):
            whole = whole & F.col(name).isNotNull()
        held = changes.select(*self.schema.names).persist()
        newest = held.filter(whole).groupBy(*self.keys).agg(F.max(F.struct(self.version, *others)).alias("new"))
        newest = newest.withColumn(BUCKET, self._bucket()).persist()
        scratch = f"{shared_folder(self.spark)}/merge-{uuid.uuid4().hex}"
        try:
            touched = [row[0] for row in newest.select(BUCKET).distinct().collect()]  # at most one for each bucket
            old = self._stored().filter(F.col(BUCKET).isin(touched))
            old = old.select(*self.keys, BUCKET, F.struct(self.version, *others).alias("old"))
            both = old.join(newest, [*self.keys, BUCKET], "full")
            outcome = (
                F.when(F.col("new").isNull(), "kept").when(F.col("old").isNull(), "inserted")
                .when(F.col(f"new.{self.version}") > F.col(f"old.{self.version}"), "updated").otherwise("stale")
            )
            row = F.when(F.col(OUTCOME).isin("inserted", "updated"), F.col("new")).otherwise(F.col("old"))
            merged = both.withColumn(OUTCOME, outcome).withColumn("row", row)
            flat = merged.select(*self.keys, BUCKET, OUTCOME, *[F.col(f"row.{name}").alias(name) for name in (self.version, *others)])
            flat.write.partitionBy(BUCKET).parquet(scratch)
            unnamed = held.filter(~whole).count()
        finally:
            newest.unpersist()
            held.unpersist()
        staged = self.spark.read.schema(T.StructType([*self.schema, T.StructField(OUTCOME, T.StringType()), T.StructField(BUCKET, T.IntegerType())])).parquet(scratch)
        figures = staged.groupBy(BUCKET, OUTCOME).count().collect()  # at most four rows for each bucket
        gaining = sorted({r[BUCKET] for r in figures if r[OUTCOME] in ("inserted", "updated")})
        if gaining:
            next_state = staged.filter(F.col(BUCKET).isin(gaining)).select(*self.schema.names, BUCKET).repartition(BUCKET)
            next_state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.folder)
        counts = {name: sum(r["count"] for r in figures if r[OUTCOME] == name) for name in ("inserted", "updated", "stale")}
        return {**counts, "unnamed": unnamed, "buckets_read": len(touched), "buckets_written": len(gaining)}
