"""Session settings the plans rely on, and the shared folder for written state."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# UTC makes date_format and current_timestamp independent of the driver host.
# Adaptive execution coalesces small shuffle partitions, turns a sort-merge join
# into a broadcast join once a side is known to be small, and splits skewed ones.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Keys a stream remembers live on local disk, backed by the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the plans rely on to a running session."""
    for name, value in SESSION_CONF.items():
        spark.conf.set(name, value)
    return spark


def bounded_batches(spark: SparkSession, most: int) -> None:
    """Let the session hand rows to Python in batches of about ``most`` bytes, not only of so many rows.

    Executor and worker each hold a batch whole, outside the heap. A limit that is lower, or that
    was set with a unit, stays.
    """
    held = spark.conf.get(BATCH_BYTES).removesuffix("b")
    if held.isdigit() and int(held) > most:
        spark.conf.set(BATCH_BYTES, most)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, if it is not installed there."""
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    paths = [path for path in env.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session for scripts and tests; on a cluster the caller brings its own."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, whose
    executors share the driver's disk, may fall back to a new temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return context.getCheckpointDir()
