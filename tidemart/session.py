"""Session settings and the shared folder that jobs write to."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that may change while a session runs.  Shuffle width is left to the
# cluster; adaptive execution then merges small partitions and splits hot ones.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session someone else has built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemart", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    # Call sites of column expressions are not recorded: that costs seconds on wide plans.
    builder = SparkSession.builder.appName(app).config(
        "spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only when the cluster names none (tests on one machine) a local one is made
    and put on the session, so that later calls agree on it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("tidemart.shared.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemart-")
        spark.conf.set("tidemart.shared.dir", folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the shared folder."""
    return os.path.join(shared_folder(spark), "tidemart", f"{name}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_let_go(spark: SparkSession):
    """Within, the shuffled rows of an action are deleted when it ends: jobs that write every step as a table
    never look at them again.  A lazily read iterator would, so this is not for a whole session."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


# How jobs write what other jobs or micro-batches read: small files count, they stay for a while.
SMALL = {"compression": "zstd"}


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: worked out once."""
    folder = run_folder(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
