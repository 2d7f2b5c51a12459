"""Dimension store: change rows per micro-batch, merged when read, compacted by the sink job.

Layout below the store's folder: ``changes/batch=N`` holds the routed change rows of one
micro-batch, ``snapshot/upto=N`` what is left of all rows up to batch N.  Both are laid out
by table and key bucket (``sink_table=T/bucket=B``), so a lookup opens only the buckets its
keys fall into.  Folders are only ever written whole, under a name that a repeated attempt
overwrites; the newest complete snapshot is the one that carries a ``_SUCCESS`` mark.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemart.operators.changelog import effective_changes, upserted_rows
from tidemart.operators.keyed import first_per_key
from tidemart.operators.routing import DIM_SINK
from tidemart.session import SMALL

STORED = T.StructType([
    T.StructField("sink_table", T.StringType()), T.StructField("pk", T.StringType()),
    T.StructField("type", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("data", T.MapType(T.StringType(), T.StringType()))])

# Key buckets of a table.  The number belongs to the stored layout: a store keeps it for ever.
BUCKETS = 16
_LAID_OUT = T.StructType([*STORED.fields, T.StructField("bucket", T.IntegerType())])


def bucket_of(pk: Column | str) -> Column:
    return F.pmod(F.xxhash64(pk), F.lit(BUCKETS)).cast("int")


def _write(rows: DataFrame, path: str) -> None:
    """Rows by table and key bucket; a pair's rows are gathered so that it gets few files, and
    the rebalancing cuts a pair that is too much for one task."""
    laid_out = rows.select(*STORED.fieldNames(), bucket_of("pk").alias("bucket"))
    (laid_out.hint("rebalance", "sink_table", "bucket")
     .write.mode("overwrite").options(**SMALL).partitionBy("sink_table", "bucket").parquet(path))


def append_changes(batch: DataFrame, folder: str, batch_id: int) -> None:
    _write(batch, os.path.join(folder, "changes", f"batch={batch_id}"))


def dimension_sink(changes: DataFrame, folder: str, checkpoint: str, *,
                   once: bool = False, compact_every: int = 100) -> DataStreamWriter:
    """Store routed changes; after every ``compact_every`` micro-batches merge what is there."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_changes(batch, folder, batch_id)
        if (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, folder)
            retire(batch.sparkSession, folder)

    writer = changes.writeStream.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write)


def _numbers(spark: SparkSession, folder: str, label: str) -> list[int]:
    """Numbers of the complete folders ``label=N``, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = []
    for status in files.listStatus(path):
        child = status.getPath()
        name = child.getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(child, "_SUCCESS")
        if name.startswith(label + "=") and files.exists(done):
            found.append(int(name[len(label) + 1:]))
    return sorted(found)


def _stored(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """Newest snapshot and the changes after it, as change rows with their bucket, and the last
    batch seen."""
    snapshots = _numbers(spark, os.path.join(folder, "snapshot"), "upto")
    last = snapshots[-1] if snapshots else -1
    batches = [n for n in _numbers(spark, os.path.join(folder, "changes"), "batch") if n > last]
    rows = spark.createDataFrame([], _LAID_OUT)
    # Each is a folder of partitions of its own, so that table and bucket prune its files.
    for base, labels in (("snapshot", [f"upto={last}"] if snapshots else []),
                         ("changes", [f"batch={n}" for n in batches])):
        if labels:
            root = os.path.join(folder, base)
            found = spark.read.schema(_LAID_OUT).option("basePath", root).parquet(
                *[os.path.join(root, label) for label in labels])
            rows = rows.unionByName(found.select(*_LAID_OUT.fieldNames()))
    return rows, max(batches, default=last)


def read_rows(spark: SparkSession, folder: str, keep_deletes: bool = False) -> DataFrame:
    """Current rows of all dimension tables: table, key, data, sequence."""
    rows, _ = _stored(spark, folder)
    return upserted_rows(rows, keep_deletes=keep_deletes)


def read_dimension(spark: SparkSession, folder: str, table: str, columns: list[str],
                   keys: DataFrame | None = None) -> DataFrame:
    """One dimension table with the named columns, all text; of ``keys`` (a column ``pk``)
    only, if they are given.

    The keys' buckets are worked out first (``BUCKETS`` numbers at most reach the driver), and
    no file of another table or bucket is opened.
    """
    rows, _ = _stored(spark, folder)
    rows = rows.filter(F.col("sink_table") == table)
    if keys is not None:
        wanted = [r.bucket for r in keys.select(bucket_of("pk").alias("bucket")).distinct().collect()]
        rows = rows.filter(F.col("bucket").isin(sorted(wanted))).join(keys, "pk", "left_semi")
    current = upserted_rows(rows)
    return current.select(*[F.col("data")[name].alias(name) for name in columns])


def compact(spark: SparkSession, folder: str) -> int:
    """Merge everything stored so far into a snapshot; returns its batch number.

    What has been set anew or deleted since falls away; what is left keeps the sequence it came
    with, cell by cell, and a key's last delete stays as a mark.  So a change that arrives after
    the compaction finds its place among them, however late it is.
    """
    rows, last = _stored(spark, folder)
    if last >= 0:
        _write(effective_changes(rows), os.path.join(folder, "snapshot", f"upto={last}"))
    return last


def retire(spark: SparkSession, folder: str) -> None:
    """Drop what the snapshot before the newest has merged, and the snapshots before it.

    A reader that listed the folders before the last compaction still finds all it wants.
    """
    snapshots = _numbers(spark, os.path.join(folder, "snapshot"), "upto")
    if len(snapshots) < 2:
        return
    merged = [os.path.join(folder, "snapshot", f"upto={n}") for n in snapshots[:-2]]
    merged += [os.path.join(folder, "changes", f"batch={n}")
               for n in _numbers(spark, os.path.join(folder, "changes"), "batch") if n <= snapshots[-2]]
    for name in merged:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def create_tables(spark: SparkSession, config: DataFrame, database: str) -> list[str]:
    """Create the dimension tables a config names, if they are missing; all columns text.

    One row per table is read on the driver.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    created = []
    wanted = first_per_key(config.filter(F.col("sink_type") == DIM_SINK), ["sink_table"],
                           ["source_table", "operate_type"])
    for row in wanted.select("sink_table", "sink_columns").orderBy("sink_table").toLocalIterator():
        columns = ", ".join(f"`{name}` STRING" for name in row.sink_columns.split(","))
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{row.sink_table}` ({columns}) USING parquet")
        created.append(row.sink_table)
    return created
