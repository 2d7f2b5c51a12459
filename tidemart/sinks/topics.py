"""Topic, table and console sinks of streams."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemart.session import SMALL


def _started_with(df: DataFrame, checkpoint: str, once: bool, mode: str) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if once else writer


def topic_sink(df: DataFrame, checkpoint: str, *, topic: str | None = None,
               servers: str | None = None, folder: str | None = None,
               once: bool = False) -> DataStreamWriter:
    """Text records to a topic.

    With ``topic`` every record goes there, else to the topic its ``topic`` column names.
    Kafka takes each record at least once.  With ``folder`` topics are folders of parquet
    files, which Spark's file sink writes exactly once.
    """
    rows = df.withColumn("topic", F.lit(topic)) if topic else df
    rows = rows.select("topic", F.col("value").cast("string").alias("value"))
    writer = _started_with(rows, checkpoint, once, "append")
    if folder:
        return writer.format("parquet").partitionBy("topic").option("path", folder)
    return writer.format("kafka").option("kafka.bootstrap.servers", servers)


def console_sink(df: DataFrame, checkpoint: str, rows: int = 20,
                 mode: str = "append") -> DataStreamWriter:
    return (_started_with(df, checkpoint, False, mode).format("console")
            .option("numRows", rows).option("truncate", False))


def table_sink(df: DataFrame, checkpoint: str, folder: str, *,
               once: bool = False) -> DataStreamWriter:
    """A layer of the warehouse as parquet files, written exactly once."""
    return _started_with(df, checkpoint, once, "append").format("parquet").options(**SMALL).option("path", folder)


def batch_folder_sink(df: DataFrame, checkpoint: str, folder: str, *, mode: str = "update",
                      once: bool = False) -> DataStreamWriter:
    """Every micro-batch to a folder of its own.

    A micro-batch repeated after a failure replaces its folder, so nothing is doubled.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").options(**SMALL).parquet(os.path.join(folder, f"batch={batch_id}"))
    return _started_with(df, checkpoint, once, mode).foreachBatch(write)
