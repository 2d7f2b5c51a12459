"""What running streams tell of themselves: rows dropped as too late, rows held in state."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = ("query STRING, run STRING, batch BIGINT, operator INT, kind STRING, rows_held BIGINT,"
            " rows_removed BIGINT, rows_dropped BIGINT, watermark STRING")


class StateProgress(StreamingQueryListener):
    """Writes a row per micro-batch and stateful operator of every query to a table.

    The listener hears of a micro-batch once it is done, and again only if another run does it
    again; `state_progress` keeps one of each.  It runs beside the queries and fails none of them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        watermark = (p.eventTime or {}).get("watermark")
        rows = [(str(p.id), str(p.runId), p.batchId, n, op.operatorName, op.numRowsTotal,
                 op.numRowsRemoved, op.numRowsDroppedByWatermark, watermark)
                for n, op in enumerate(p.stateOperators)]
        if rows:
            # A folder per run and micro-batch, so that a row told twice does not double.
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("overwrite").parquet(
                os.path.join(self.folder, f"told={p.runId}-{p.batchId}"))


def state_progress(spark: SparkSession, folder: str) -> DataFrame:
    """What the listener wrote: one row of every query, micro-batch and operator."""
    return (spark.read.schema(PROGRESS).parquet(os.path.join(folder, "told=*"))
            .groupBy("query", "batch", "operator", "kind")
            .agg(*[_last(c) for c in ("rows_held", "rows_removed", "rows_dropped", "watermark")]))


def _last(column: str) -> Column:
    return F.max_by(column, F.struct("watermark", "run")).alias(column)


def dropped_rows(progress: DataFrame) -> DataFrame:
    """Per query and operator, all rows that came too late for it."""
    return progress.groupBy("query", "operator", "kind").agg(F.sum("rows_dropped").alias("rows_dropped"))


def held_state(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """key, value, partition_id: what a stateful operator holds after a micro-batch, the last by default.

    This is what a restart from the checkpoint finds.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)
