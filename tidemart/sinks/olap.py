"""Positional sink of the statistics into an analytical database or parquet."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tidemart.operators.stats import sink_row, stamped


def olap_sink(stats: DataFrame, columns: Sequence[str], checkpoint: str, *,
              url: str | None = None, table: str | None = None,
              properties: dict[str, str] | None = None, batch_rows: int = 10_000,
              folder: str | None = None, stats_ms: int | None = None, mode: str = "append",
              once: bool = False) -> DataStreamWriter:
    """Exactly the sink's columns in the sink's order, per micro-batch.

    Rows go over JDBC in batches of ``batch_rows`` from every partition, or to parquet below
    ``folder``, where a repeated micro-batch replaces its earlier attempt.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = sink_row(stamped(batch, stats_ms), columns)
        if folder:
            rows.write.mode("overwrite").parquet(os.path.join(folder, f"batch={batch_id}"))
        else:
            rows.write.option("batchsize", batch_rows).jdbc(url, table, "append", properties)

    writer = stats.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write)
