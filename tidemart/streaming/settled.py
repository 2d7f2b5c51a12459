"""Answers about rows of a stream that time has settled, over rows kept as a table between micro-batches.

A micro-batch answers by the batch operator what the watermark has left behind, and keeps what it has
not.  So the table that every micro-batch replaces is as long as a window or a gap reaches, and no row
goes through a key-value store.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.records import with_evaluated
from tidemart.functions.times import tumbling
from tidemart.operators import visits
from tidemart.session import SMALL
from tidemart.streaming.thresholds import _LONG_AGO, _State


def settle_changing(rows: DataFrame, ms: Column, late: Column, settled: Column,
                    answer: Callable[[DataFrame, DataFrame], DataFrame], folder: str, checkpoint: str,
                    delay_ms: int = 1, once: bool = False):
    """``answer(settled rows, all rows at hand)`` to ``folder/batches``, a folder per micro-batch.

    The watermark is ``delay_ms`` behind the newest ``ms``.  A row is asked about once the watermark has
    reached its ``settled`` and is held until then.  What comes with a ``late`` the watermark had reached
    before goes to ``folder/late`` and counts for nothing; what has no time is left out.  Every
    micro-batch replaces what an earlier attempt of it left.
    """
    # Tables are answered in the caller's session: that of a micro-batch plans without adaptive execution.
    spark = rows.sparkSession
    told = {"_ms": ms, "_late": late, "_settled": settled}

    def write(batch: DataFrame, batch_id: int) -> None:
        now, last = _State(spark, folder, batch_id), _State(spark, folder, batch_id - 1) if batch_id else None
        until = last.get("clock").first()["until"] if last else _LONG_AGO
        fresh = now.put(batch, "fresh")
        newest = fresh.agg(F.max("_ms")).first()[0]
        due = until if newest is None else max(until, newest - delay_ms)
        fresh.filter(F.col("_late") <= until).drop(*told).write.mode("overwrite").options(**SMALL).parquet(
            os.path.join(folder, "late", f"batch={batch_id}"))
        open_ = fresh.filter(F.col("_late") > until)
        if last:
            open_ = open_.unionByName(last.get("held"))
        done = open_.filter(F.col("_settled") <= due)
        answer(done.drop(*told), open_.drop(*told)).write.mode("overwrite").options(**SMALL).parquet(
            os.path.join(folder, "batches", f"batch={batch_id}"))
        now.put(open_.filter(F.col("_settled") > due), "held")
        now.put(spark.range(1).select(F.lit(due).cast("bigint").alias("until")), "clock")
        now.drop("fresh")

    writer = rows.select("*", *[column.alias(name) for name, column in told.items()]).writeStream.option(
        "checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write)


def windows_changing(events: DataFrame, statistics: Callable[[DataFrame], DataFrame], moment: Column, size: str,
                     folder: str, checkpoint: str, delay_ms: int, once: bool = False):
    """Windowed statistics of a stream, by the batch operator: a window once the watermark has reached its end."""
    # The time may be parsed text, and a window looks at it several times.
    windowed = with_evaluated(events, "_moment", moment).withColumn("_window", tumbling("_moment", size))
    timed = windowed.select(*events.columns, F.unix_millis("_moment").alias("_at"), F.unix_millis("_window.end").alias("_end"))
    return settle_changing(timed, F.col("_at"), F.col("_end"), F.col("_end"),
                           lambda done, _: statistics(done.drop("_at", "_end")), folder, checkpoint, delay_ms, once)


def bounces_changing(pages: DataFrame, gap_ms: int, folder: str, checkpoint: str, delay_ms: int = 1, once: bool = False):
    """Bounces of a stream, by the batch operator: a page once no page still to come can follow it within the gap."""
    ts = F.col("ts")
    return settle_changing(pages, ts, ts, ts + (gap_ms - 1),
                           lambda done, at_hand: visits.bounces(done, gap_ms, others=at_hand),
                           folder, checkpoint, delay_ms, once)
