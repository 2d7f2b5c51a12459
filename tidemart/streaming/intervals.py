"""Interval joins of two streams over rows kept as tables between micro-batches.

A micro-batch is joined by the batch operator: what has just come on either side with what has just
come or is held on the other.  Held is only what a later record may still meet, so the tables that every
micro-batch replaces are as long as the bounds reach and no row goes through a key-value store.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.session import SMALL
from tidemart.streaming.thresholds import _LONG_AGO, _State


def join_changing(left: DataFrame, right: DataFrame, pairs: Callable[[DataFrame, DataFrame], DataFrame], ms: Column,
                  earliest_ms: int, latest_ms: int, folder: str, checkpoint: str, delay_ms: int = 1, once: bool = False):
    """Pairs of two streams to ``folder/batches``, a folder per micro-batch.

    ``pairs`` is the batch join; it brings together rows of which the right one lies within
    ``[left + earliest_ms, left + latest_ms]`` by the time ``ms``.  The watermark is ``delay_ms`` behind
    the newest record of the side that is behind.  What comes at it or before goes to ``folder/late``
    and meets nothing.  Every micro-batch replaces what an earlier attempt of it left.
    """
    # Tables are joined in the caller's session: that of a micro-batch plans without adaptive execution.
    spark, sides = left.sparkSession, {"left": left, "right": right}
    # How long after its own time a row may meet one that is still to come.
    reach = {"left": latest_ms, "right": -earliest_ms}

    def write(batch: DataFrame, batch_id: int) -> None:
        now, last = _State(spark, folder, batch_id), _State(spark, folder, batch_id - 1) if batch_id else None
        clock = last.get("clock").first().asDict() if last else {"left": None, "right": None, "until": _LONG_AGO}
        until, open_, held = clock["until"], {}, {}
        for side in sides:
            fresh = now.put(batch.filter(F.col(side).isNotNull()).select(f"{side}.*").withColumn("_ms", ms), side)
            fresh.filter(F.col("_ms") <= until).write.mode("overwrite").options(**SMALL).parquet(
                os.path.join(folder, "late", f"side={side}", f"batch={batch_id}"))
            open_[side] = fresh.filter(F.col("_ms") > until)
            held[side] = last.get("held_" + side) if last else None
            newest = fresh.agg(F.max("_ms")).first()[0]
            clock[side] = max((x for x in (clock[side], newest) if x is not None), default=None)
        # What has just come is shuffled once: it meets the other side's fresh and held rows apart, and the latter are few.
        found = pairs(open_["left"].drop("_ms"), open_["right"].drop("_ms"))
        if last:
            found = found.unionByName(pairs(open_["left"].drop("_ms"), held["right"].drop("_ms"))).unionByName(
                pairs(held["left"].drop("_ms"), open_["right"].drop("_ms")))
        found.write.mode("overwrite").options(**SMALL).parquet(os.path.join(folder, "batches", f"batch={batch_id}"))
        if clock["left"] is not None and clock["right"] is not None:
            clock["until"] = max(until, min(clock["left"], clock["right"]) - delay_ms)
        for side in sides:
            rows = open_[side].unionByName(held[side]) if last else open_[side]
            now.put(rows.filter(F.col("_ms") + reach[side] >= clock["until"]), "held_" + side)
        now.put(spark.range(1).select(*[F.lit(value).cast("bigint").alias(name) for name, value in clock.items()]), "clock")
        now.drop(*sides)

    def one_of(side: str) -> DataFrame:
        return sides[side].select(*[
            F.struct(*rows.columns).alias(name) if name == side else F.lit(None).cast(rows.schema).alias(name)
            for name, rows in sides.items()])

    writer = one_of("left").unionByName(one_of("right")).writeStream.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write)
