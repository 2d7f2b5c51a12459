"""Rule alerts on a stream: sliding windows of any length over panes kept between micro-batches.

What a window needs of the past is one row per rule, key and millisecond (`rules.moments`).  These
rows are kept as a table that every micro-batch replaces: those still inside a window, and those
just come.  The batch operator answers the rows that are due from it, so a hot key, the empty key
of a rule without names too, is cut into panes and spread over tasks as in batch.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidemart.operators import rules
from tidemart.session import SMALL

_LONG_AGO = -(1 << 62)


class _State:
    """The tables of the last two micro-batches: a repeated one finds what it found before."""

    def __init__(self, spark, folder: str, batch_id: int):
        self.spark, self.folder = spark, os.path.join(folder, "state", f"turn-{batch_id % 2}")

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = os.path.join(self.folder, name)
        df.write.mode("overwrite").options(**SMALL).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def get(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, name))

    def drop(self, *names: str) -> None:
        """Delete what only this micro-batch looks at, which a repeated one puts down again."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.folder, name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _as_ruled(rows: DataFrame, in_force: DataFrame) -> DataFrame:
    """Rows of the rules in force, with what those ask now; a rule with another window starts anew."""
    told = in_force.select("rule_id", "window_minutes", "aggregator", "limit_operator", "limit_value")
    changed = ("aggregator", "limit_operator", "limit_value")
    return rows.drop(*changed).join(told, ["rule_id", "window_minutes"]).select(*rows.columns)


def alert_changing(transactions: DataFrame, read_rules: Callable[[], DataFrame], folder: str, checkpoint: str,
                   ts: str = "eventTime", delay_ms: int = 0, once: bool = False):
    """Alerts of a transaction stream to ``folder/alerts``, by rules that are read anew for every
    micro-batch.

    A transaction is due once a record ``delay_ms`` later has been seen, its own micro-batch
    included.  What comes after its moment was answered is late: it goes to ``folder/late`` and
    counts for no window.  Every micro-batch replaces what an earlier attempt of it left.
    """
    # Judged in the caller's session: that of a micro-batch plans without adaptive execution.
    spark = transactions.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        now, last = _State(spark, folder, batch_id), _State(spark, folder, batch_id - 1) if batch_id else None
        batch = now.put(batch, "batch")
        in_force = rules.usable_rules(now.put(read_rules(), "rules"))
        fresh = now.put(rules.fan_out(batch, in_force), "fresh")
        seen, until = last.get("clock").first() if last else (None, _LONG_AGO)
        newest = batch.agg(F.max(ts)).first()[0]
        seen = max((x for x in (seen, newest) if x is not None), default=None)
        due_until = until if seen is None else max(until, seen - delay_ms)

        fresh.filter(F.col(ts) <= until).write.mode("overwrite").parquet(
            os.path.join(folder, "late", f"batch={batch_id}"))
        open_ = fresh.filter(F.col(ts) > until)
        if last:
            open_ = open_.unionByName(_as_ruled(last.get("waiting"), in_force))
        now.put(open_.filter(F.col(ts) > due_until), "waiting")
        due = now.put(open_.filter(F.col(ts) <= due_until), "due")
        told = rules.moments(due, ts)
        if last:
            length = F.col("window_minutes").cast("bigint") * 60_000
            told = told.unionByName(_as_ruled(last.get("moments").filter(F.col("_ts") >= until - length), in_force))
        told = now.put(told, "moments")
        now.put(spark.range(1).select(F.lit(seen).cast("bigint").alias("seen"), F.lit(due_until).cast("bigint").alias("until")), "clock")
        alerts = rules.alerted(due, rules.alerting_moments(told, since=until), ts)
        alerts.write.mode("overwrite").parquet(os.path.join(folder, "alerts", f"batch={batch_id}"))

    writer = transactions.writeStream.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write)
