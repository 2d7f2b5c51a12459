"""Operators that need per-key state on a stream.

Batch forms use windows and aggregates (``tidemart.operators``).  On a stream the same
results need memory between micro-batches, which Spark's own deduplication and joins keep:
a flag, or the few records still undecided.  What has to be picked among the records of one
micro-batch is picked in Arrow, per task and not per key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.functions.records import is_entry_page
from tidemart.functions.times import event_time
from tidemart.operators.wide import IN_ORDER

DAY_MS = 86_400_000


# ---- first rows of a micro-batch ------------------------------------------------------

# Rows gathered before they are cut to the first of every key again.
_AT_ONCE = 100_000


def _firsts(rows: pa.Table, keys: list[str], order: list[str], latest: str) -> pa.Table:
    narrow = rows.select([*keys, *order, latest]).append_column("_row", pa.array(range(rows.num_rows), pa.int64()))
    ranked = narrow.sort_by([(name, "ascending") for name in [*order, "_row"]])
    found = ranked.group_by(keys, use_threads=False).aggregate([("_row", "first"), (latest, "max")])
    firsts = rows.take(found["_row_first"])
    return firsts.set_column(firsts.schema.get_field_index(latest), firsts.schema.field(latest), found[latest + "_max"])


def _first_at_hand(keys: list[str], order: list[str], latest: str):
    """Of the rows of a task the first of every key, with the greatest ``latest`` of the key.

    What is held is cut again each time it has doubled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh, limit = [], 0, _AT_ONCE
        for batch in batches:
            held.append(batch)
            fresh += batch.num_rows
            if fresh >= limit:
                firsts = _firsts(pa.Table.from_batches(held), keys, order, latest)
                held, fresh, limit = firsts.to_batches(), 0, max(_AT_ONCE, firsts.num_rows)
        if held:
            yield from _firsts(pa.Table.from_batches(held), keys, order, latest).to_batches(max_chunksize=10_000)
    return run


# ---- new users ------------------------------------------------------------------------

def _told_apart(rows: pa.Table) -> tuple[pa.Table, pa.Table, pa.Table]:
    """The marks, the first claim of every device, and the other claims."""
    marks, claims = rows.filter(rows["mark"]), rows.filter(pc.invert(rows["mark"]))
    if not claims.num_rows:
        return marks, claims, claims
    narrow = claims.select(["mid", "ts", "seq"]).append_column("_row", pa.array(range(claims.num_rows), pa.int64()))
    ranked = narrow.sort_by([(name, "ascending") for name in ("ts", "seq", "_row")])
    places = ranked.group_by(["mid"], use_threads=False).aggregate([("_row", "first")])["_row_first"]
    first = pc.is_in(narrow["_row"], value_set=places.combine_chunks())
    return marks, claims.filter(first), claims.filter(pc.invert(first))


def _flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Claims with their flags: of a device's claims at hand the first keeps its claim if there is a mark.

    Held are the marks and one claim per device; a claim that another comes before passes at once.
    """
    def out(claims: pa.Table, flags: pa.ChunkedArray | pa.Array) -> Iterator[pa.RecordBatch]:
        flagged = claims.drop_columns(["mid", "mark"]).append_column("is_new", flags)
        return iter(flagged.to_batches(max_chunksize=10_000))

    def olds(claims: pa.Table) -> pa.Array:
        return pa.array(["0"] * claims.num_rows, pa.string())

    held, fresh, limit = [], 0, _AT_ONCE
    for batch in batches:
        held.append(batch)
        fresh += batch.num_rows
        if fresh >= limit:
            marks, firsts, others = _told_apart(pa.Table.from_batches(held))
            yield from out(others, olds(others))
            held = [*marks.to_batches(), *firsts.to_batches()]
            fresh, limit = 0, max(_AT_ONCE, marks.num_rows + firsts.num_rows)
    if held:
        marks, firsts, others = _told_apart(pa.Table.from_batches(held))
        yield from out(others, olds(others))
        new = pc.is_in(firsts["mid"], value_set=marks["mid"].combine_chunks())
        yield from out(firsts, pc.if_else(new, "1", "0"))


def repair_new_users(logs: DataFrame) -> DataFrame:
    """Only the first record of a device that claims a new user keeps the claim, for ever.

    Native deduplication holds the devices that have claimed: of a micro-batch the first claim
    per device gets through, if none did before, as a mark for the record it came from.  Records
    that claim an old user take no part and are not shuffled.
    """
    claims = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    fresh = logs.filter(claims).select(F.col("common.mid").alias("mid"), F.lit(False).alias("mark"), *logs.columns)
    places = logs.filter(claims).select(F.col("common.mid").alias("mid"), "ts", "seq", F.col("ts").alias("latest"))
    firsts = places.repartition("mid").mapInArrow(_first_at_hand(["mid"], ["ts", "seq"], "latest"), places.schema)
    marks = firsts.dropDuplicates(["mid"]).select("mid", F.lit(True).alias("mark"))
    marked = fresh.unionByName(marks, allowMissingColumns=True).repartition("mid")
    flagged = marked.mapInArrow(_flagged, T.StructType([*logs.schema.fields, T.StructField("is_new", T.StringType())]))
    repaired = flagged.withColumn("common", F.col("common").withField("is_new", F.col("is_new")))
    return repaired.select(*logs.columns).unionByName(logs.filter(~claims))


# ---- unique visits --------------------------------------------------------------------

def daily_unique_visits(pages: DataFrame, ttl: str = "1 day") -> DataFrame:
    """The first entry page of a device and day, emitted at once.

    Of a micro-batch the first entry page per device and day is picked; native deduplication
    then lets it pass if the day is new to the device.  State is one flag per device and day,
    held until the watermark, ``ttl`` behind the newest entry page, is ``ttl`` past the visit:
    with a day at least, the day is over by then.
    """
    if pd.Timedelta(ttl) < pd.Timedelta(days=1):
        raise ValueError("a flag must outlive its day: ttl is a day at least")
    day = F.expr(f"(ts - pmod(ts, {DAY_MS})) div {DAY_MS}")
    entries = pages.filter(is_entry_page()).select(
        F.col("common.mid").alias("mid"), day.alias("day"), F.col("ts").alias("latest"),
        *[F.col(name).alias("_" + name) for name in pages.columns])
    firsts = entries.repartition("mid", "day").mapInArrow(
        _first_at_hand(["mid", "day"], ["_ts", "_seq"], "latest"), entries.schema)
    # A device's day is late only if all its pages at hand are.
    timed = firsts.withColumn("event_time", event_time("latest")).withWatermark("event_time", ttl)
    return timed.dropDuplicatesWithinWatermark(["mid", "day"]).select(
        *[F.col("_" + name).alias(name) for name in pages.columns])


# ---- bounces --------------------------------------------------------------------------

def bounces(pages: DataFrame, gap_ms: int = 10_000, delay: str = IN_ORDER) -> DataFrame:
    """Entry pages no onward page follows within the gap, once time has moved past it.

    An outer join of two streams within time bounds: an entry page that the watermark has left
    behind without a partner is a bounce.  The bounds tell Spark how long either side is kept,
    and a device's pages are never brought together beyond that.
    """
    timed = pages.withColumn("event_time", event_time("ts")).withWatermark("event_time", delay)
    entries = timed.filter(is_entry_page())
    onward = timed.filter(~is_entry_page()).select(
        F.col("common.mid").alias("_mid"), F.col("ts").alias("_ts"), F.col("seq").alias("_seq"),
        F.col("event_time").alias("_time"))
    follows = ((F.col("common.mid") == F.col("_mid"))
               & (F.col("_time") >= F.col("event_time"))
               & (F.col("_time") < F.col("event_time") + F.expr(f"INTERVAL {int(gap_ms)} MILLISECONDS"))
               # Within a millisecond the records' own order decides.
               & (F.struct("_ts", "_seq") > F.struct("ts", "seq")))
    return entries.join(onward, follows, "left_outer").filter(F.col("_mid").isNull()).select(*pages.columns)
