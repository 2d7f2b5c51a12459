"""Daily unique visits, bounces, and the audit of late records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.functions.records import is_entry_page
from tidemart.functions.times import event_time
from tidemart.operators.keyed import first_per_key
from tidemart.operators.logs import split_pages


def daily_unique_visits(pages: DataFrame) -> DataFrame:
    """The first entry page of every device on every day.

    In time order a device's stored day differs from the record's day exactly at the
    first entry page of the day, so one top-1 per device and day is enough.
    """
    entries = pages.filter(is_entry_page()).withColumn("_day", event_time("ts").cast("date"))
    return first_per_key(entries, ["common.mid", "_day"], ["ts", "seq"]).drop("_day")


def bounces(pages: DataFrame, gap_ms: int = 10_000, others: DataFrame | None = None) -> DataFrame:
    """Entry pages that no onward page of the same device follows within the gap.

    Each entry page is judged alone; onward pages may come after other entry pages, and an
    onward page exactly ``gap_ms`` later is too late.

    Time is cut into slices of one gap.  Whether an entry page is followed in time depends
    only on the last onward page of its own slice and the first onward page of the next
    slice, so onward pages are reduced to these two values before the shuffle and no
    device's history is ever brought together.

    Onward pages are looked up in ``others`` if given: the same pages at an earlier stage,
    which saves working out columns that onward pages do not need.
    """
    follow = _followers(pages if others is None else others, gap_ms)
    entries = pages.filter(is_entry_page()).withColumn("_entry_slice", _slice(gap_ms))
    joined = entries.join(
        follow, (F.col("common.mid") == F.col("_mid"))
        & (F.col("_entry_slice") == F.col("_slice")), "left")
    return joined.filter(_unfollowed(gap_ms)).select(*pages.columns)


def _slice(gap_ms: int) -> Column:
    return F.expr(f"(ts - pmod(ts, {int(gap_ms)})) div {int(gap_ms)}")


def _followers(pages: DataFrame, gap_ms: int) -> DataFrame:
    """Per device and slice the last onward page there and the first of the next slice."""
    device = F.col("common.mid").alias("_mid")
    onward = pages.filter(~is_entry_page()).select(device, _slice(gap_ms).alias("_slice"), "ts", "seq")
    # An onward page answers for entries of its own slice (by its place in time) and for
    # entries of the slice before (by its distance).
    marks = onward.select("_mid", F.inline(F.array(
        F.struct(F.col("_slice").alias("_slice"), F.struct("ts", "seq").alias("_place"),
                 F.lit(None).cast("bigint").alias("_ahead")),
        F.struct((F.col("_slice") - 1).alias("_slice"),
                 F.lit(None).cast("struct<ts:bigint,seq:bigint>").alias("_place"),
                 F.col("ts").alias("_ahead")))))
    return marks.groupBy("_mid", "_slice").agg(
        F.max("_place").alias("_last_here"), F.min("_ahead").alias("_first_next"))


def _unfollowed(gap_ms: int) -> Column:
    in_slice = F.coalesce(F.col("_last_here") > F.struct("ts", "seq"), F.lit(False))
    in_next = F.coalesce(F.col("_first_next") < F.col("ts") + gap_ms, F.lit(False))
    return ~in_slice & ~in_next


def flagged_pages(log: DataFrame, gap_ms: int = 10_000) -> DataFrame:
    """Pages of an unrepaired log with repaired flags, and with ``unique_visit`` and ``bounced``.

    What `repair_new_users`, `daily_unique_visits` and `bounces` tell, in one pass over the
    pages: three narrow tables are worked out from keys and times alone and joined to it, on
    device, time and sequence or on device and slice, so a hot device spreads.
    """
    def key(df: DataFrame) -> list[Column]:
        return [F.col("common.mid").alias("_mid"), F.col("ts").alias("_ts"), F.col("seq").alias("_seq")]

    claims = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    first_claims = first_per_key(log.filter(claims).select(*key(log)), ["_mid"], ["_ts", "_seq"])
    pages = split_pages(log)
    day = event_time("ts").cast("date").alias("_day")
    first_entries = first_per_key(
        pages.filter(is_entry_page()).select(*key(pages), day), ["_mid", "_day"], ["_ts", "_seq"])
    marks = first_claims.withColumn("_claim", F.lit(True)).withColumn("_visit", F.lit(None).cast("boolean")).unionByName(
        first_entries.drop("_day").withColumn("_claim", F.lit(None).cast("boolean")).withColumn("_visit", F.lit(True)))
    marks = marks.groupBy("_mid", "_ts", "_seq").agg(F.max("_claim").alias("_claim"), F.max("_visit").alias("_visit"))
    on = (F.col("common.mid") == F.col("_mid")) & (F.col("ts") == F.col("_ts")) & (F.col("seq") == F.col("_seq"))
    joined = pages.join(marks, on, "left").drop("_mid", "_ts", "_seq")
    follow = _followers(pages, gap_ms)
    joined = joined.withColumn("_entry_slice", F.when(is_entry_page(), _slice(gap_ms)))
    joined = joined.join(follow, (F.col("common.mid") == F.col("_mid"))
                         & (F.col("_entry_slice") == F.col("_slice")), "left")
    is_new = F.when(claims & F.coalesce("_claim", F.lit(False)), "1").otherwise(
        F.when(claims, "0").otherwise(F.col("common.is_new")))
    return joined.select(
        F.col("common").withField("is_new", is_new).alias("common"),
        *[name for name in log.columns if name != "common"],
        (is_entry_page() & F.coalesce("_visit", F.lit(False))).alias("unique_visit"),
        (is_entry_page() & _unfollowed(gap_ms)).alias("bounced"))


def late_records(arrivals: DataFrame, delay_ms: int, key: str = "mid", arrival: str = "arrival",
                 ts: str = "ts", block: int = 100_000) -> DataFrame:
    """Records older than what their key had already shown, minus the allowed delay.

    The running maximum in arrival order is taken in two levels: inside blocks of
    consecutive arrivals, and over the per-block maxima, which are fewer by the block size.
    """
    numbered = arrivals.withColumn("_block", F.expr(f"`{arrival}` div {int(block)}"))
    per_block = numbered.groupBy(key, "_block").agg(F.max(ts).alias("_block_max"))
    before = (Window.partitionBy(key).orderBy("_block")
                    .rowsBetween(Window.unboundedPreceding, -1))
    carried = per_block.select(
        F.col(key).alias("_key"), F.col("_block").alias("_carried_block"),
        F.max("_block_max").over(before).alias("_carried"))
    inside = (Window.partitionBy(key, "_block").orderBy(arrival)
                    .rowsBetween(Window.unboundedPreceding, -1))
    seen = numbered.withColumn("_inside", F.max(ts).over(inside)).join(
        carried, (F.col(key) == F.col("_key")) & (F.col("_block") == F.col("_carried_block")))
    high = F.greatest("_inside", "_carried")
    return (seen.withColumn("seen_ts", high)
                .filter(F.col(ts) < F.col("seen_ts") - delay_ms)
                .select(*arrivals.columns, "seen_ts"))
