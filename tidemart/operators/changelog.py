"""Change records: one envelope for all feeds, and the state they add up to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.operators.keyed import first_per_key
from tidemart.schemas import CHANGE_DATA


def envelope(feed: DataFrame) -> DataFrame:
    """Feed records (topic, op, before, after) as database, table, type, data, before.

    The topic reads ``server.database.table``.  A record without an after image has
    empty data; what a delete took away is in ``before``.
    """
    path = F.split("topic", r"\.")
    none = F.create_map().cast("map<string,string>")
    images = [F.coalesce(F.from_json(name, CHANGE_DATA), none) if name in feed.columns else none
              for name in ("after", "before")]
    rest = [name for name in feed.columns if name not in ("topic", "op", "before", "after")]
    return feed.select(path[1].alias("database"), path[2].alias("table"), F.lower("op").alias("type"),
                       images[0].alias("data"), images[1].alias("before"), *rest)


def latest_images(changes: DataFrame, keys: Sequence[Column | str], seq: str = "seq",
                  keep_deletes: bool = False) -> DataFrame:
    """The last image per key; a key whose last change is a delete is gone.

    ``keep_deletes`` keeps the image of deleted keys (insert-or-update only).
    """
    last = first_per_key(changes, keys, [F.col(seq).desc()])
    return last if keep_deletes else last.filter(F.col("type") != "delete")


def upserted_rows(changes: DataFrame, table: str = "sink_table", key: str = "pk",
                  seq: str = "seq", keep_deletes: bool = False) -> DataFrame:
    """Rows after applying upserts in order, column by column.

    An upsert sets the columns it names and leaves the others as they were, so the last
    value is taken per table, key and column.  A delete drops what came before it, unless
    ``keep_deletes`` treats it as one more upsert.
    """
    rows = _last_cells(changes, table, key, seq, keep_deletes)
    alive = rows.withColumn("_cells", F.filter("_cells", lambda c: c["_column"].isNotNull()))
    return alive.filter(F.size("_cells") > 0).select(
        table, key, F.map_from_entries(F.transform("_cells", lambda c: F.struct(
            c["_column"], c["_value"]))).alias("data"),
        F.array_max(F.transform("_cells", lambda c: c["_seq"])).alias(seq))


def effective_changes(changes: DataFrame, table: str = "sink_table", key: str = "pk",
                      seq: str = "seq") -> DataFrame:
    """The fewest changes that ``upserted_rows`` takes like all of them, now and with any others.

    Per table and key: its last delete, and of each later change the cells that no other has
    set since.  A change of an earlier sequence that turns up afterwards is judged as it would
    have been among all.
    """
    cells = _last_cells(changes, table, key, seq).select(table, key, F.inline("_cells"))
    gone = F.col("_column").isNull()
    # One row per sequence still in effect: a key has at most one per column, and its delete.
    grouped = cells.groupBy(table, key, F.col("_seq").alias(seq), gone.alias("_gone")).agg(
        F.collect_list(F.struct("_column", "_value")).alias("_set"))
    return grouped.select(
        table, key, F.when(F.col("_gone"), "delete").otherwise("insert").alias("type"), seq,
        F.when(F.col("_gone"), F.create_map().cast("map<string,string>"))
         .otherwise(F.map_from_entries("_set")).alias("data"))


def _last_cells(changes: DataFrame, table: str, key: str, seq: str,
                keep_deletes: bool = False) -> DataFrame:
    """Per table and key: the last value of each column with its sequence, as far as no delete
    came after it, and the last delete as a cell without a column."""
    # A delete is one more cell, without a column, so that one pass suffices.
    entries = F.transform(F.map_entries("data"), lambda e: F.struct(
        e.key.alias("_column"), e.value.alias("_value")))
    if not keep_deletes:
        gone = F.array(F.struct(F.lit(None).cast("string").alias("_column"),
                                F.lit(None).cast("string").alias("_value")))
        entries = F.when(F.col("type") == "delete", gone).otherwise(entries)
    cells = changes.select(table, key, seq, F.inline(entries))
    last = cells.groupBy(table, key, "_column").agg(
        F.max_by("_value", seq).alias("_value"), F.max(seq).alias("_seq"))
    # One entry per column of a row: bounded by the width of the table.
    rows = last.groupBy(table, key).agg(
        F.collect_list(F.struct("_column", "_value", "_seq")).alias("_cells"))
    dropped = F.array_max(F.transform(
        F.filter("_cells", lambda c: c["_column"].isNull()), lambda c: c["_seq"]))
    return rows.withColumn("_cells", F.filter("_cells", lambda c: c["_column"].isNull() | (
        c["_seq"] > F.coalesce(dropped, F.lit(-(1 << 62))))))


def last_images(changes: DataFrame, *keys: str, seq: str = "seq") -> DataFrame:
    """The last image per key as an aggregate, deletes included, for streams in update mode.

    A delete stays as a mark, so that an image that comes late finds it.  State is one image a key.
    """
    rest = [name for name in changes.columns if name not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_last"))
    return last.select(*keys, "_last.*")


def bootstrapped(snapshot: DataFrame, changes: DataFrame, low: str = "low", seq: str = "seq") -> DataFrame:
    """A table's snapshot and its change feed as one feed: every snapshot row is an insert at the
    low mark of the chunk it was read with.

    A chunk is read while changes go on: between its marks a row may show any moment.  Changes
    after the low mark are taken from the feed, so whatever of them the row showed already is
    said again and the last image is the feed's; a change before the low mark is older than the
    row and loses to it.  The feed need not reach back beyond the first chunk's low mark.
    Sequences are places in the feed, marks are places too; a tie goes to the change.
    """
    rows = snapshot.withColumns({"type": F.lit("insert"), seq: F.col(low).cast("bigint") * 2})
    later = changes.withColumn(seq, F.col(seq) * 2 + 1)
    return rows.select(*changes.columns).unionByName(later)
