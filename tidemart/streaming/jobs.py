"""Streaming jobs: each reads streams, applies operators, and writes one layer."""

from __future__ import annotations

import os
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.operators import changelog, dims, keywords, logs, routing, rules, stats, wide
from tidemart.plans.warehouse import Settings
from tidemart.session import SMALL, run_folder
from tidemart.sinks.dimensions import append_changes, read_dimension
from tidemart.sinks.topics import batch_folder_sink, table_sink
from tidemart.sources.derived import Inputs
from tidemart.streaming import state
from tidemart.streaming.thresholds import _State


@contextmanager
def state_width(spark: SparkSession, partitions: int | None):
    """State in so many partitions; the checkpoint keeps their number, so it belongs to the
    job and not to the machine the job starts on.  None leaves the session's shuffle width."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions or before))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def taken_up(spark: SparkSession, stream: DataFrame, folder: str, width: int | None = None,
             mode: str | None = None) -> str:
    """Run a stream over all that is there now and was not yet taken, and stop; its table.

    Called again for a folder, the job starts anew from its checkpoint.  With ``mode`` every
    micro-batch goes to a folder of its own.
    """
    table, checkpoint = os.path.join(folder, "table"), os.path.join(folder, "checkpoint")
    sink = (batch_folder_sink(stream, checkpoint, table, mode=mode, once=True) if mode
            else table_sink(stream, checkpoint, table, once=True))
    with state_width(spark, width):
        sink.start().awaitTermination()
    return table


def drained_table(spark: SparkSession, stream: DataFrame, name: str, width: int | None = None) -> str:
    """Run a stream over all that is there now into a fresh table; the table's folder."""
    return taken_up(spark, stream, run_folder(spark, name), width)


def drained(spark: SparkSession, stream: DataFrame, name: str, width: int | None = None) -> DataFrame:
    return spark.read.schema(stream.schema).parquet(drained_table(spark, stream, name, width))


def route_changes(changes: DataFrame, read_config: Callable[[], DataFrame], folder: str,
                  checkpoint: str, once: bool = False):
    """Route a change stream by a config that is read anew for every micro-batch.

    ``changes`` are parsed ones, problems included.  Facts go to folders per topic, dimension
    rows to the dimension store.  What cannot be used goes to a dirty folder with the reason:
    text that is no change, changes without payload or without a key, and changes that no route
    sends anywhere.  All replace what an earlier attempt of the same micro-batch left.
    """
    # Told apart in the caller's session: that of a micro-batch plans without adaptive execution.
    spark = changes.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        config = routing.checked_config(read_config())
        # The text is parsed once; the changes are looked at for every way they may go.
        batch = _State(spark, folder, batch_id).put(batch, "changes")
        clean = routing.clean_changes(batch)
        normal = routing.normalize_type(routing.non_empty(clean))

        def set_apart(rows: DataFrame, problem) -> DataFrame:
            place = [name for name in ("seq",) if name in rows.columns]
            return rows.select(*place, F.to_json(F.struct("table", "type", "data")).alias("raw"), problem.alias("problem"))

        dirty = (routing.dirty_changes(batch)
                 .unionByName(set_apart(clean.filter(F.col("data").isNull()), F.lit("empty")))
                 .unionByName(set_apart(routing.keyless_changes(normal, config), F.lit("missing_key")))
                 .unionByName(set_apart(routing.unrouted_changes(normal, config), F.col("reason"))))
        dirty.write.mode("overwrite").parquet(os.path.join(folder, "dirty", f"batch={batch_id}"))
        facts = routing.fact_messages(routing.fact_changes(normal, config))
        facts.write.mode("overwrite").partitionBy("topic").parquet(
            os.path.join(folder, "facts", f"batch={batch_id}"))
        append_changes(routing.dim_changes(normal, config), os.path.join(folder, "dims"), batch_id)

    writer = changes.writeStream.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write)


# Dimension tables of the wide order row, with the columns its lookups read.
ORDER_DIMENSIONS = {
    "dim_user": ("id", "birthday", "gender"),
    "dim_province": ("id", "name", "area_code", "iso_code", "iso_3166_2"),
    "dim_sku": ("id", "sku_name", "price", "spu_id", "tm_id", "category3_id"),
    "dim_spu": ("id", "spu_name"), "dim_trademark": ("id", "tm_name"), "dim_category3": ("id", "name")}


def looked_up(rows: DataFrame, store: str, as_of_ms: int) -> DataFrame:
    """Order rows with the dimension columns as the store has them now.

    Only the dimension rows whose keys the order rows ask for take part in the merge.
    """
    # Keys are asked of the rows as they came, not of what lookups have made of them.
    spark, given = rows.sparkSession, rows

    def dimension(table: str, keys: DataFrame | None = None) -> DataFrame:
        return read_dimension(spark, store, table, list(ORDER_DIMENSIONS[table]), keys)

    def asked(column: str) -> DataFrame:
        return given.select(F.col(column).cast("string").alias("pk")).distinct()

    rows = dims.with_user(rows, dimension("dim_user", asked("user_id")), as_of_ms)
    products = dims.product_dimension(dimension("dim_sku", asked("sku_id")), dimension("dim_spu"),
                                      dimension("dim_trademark"), dimension("dim_category3"))
    # Provinces come last: what they add is long, and they are few enough to be sent to the rows.
    return dims.with_province(dims.with_product(rows, products), dimension("dim_province", asked("province_id")))


def look_up_changing(order_rows: DataFrame, store: str, as_of_ms: int, folder: str, checkpoint: str,
                     once: bool = False):
    """Enrich an order stream from the dimension store, which is read anew for every
    micro-batch; each goes to a folder of its own, which a repeated attempt replaces."""
    # Looked up in the caller's session: that of a micro-batch plans without adaptive execution.
    spark = order_rows.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        # The rows are looked at once per dimension.
        asked = _State(spark, folder + "_asked", batch_id)
        rows = asked.put(batch, "rows")
        looked_up(rows, store, as_of_ms).write.mode("overwrite").options(**SMALL).parquet(
            os.path.join(folder, f"batch={batch_id}"))
        asked.drop("rows")

    writer = order_rows.writeStream.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write)


def fan_out_changing(transactions: DataFrame, read_rules: Callable[[], DataFrame], folder: str,
                     checkpoint: str, once: bool = False):
    """Fan a transaction stream out by the rules in force, which are read anew for every
    micro-batch: a rule added, paused or deleted meanwhile counts for what comes after.

    Every micro-batch goes to a folder of its own, which a repeated attempt replaces.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rules.fan_out(batch, read_rules()).write.mode("overwrite").parquet(
            os.path.join(folder, f"batch={batch_id}"))

    writer = transactions.writeStream.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write)


class Streams:
    """The streaming forms of the warehouse, over inputs whose tables are streams."""

    def __init__(self, inputs: Inputs, settings: Settings):
        self.inputs, self.settings = inputs, settings

    # ---- logs: text -> records -> repaired layer -> pages, starts, displays -> visits and bounces
    def dirty(self, lines: DataFrame) -> DataFrame:
        return logs.dirty_logs(logs.parse_logs(lines))

    def clean(self, lines: DataFrame) -> DataFrame:
        return logs.clean_logs(logs.parse_logs(lines))

    def repaired(self, lines: DataFrame) -> DataFrame:
        return self.repaired_records(self.clean(lines))

    def repaired_records(self, clean: DataFrame) -> DataFrame:
        """The repair looks at its records three times: they are better written once than parsed each time."""
        return state.repair_new_users(clean)

    def pages(self, repaired: DataFrame) -> DataFrame:
        return logs.split_pages(repaired)

    def starts(self, repaired: DataFrame) -> DataFrame:
        return logs.split_starts(repaired)

    def displays(self, repaired: DataFrame) -> DataFrame:
        return logs.split_displays(repaired)

    def unique_visits(self, pages: DataFrame) -> DataFrame:
        return state.daily_unique_visits(pages)

    def bounces(self, pages: DataFrame) -> DataFrame:
        return state.bounces(pages, self.settings.bounce_gap_ms)

    def visitor_stats(self, pages: DataFrame, uniques: DataFrame, bounced: DataFrame) -> DataFrame:
        """Bounces are known a gap after they happened, so the stats wait that much longer."""
        events = stats.visitor_events(pages, uniques, bounced, compact=True)
        wait = f"{self.settings.bounce_gap_ms + 10_000} milliseconds"
        return stats.visitor_stats(events, self.settings.window, wait)

    def running_totals(self, pages: DataFrame, uniques: DataFrame, bounced: DataFrame) -> DataFrame:
        return stats.visitor_running_totals(
            stats.visitor_events(pages, uniques, bounced, compact=True))

    def keyword_stats(self, pages: DataFrame) -> DataFrame:
        tokens = keywords.keyword_tokens(keywords.keyword_rows(pages))
        return keywords.keyword_stats(tokens, self.settings.window)

    # ---- changes
    def parsed_changes(self) -> DataFrame:
        return routing.parse_changes(self.inputs.change_log())

    def changes(self) -> DataFrame:
        return routing.normalize_type(routing.non_empty(routing.clean_changes(self.parsed_changes())))

    def dirty_changes(self) -> DataFrame:
        return routing.dirty_changes(self.parsed_changes())

    def facts(self) -> DataFrame:
        return routing.fact_changes(self.changes(), routing.checked_config(self.inputs.routes()))

    def images(self) -> DataFrame:
        """The last image of every row, deletes as marks; an update of the micro-batch's rows."""
        keyed = self.changes().withColumn("pk", F.col("data")["id"]).filter("pk IS NOT NULL")
        return changelog.last_images(keyed.select("table", "pk", "type", "data", "seq"), "table", "pk")

    def dim_changes(self) -> DataFrame:
        return routing.dim_changes(self.changes(), routing.checked_config(self.inputs.routes()))

    # ---- wide rows
    def order_rows(self) -> DataFrame:
        return wide.order_wide(wide.join_order_details(self.inputs.orders(), self.inputs.details()))

    def payment_rows(self, order_rows: DataFrame, delay: str = wide.IN_ORDER) -> DataFrame:
        """Order rows another job wrote may lag by the reach of its own join: ``delay`` covers it."""
        return wide.payment_wide(wide.join_payments(self.inputs.payments(), order_rows, delay=delay))

    def province_stats(self, order_wide: DataFrame) -> DataFrame:
        return stats.province_stats(order_wide, self.settings.window)

    def product_events(self, pages: DataFrame, order_rows: DataFrame, payment_rows: DataFrame) -> DataFrame:
        i = self.inputs
        return stats.product_events(pages, i.favors(), i.carts(), order_rows,
                                    payment_rows, i.refunds(), i.comments())

    def product_stats(self, pages: DataFrame, order_rows: DataFrame, payment_rows: DataFrame) -> DataFrame:
        return stats.product_stats(self.product_events(pages, order_rows, payment_rows), self.settings.window)
