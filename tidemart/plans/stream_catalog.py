"""Registered streaming queries: the streaming form runs over whole tables, its table is
the result.

The log layers are a chain of streams from text on (``LogChain``), and the rule jobs take
transactions in parts; both see several micro-batches and restarts.  Other layers are
published first and read back as streams.  A last record
far ahead in time lets everything before it end, so results are those of the batch forms.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import cached_property, partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemart.functions.times import event_time, parse_ms
from tidemart.operators import changelog, dims, keywords, routing, stats, wide
from tidemart.operators.keyed import first_per_key
from tidemart.plans.catalog import PAGE_COLUMNS, SETTINGS, json_data, warehouse
from tidemart.plans.warehouse import Warehouse
from tidemart.schemas import LOG
from tidemart.session import run_folder, shuffles_let_go, stored
from tidemart.sinks.dimensions import append_changes, dimension_sink, read_rows
from tidemart.sinks.topics import topic_sink
from tidemart.sources.tables import read_topic, table_source
from tidemart.sources.topics import PublishedInputs, add_to_topic, cuts, in_turn, publish, subscribe
from tidemart.streaming.jobs import (ORDER_DIMENSIONS, Streams, drained, fan_out_changing, look_up_changing,
                                     route_changes, taken_up)
from tidemart.streaming.intervals import join_changing
from tidemart.streaming.settled import bounces_changing, windows_changing
from tidemart.streaming.thresholds import alert_changing

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


# State partitions of the registered jobs.
STATE_WIDTH = 8

# A last record far ahead lets every window and undecided record before it end.
FLUSH, FLUSH_MS, FLUSH_TIME = "flush", 4_102_444_800_000, "2100-01-01 00:00:00"
# Bounds of the order chain's joins, and how far one of its layers may lag behind its topics.
SLACK_MS, REACH_MS, LAG_MS, IN_ORDER_MS = 5_000, 900_000, 10_000, 1
FLUSH_LINE = (f'{{"common":{{"mid":"{FLUSH}","vc":"{FLUSH}","is_new":"0"}},"page":{{"page_id":"search","item":"{FLUSH}",'
              f'"item_type":"keyword"}},"displays":[],"ts":{FLUSH_MS}}}')


def flushed(layer: DataFrame, **values) -> DataFrame:
    last = layer.sparkSession.range(1).select(*[
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in layer.schema.fields])
    return layer.unionByName(last)


class LogChain:
    """The log layers as streams write them, from text on.

    The lines arrive in parts.  After each, every job of the chain takes up what is new and
    stops; for the next part it starts again from its checkpoint.  So each job sees several
    micro-batches, and each but the first is a restart.
    """

    # Each layer with the one it reads; a layer comes after what it reads.
    READS = {"clean": "lines", "repaired": "clean", "pages": "repaired", "uniques": "pages", "bounced": "pages"}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.jobs = spark, Streams(None, SETTINGS)
        # Cut into parts by time below: worked out once, and dealt out so that a part comes from all files.
        lines = stored(warehouse(spark, folder).inputs.raw_log().repartition("seq"), "log-lines")
        last = flushed(lines.limit(0), value=FLUSH_LINE, seq=FLUSH_MS)
        self.parts = in_turn(lines, "seq")
        self.parts[-1] = self.parts[-1].unionByName(last)
        self.folder = run_folder(spark, "log-chain")
        self.schemas = {"lines": lines.schema}
        self.made = {"clean": self.jobs.clean, "repaired": self.jobs.repaired_records, "pages": self.jobs.pages,
                     "uniques": self.jobs.unique_visits}

    def _table(self, name: str) -> str:
        return os.path.join(self.folder, name, *(("batches", "batch=*") if name == "bounced" else ("table",)))

    def layer(self, name: str) -> DataFrame:
        """The layer as a stream."""
        return subscribe(self.spark, self._table(name), self.schemas[name])

    def written(self, name: str) -> DataFrame:
        """The layer as it stands once all parts are taken up."""
        self.run(lambda: None, name)
        return self.spark.read.schema(self.schemas[name]).parquet(self._table(name))

    def _take_up(self, name: str) -> None:
        folder, read = os.path.join(self.folder, name), self.layer(self.READS[name])
        if name == "bounced":
            self.schemas[name] = read.schema
            bounces_changing(read, SETTINGS.bounce_gap_ms, folder, os.path.join(folder, "checkpoint"),
                             once=True).start().awaitTermination()
        else:
            stream = self.made[name](read)
            self.schemas[name] = stream.schema
            taken_up(self.spark, stream, folder, STATE_WIDTH)

    def _needed(self, names: tuple[str, ...]) -> list[str]:
        wanted = set(names)
        for name in reversed(self.READS):
            if name in wanted:
                wanted.add(self.READS[name])
        return [name for name in self.READS if name in wanted]

    def run(self, last: Callable[[], object], *names: str) -> None:
        """Take up all parts; after each, ``last`` runs over the layers named."""
        for part in self.parts:
            add_to_topic(part, os.path.join(self.folder, "lines", "table"))
            for name in self._needed(names):
                self._take_up(name)
            last()

    def result(self, build: Callable[..., DataFrame], *names: str, mode: str | None = None) -> DataFrame:
        """The table of the stream that ``build`` makes of the layers named."""
        made = {}

        def last() -> None:
            stream = build(*[self.layer(name) for name in names])
            made["schema"] = stream.schema
            made["table"] = taken_up(self.spark, stream, os.path.join(self.folder, "result"), STATE_WIDTH, mode)
        self.run(last, *names)
        fields = [*made["schema"].fields, *([T.StructField("batch", T.LongType())] if mode else [])]
        return self.spark.read.schema(T.StructType(fields)).parquet(made["table"])

    def windows(self, events_of: Callable[..., DataFrame], statistics: Callable[[DataFrame], DataFrame], moment: Column,
                delay_ms: int, *names: str) -> DataFrame:
        """Windowed statistics of the events that ``events_of`` makes of the layers named."""
        job = WindowJob(self.spark, os.path.join(self.folder, "windows"), statistics, moment, delay_ms)
        self.run(lambda: job.take_up(events_of(*[self.layer(name) for name in names])), *names)
        return job.table()


class WindowJob:
    """One windowed statistic as a job that can be started again."""

    def __init__(self, spark: SparkSession, folder: str, statistics: Callable[[DataFrame], DataFrame], moment: Column,
                 delay_ms: int):
        self.spark, self.folder = spark, folder
        self.statistics, self.moment, self.delay_ms = statistics, moment, delay_ms

    def take_up(self, events: DataFrame) -> None:
        self.schema = self.statistics(self.spark.createDataFrame([], events.schema)).schema
        windows_changing(events, self.statistics, self.moment, SETTINGS.window, self.folder,
                         os.path.join(self.folder, "checkpoint"), self.delay_ms, once=True).start().awaitTermination()

    def table(self) -> DataFrame:
        found = self.spark.read.schema(self.schema).parquet(os.path.join(self.folder, "batches"))
        return found.select(*self.schema.names)


class OrderChain:
    """The order layers as streams write them: order rows, wide rows, payment rows.

    Orders, details and payments arrive in parts, cut at the same times.  After each part every
    job takes up what is new and stops; for the next it starts again from its checkpoint.  The two
    joins hold rows in tables (``streaming/intervals.py``).  No layer comes from a batch job.
    """

    def __init__(self, bench: Bench):
        self.bench, self.spark = bench, bench.spark
        self.folder = run_folder(self.spark, bench.name + "-chain")
        i, moment = bench.batch.inputs, F.unix_timestamp("create_time")
        i.keep_lines()
        topics = {"orders": i.orders(), "details": i.details(), "payments": i.payments()}
        at = cuts(topics["orders"], moment)
        self.parts = {name: in_turn(layer, moment, at=at) for name, layer in topics.items()}
        # A last order with its detail lets every window before it end.
        last = {"orders": dict(id=-1, create_time=FLUSH_TIME),
                "details": dict(id=-1, order_id=-1, sku_id=-1, create_time=FLUSH_TIME)}
        for name, values in last.items():
            end = flushed(topics[name].limit(0), **values)
            self.parts[name][-1] = self.parts[name][-1].unionByName(end)
        self.schemas = {name: layer.schema for name, layer in topics.items()}

    def _topic(self, name: str) -> DataFrame:
        return subscribe(self.spark, os.path.join(self.folder, name), self.schemas[name])

    def layer(self, name: str) -> DataFrame:
        """A written layer as a stream, whichever micro-batch made its rows."""
        return subscribe(self.spark, os.path.join(self.folder, name, "batches", "batch=*"), self.schemas[name])

    @cached_property
    def store(self) -> str:
        return self.bench.dimension_store()

    def _joined(self, name: str, left: DataFrame, right: DataFrame, pairs: Callable[[DataFrame, DataFrame], DataFrame],
                earliest_ms: int, latest_ms: int, delay_ms: int) -> None:
        folder = os.path.join(self.folder, name)
        self.schemas[name] = pairs(*[self.spark.createDataFrame([], side.schema) for side in (left, right)]).schema
        join_changing(left, right, pairs, parse_ms("create_time"), earliest_ms, latest_ms, folder,
                      os.path.join(folder, "checkpoint"), delay_ms, once=True).start().awaitTermination()

    def _looked_up(self, rows: DataFrame) -> None:
        folder = os.path.join(self.folder, "order_wide")
        look_up_changing(rows, self.store, SETTINGS.as_of_ms, os.path.join(folder, "batches"),
                         os.path.join(folder, "checkpoint"), once=True).start().awaitTermination()

    def run(self, *, wide_rows: bool = False, payments: bool = False, last: Callable[[], object] = lambda: None) -> None:
        """Take up all parts; ``last`` runs after each part too."""
        for turn in range(len(self.parts["orders"])):
            with shuffles_let_go(self.spark):
                self._take_turn(turn, wide_rows, payments)
                last()

    def _take_turn(self, turn: int, wide_rows: bool, payments: bool) -> None:
        for name, parts in self.parts.items():
            add_to_topic(parts[turn], os.path.join(self.folder, name))
        self._joined("order_rows", self._topic("orders"), self._topic("details"),
                     lambda orders, details: wide.order_wide(wide.join_order_details(orders, details)),
                     -SLACK_MS, SLACK_MS, IN_ORDER_MS)
        above = "order_rows"
        if wide_rows:
            self._looked_up(self.layer("order_rows"))
            self.schemas["order_wide"], above = self.schemas["order_rows"], "order_wide"
        if payments:
            self._joined("payment_rows", self._topic("payments"), self.layer(above),
                         lambda paid, rows: wide.payment_wide(wide.join_payments(paid, rows)),
                         -REACH_MS, 0, LAG_MS)

    def result(self, **layers: bool) -> DataFrame:
        self.run(**layers)
        name = "payment_rows" if layers.get("payments") else "order_rows"
        found = self.spark.read.schema(self.schemas[name]).parquet(os.path.join(self.folder, name, "batches"))
        return found.select(*self.schemas[name].names).filter("order_id >= 0")


class Bench:
    """One streaming query's inputs: batch layers, and the means to stream them."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name = spark, folder, name
        self.batch: Warehouse = warehouse(spark, folder)
        self.topics = run_folder(spark, name + "-topics")

    @cached_property
    def log(self) -> LogChain:
        return LogChain(self.spark, self.folder)

    @cached_property
    def orders(self) -> OrderChain:
        return OrderChain(self)

    def topic(self, name: str, layer: DataFrame) -> DataFrame:
        return subscribe(self.spark, publish(layer, self.topics, name), layer.schema)

    def streams(self, *names: str) -> Streams:
        published = {name: self.topic(name, getattr(self.batch.inputs, name)()) for name in names}
        return Streams(PublishedInputs(self.batch.inputs.tables, published), SETTINGS)

    def drained(self, stream: DataFrame) -> DataFrame:
        return drained(self.spark, stream, self.name, STATE_WIDTH)

    def dimension_store(self) -> str:
        """The dimensions of the wide order row, as the dimension store keeps them."""
        i = self.batch.inputs
        tables = {"dim_user": i.users(), "dim_province": i.provinces(), "dim_sku": i.skus(),
                  "dim_spu": i.spus(), "dim_trademark": i.trademarks(), "dim_category3": i.categories()}
        store = run_folder(self.spark, self.name + "-store")
        for n, (table, columns) in enumerate(ORDER_DIMENSIONS.items()):
            entries = [x for name in columns for x in (F.lit(name), F.col(name))]
            append_changes(tables[table].select(
                F.lit(table).alias("sink_table"), F.col("id").alias("pk"), F.lit("insert").alias("type"),
                F.lit(n).cast("bigint").alias("seq"), F.create_map(*entries).alias("data")), store, n)
        return store

    def transactions_in_turn(self, job: Callable[[DataFrame], object]) -> None:
        """Run a job of the transactions, which arrive in parts; it starts again for each."""
        transactions = self.batch.inputs.transactions()
        topic = os.path.join(self.topics, "transactions")
        for part in in_turn(transactions, "eventTime"):
            add_to_topic(part, topic)
            job(subscribe(self.spark, topic, transactions.schema)).start().awaitTermination()

    def rules_now(self) -> DataFrame:
        return warehouse(self.spark, self.folder).active_rules


def stream(build: Callable[[Bench], DataFrame]) -> Callable[[Bench], DataFrame]:
    name = build.__name__

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Bench(spark, folder, name))
    _REGISTRY[name] = run
    return build


def routed_changes(b: Bench) -> str:
    """The folder the routing job leaves, the config read anew for every micro-batch."""
    changes = b.topic("changes", b.batch.inputs.change_log())
    parsed = Streams(PublishedInputs(b.batch.inputs.tables, {"change_log": changes}), SETTINGS)
    folder = run_folder(b.spark, b.name)
    route_changes(parsed.parsed_changes(), b.batch.inputs.routes, folder,
                  os.path.join(folder, "checkpoint"), once=True).start().awaitTermination()
    return folder


def of_devices(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("common.mid") != FLUSH)


@stream
def stream_log_dirty(b: Bench) -> DataFrame:
    return b.log.result(b.log.jobs.dirty, "lines")


@stream
def stream_log_split_display(b: Bench) -> DataFrame:
    return b.log.result(b.log.jobs.displays, "repaired")


@stream
def stream_log_split_page(b: Bench) -> DataFrame:
    return of_devices(b.log.written("pages")).select(*PAGE_COLUMNS)


@stream
def stream_log_split_start(b: Bench) -> DataFrame:
    return b.log.result(b.log.jobs.starts, "repaired").select(*PAGE_COLUMNS, "start")


@stream
def stream_log_new_user_repair(b: Bench) -> DataFrame:
    return of_devices(b.log.written("repaired")).select(*PAGE_COLUMNS)


@stream
def stream_daily_unique_visit(b: Bench) -> DataFrame:
    return of_devices(b.log.written("uniques")).select(*PAGE_COLUMNS)


@stream
def stream_user_bounce(b: Bench) -> DataFrame:
    return of_devices(b.log.written("bounced")).select(*PAGE_COLUMNS)


@stream
def stream_visitor_stats(b: Bench) -> DataFrame:
    """Bounces are known a gap after they happened, so the statistics wait that much longer."""
    return b.log.windows(partial(stats.visitor_events, compact=True), partial(stats.visitor_stats, size=SETTINGS.window),
                         event_time("ts"), SETTINGS.bounce_gap_ms + 10_000, "pages", "uniques", "bounced")


@stream
def stream_visitor_running_totals(b: Bench) -> DataFrame:
    """Update mode: the newest batch of every key holds its totals."""
    updates = b.log.result(b.log.jobs.running_totals, "pages", "uniques", "bounced", mode="update")
    last = first_per_key(updates, ["vc", "ch", "ar", "is_new"], [F.col("batch").desc()]).drop("batch")
    return last.filter(F.col("vc") != FLUSH)


@stream
def stream_keyword_stats(b: Bench) -> DataFrame:
    return b.log.windows(lambda pages: keywords.keyword_tokens(keywords.keyword_rows(pages)),
                         partial(keywords.keyword_stats, size=SETTINGS.window), F.col("rowtime"), 2_000, "pages")


@stream
def stream_cdc_route_fact(b: Bench) -> DataFrame:
    return json_data(b.drained(b.streams("change_log").facts()))


@stream
def stream_cdc_route_dim(b: Bench) -> DataFrame:
    return json_data(b.drained(b.streams("change_log").dim_changes()))


@stream
def stream_cdc_dirty(b: Bench) -> DataFrame:
    """What the routing job sets apart because it cannot be used."""
    folder = routed_changes(b)
    apart = b.spark.read.parquet(os.path.join(folder, "dirty"))
    return apart.filter(F.col("problem").isin("malformed", "no_object", "missing_key")).select("seq", "problem")


@stream
def stream_cdc_accounted(b: Bench) -> DataFrame:
    """Where the changes of the feed went, in all: sinks, or set apart with the reason."""
    folder = routed_changes(b)
    read = lambda name: b.spark.read.parquet(os.path.join(folder, name))
    went = (read("facts").select(F.lit("fact").alias("went"))
            .unionByName(read(os.path.join("dims", "changes")).select(F.lit("dimension").alias("went")))
            .unionByName(read("dirty").select(F.col("problem").alias("went"))))
    return went.groupBy("went").agg(F.count(F.lit(1)).alias("changes"))


@stream
def stream_fact_topics(b: Bench) -> DataFrame:
    """Facts to the topics their routes name, and the topics read back as streams of text."""
    facts = routing.fact_messages(b.streams("change_log").facts())
    folder = run_folder(b.spark, b.name)
    topics = os.path.join(folder, "topics")
    topic_sink(facts, os.path.join(folder, "checkpoint"), folder=topics, once=True).start().awaitTermination()
    # One stream per topic: the routing config names them.
    names = [r[0] for r in b.batch.config.filter(F.col("sink_type") == routing.FACT_SINK)
             .select("sink_table").distinct().toLocalIterator()]
    lines = [read_topic(b.spark, os.path.join(topics, f"topic={name}"), format="parquet")
             .select(F.lit(name).alias("topic"), "value") for name in names]
    return b.drained(reduce(DataFrame.unionByName, lines))


@stream
def stream_log_table(b: Bench) -> DataFrame:
    """The log topic as a typed table with event time and watermark, queried by name."""
    def visits(lines: DataFrame) -> DataFrame:
        table_source(lines, LOG, "2 seconds", view="log_table")
        return b.spark.sql("""
            SELECT common.mid AS mid, ts, date_format(rowtime, 'yyyy-MM-dd HH:mm:ss') AS rowtime
            FROM log_table WHERE page.page_id IS NOT NULL AND common.mid IS NOT NULL""")
    return b.log.result(visits, "lines").filter(F.col("mid") != FLUSH)


def taken_backwards(b: Bench, images: Callable[[], DataFrame], topics: dict[str, DataFrame],
                    order: dict[str, str]) -> DataFrame:
    """All updates of a stream of last images whose topics arrive in parts, the last changes first."""
    folder = run_folder(b.spark, b.name)
    parts = {name: in_turn(layer, order[name])[::-1] for name, layer in topics.items()}
    for turn in range(max(len(p) for p in parts.values())):
        for name, pieces in parts.items():
            if turn < len(pieces):
                add_to_topic(pieces[turn], os.path.join(b.topics, name))
        table = taken_up(b.spark, images(), folder, STATE_WIDTH, mode="update")
    return b.spark.read.schema(images().schema).parquet(table)


@stream
def stream_changelog_latest(b: Bench) -> DataFrame:
    """The last image of every row, of changes that arrive out of order over several micro-batches."""
    lines = b.batch.inputs.change_log()

    def images() -> DataFrame:
        feed = subscribe(b.spark, os.path.join(b.topics, "lines"), lines.schema)
        return Streams(PublishedInputs(b.batch.inputs.tables, {"change_log": feed}), SETTINGS).images()
    updates = taken_backwards(b, images, {"lines": lines}, {"lines": "seq"})
    return json_data(changelog.latest_images(updates, ["table", "pk"])).select("table", "pk", "type", "data", "seq")


@stream
def stream_changelog_bootstrap(b: Bench) -> DataFrame:
    """Snapshot chunks and changes as two streams; neither waits for the other."""
    i = b.batch.inputs
    topics = {"chunks": i.customer_chunks(), "history": i.customer_history()}

    def images() -> DataFrame:
        read = {name: subscribe(b.spark, os.path.join(b.topics, name), layer.schema) for name, layer in topics.items()}
        return changelog.last_images(b.batch.customer_feed(read["chunks"], read["history"]), "pk")
    updates = taken_backwards(b, images, topics, {"chunks": "low", "history": "seq"})
    return changelog.latest_images(updates, ["pk"]).select("pk", "name", "gender")


@stream
def stream_dim_upsert(b: Bench) -> DataFrame:
    """Routed changes through the dimension store, read back as current rows."""
    routed = b.streams("change_log").dim_changes()
    folder = run_folder(b.spark, b.name)
    store = os.path.join(folder, "store")
    dimension_sink(routed, store, os.path.join(folder, "checkpoint"),
                   once=True).start().awaitTermination()
    return json_data(read_rows(b.spark, store))


@stream
def stream_cdc_fact_payload(b: Bench) -> DataFrame:
    """Facts per topic, with the config read anew for every micro-batch."""
    folder = routed_changes(b)
    return b.spark.read.parquet(os.path.join(folder, "facts")).select("topic", "value")


@stream
def stream_order_detail_interval_join(b: Bench) -> DataFrame:
    return b.orders.result().select("order_id", "detail_id", "sku_id", "split_total_amount", "create_time")


@stream
def stream_payment_interval_join(b: Bench) -> DataFrame:
    return b.orders.result(payments=True).select(
        "payment_id", "order_id", "detail_id", "sku_id", "payment_create_time", "order_create_time")


@stream
def stream_payment_wide(b: Bench) -> DataFrame:
    """Payments joined with the wide rows that the order job wrote."""
    return b.orders.result(wide_rows=True, payments=True)


@stream
def stream_order_wide(b: Bench) -> DataFrame:
    """The order stream, looked up in the dimension store as it stands at each micro-batch."""
    b.orders.run(wide_rows=True)
    rows = b.spark.read.parquet(os.path.join(b.orders.folder, "order_wide", "batches")).drop("batch")
    return rows.filter("order_id >= 0")


@stream
def stream_province_stats(b: Bench) -> DataFrame:
    chain = b.orders
    job = WindowJob(b.spark, os.path.join(chain.folder, "windows"), partial(stats.province_stats, size=SETTINGS.window),
                    event_time(parse_ms("create_time")), IN_ORDER_MS)
    chain.run(wide_rows=True, last=lambda: job.take_up(chain.layer("order_wide").select(*stats.PROVINCE_INPUTS)))
    return job.table()


def product_stats_table(b: Bench) -> DataFrame:
    chain, log = b.orders, b.log
    jobs = b.streams("favors", "carts", "refunds", "comments")
    chain.run(payments=True)
    log.written("pages")
    events = jobs.product_events(log.layer("pages"), chain.layer("order_rows"), chain.layer("payment_rows"))
    job = WindowJob(b.spark, os.path.join(chain.folder, "windows"), partial(stats.product_stats, size=SETTINGS.window),
                    event_time("ts"), 10_000)
    with shuffles_let_go(b.spark):
        job.take_up(events.filter(F.col("sku_id").isNotNull()))
    return job.table()


@stream
def stream_product_stats(b: Bench) -> DataFrame:
    """All seven kinds of events; pages, orders and payments from layers that streams wrote."""
    return product_stats_table(b)


@stream
def stream_product_stats_enriched(b: Bench) -> DataFrame:
    """Finished windows, a stream again, looked up in the product dimension."""
    table = product_stats_table(b)
    rows = b.topic("product_stats", table)
    return b.drained(dims.with_product(rows, b.batch.products, price=True))


@stream
def stream_rule_fanout(b: Bench) -> DataFrame:
    """Transactions of several micro-batches, fanned out by the rules as each finds them."""
    folder = run_folder(b.spark, b.name)
    layer, checkpoint = os.path.join(folder, "layer"), os.path.join(folder, "checkpoint")
    b.transactions_in_turn(lambda rows: fan_out_changing(rows, b.rules_now, layer, checkpoint, once=True))
    return b.spark.read.parquet(layer).select(*b.batch.inputs.transactions().columns, "rule_id", "key")


@stream
def stream_rule_alerts(b: Bench) -> DataFrame:
    """Alerts of several micro-batches, by the rules as each finds them."""
    folder = run_folder(b.spark, b.name)
    b.transactions_in_turn(lambda rows: alert_changing(
        rows, b.rules_now, folder, os.path.join(folder, "checkpoint"), once=True))
    return b.spark.read.parquet(os.path.join(folder, "alerts")).select(
        "rule_id", "key", "transactionId", "eventTime", "value")


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)
