"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.functions import times
from tidemart.functions.codes import code_table
from tidemart.functions.records import drop_blank_entries, is_entry_page, sorted_json
from tidemart.operators import changelog, dims, keywords, logs, routing, rules, stats, visits, wide
from tidemart.plans.warehouse import Settings, Warehouse
from tidemart.schemas import LOG, PRODUCT_STATS_COLUMNS
from tidemart.session import apply_settings
from tidemart.sources.derived import Inputs, money
from tidemart.sources.tables import Tables

# The derived log is sparse (one device's events are hours apart), so windows and the
# bounce gap are wider than those of a live shop.
AS_OF_MS = 1_704_067_200_000
SETTINGS = Settings(window="1 hour", bounce_gap_ms=6 * 3_600_000,
                    as_of_ms=AS_OF_MS, stats_ms=AS_OF_MS)

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def warehouse(spark: SparkSession, folder: str, streams: tuple[str, ...] = ()) -> Warehouse:
    apply_settings(spark)
    return Warehouse(Inputs(Tables(spark, folder, streams)), SETTINGS)


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(warehouse(spark, folder))
    _REGISTRY[build.__name__] = run
    return build


PAGE_COLUMNS = (
    "seq", "ts", "common.mid", "common.vc", "common.ch", "common.ar", "common.is_new",
    "page.page_id", "page.last_page_id", "page.during_time", "page.item", "page.item_type")


def flat_pages(df: DataFrame) -> DataFrame:
    return df.select(*PAGE_COLUMNS)


def json_data(df: DataFrame) -> DataFrame:
    return df.withColumn("data", sorted_json(F.col("data")))


# ---- logs -----------------------------------------------------------------------------

@query
def dirty_records(w: Warehouse) -> DataFrame:
    return logs.dirty_logs(logs.parse_logs(w.inputs.raw_log()))


@query
def log_parse(w: Warehouse) -> DataFrame:
    clean = logs.clean_logs(logs.parse_logs(w.inputs.raw_log()))
    return clean.select(*PAGE_COLUMNS, F.size("displays").cast("bigint").alias("displays"))


@query
def log_parse_strict(w: Warehouse) -> DataFrame:
    """The usable lines once more, by the parser that fails the job on any other."""
    usable = logs.parse_logs(w.inputs.raw_log()).filter("problem IS NULL").select("seq", F.col("_raw").alias("value"))
    return logs.parse_strict(usable, LOG).select(
        *PAGE_COLUMNS, F.size("displays").cast("bigint").alias("displays"))


@query
def log_new_user_repair(w: Warehouse) -> DataFrame:
    return flat_pages(w.repaired)


@query
def log_split_page(w: Warehouse) -> DataFrame:
    return flat_pages(w.pages)


@query
def log_split_start(w: Warehouse) -> DataFrame:
    starts = logs.split_starts(w.repaired)
    return starts.select(*PAGE_COLUMNS, "start")


@query
def log_split_display(w: Warehouse) -> DataFrame:
    return logs.split_displays(w.log)


@query
def entry_pages(w: Warehouse) -> DataFrame:
    return flat_pages(w.pages.filter(is_entry_page()))


@query
def daily_unique_visit(w: Warehouse) -> DataFrame:
    return flat_pages(w.uniques)


@query
def user_bounce(w: Warehouse) -> DataFrame:
    return flat_pages(w.bounced)


@query
def visitor_events(w: Warehouse) -> DataFrame:
    return w.visitor_events()


@query
def visitor_stats(w: Warehouse) -> DataFrame:
    return stats.visitor_stats(w.visitor_events(compact=True), w.settings.window)


@query
def visitor_running_totals(w: Warehouse) -> DataFrame:
    return stats.visitor_running_totals(w.visitor_events(compact=True))


@query
def late_audit(w: Warehouse) -> DataFrame:
    # The log is in order; arrival is mixed up by up to 19 places for the audit.
    arrival = (F.col("seq") + F.col("seq") * 7 % 20) * 1000 + F.col("seq") % 1000
    mixed = w.log.select("seq", F.col("common.mid").alias("mid"), "ts", arrival.alias("arrival"))
    return visits.late_records(mixed, delay_ms=20 * 60_000)


@query
def keyword_filter(w: Warehouse) -> DataFrame:
    return w.searches.select("full_word", times.second_text(F.col("rowtime")).alias("rowtime"))


@query
def keyword_tokens(w: Warehouse) -> DataFrame:
    return w.tokens.select("keyword", times.second_text(F.col("rowtime")).alias("rowtime"))


@query
def keyword_stats(w: Warehouse) -> DataFrame:
    return keywords.keyword_stats(w.tokens, w.settings.window)


@query
def rowtime_from_ms(w: Warehouse) -> DataFrame:
    return w.log.select("seq", "ts", times.second_text(times.rowtime("ts")).alias("rowtime"),
                        times.day_text("ts").alias("day"))


# ---- changes --------------------------------------------------------------------------

@query
def cdc_nonempty(w: Warehouse) -> DataFrame:
    return json_data(w.changes)


@query
def cdc_bootstrap_normalize(w: Warehouse) -> DataFrame:
    return json_data(w.normal_changes)


@query
def cdc_route_fact(w: Warehouse) -> DataFrame:
    return json_data(w.facts)


@query
def cdc_route_dim(w: Warehouse) -> DataFrame:
    return json_data(w.dim_changes)


@query
def cdc_unrouted(w: Warehouse) -> DataFrame:
    return json_data(routing.unrouted_changes(w.normal_changes, w.config))


@query
def cdc_column_prune(w: Warehouse) -> DataFrame:
    routed = routing.routed_changes(w.normal_changes.withColumn("_all", F.size("data")), w.config)
    return routed.filter("pk IS NOT NULL").select(
        "table", "type", "seq", F.size("data").cast("bigint").alias("kept"),
        (F.col("_all") - F.size("data")).cast("bigint").alias("pruned"))


@query
def cdc_dirty(w: Warehouse) -> DataFrame:
    """Change text that cannot be used, and routed changes without a key."""
    keyless = routing.keyless_changes(w.normal_changes, w.config)
    return routing.dirty_changes(w.change_lines).select("seq", "problem").unionByName(
        keyless.select("seq", F.lit("missing_key").alias("problem")))


@query
def cdc_fact_payload(w: Warehouse) -> DataFrame:
    return routing.fact_messages(w.facts)


@query
def dim_upsert(w: Warehouse) -> DataFrame:
    return json_data(changelog.upserted_rows(w.dim_changes))


@query
def dim_schema_from_config(w: Warehouse) -> DataFrame:
    return routing.dim_statements(w.route_config, "dims")


@query
def config_latest(w: Warehouse) -> DataFrame:
    return w.route_config


@query
def config_rename(w: Warehouse) -> DataFrame:
    return routing.rename_to_camel(w.route_config)


@query
def changelog_envelope(w: Warehouse) -> DataFrame:
    return json_data(changelog.envelope(w.inputs.customer_feed())).withColumn(
        "before", sorted_json(F.col("before")))


@query
def changelog_latest(w: Warehouse) -> DataFrame:
    keyed = w.normal_changes.withColumn("pk", F.col("data")["id"])
    latest = changelog.latest_images(keyed.filter("pk IS NOT NULL"), ["table", "pk"])
    return json_data(latest).select("table", "pk", "type", "data", "seq")


@query
def changelog_bootstrap(w: Warehouse) -> DataFrame:
    """Customers as their snapshot and the changes since its first low mark tell them."""
    feed = w.customer_feed(w.inputs.customer_chunks(), w.inputs.customer_history())
    return changelog.latest_images(feed, ["pk"]).select("pk", "name", "gender")


@query
def route_as_of(w: Warehouse) -> DataFrame:
    """Changes sent where the config stood at their place in its feed, not where it ended up."""
    routed = routing.routes_as_of(w.inputs.placed_changes(), changelog.envelope(w.inputs.route_feed()), "place")
    return routed.filter(F.col("route").isNotNull()).select(
        "id", "table", "type", "place", "route.sink_type", "route.sink_table", "route.sink_columns",
        F.col("route.seq").alias("route_seq"))


@query
def blank_entry_filter(w: Warehouse) -> DataFrame:
    flags = F.create_map(
        F.lit("flag"), F.when(F.col("l_returnflag") == "N", " ").otherwise(F.col("l_returnflag")),
        F.lit("status"), F.col("l_linestatus"), F.lit(" "), F.lit("x"))
    return w.inputs.tables("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        sorted_json(drop_blank_entries(flags)).alias("data"))


# ---- wide rows ------------------------------------------------------------------------

@query
def order_time_parts(w: Warehouse) -> DataFrame:
    return wide.order_time_parts(w.inputs.orders()).select(
        "id", "create_time", "create_date", "create_hour", "create_ts")


@query
def order_detail_interval_join(w: Warehouse) -> DataFrame:
    return w.order_pairs.select(
        F.col("l_id").alias("order_id"), F.col("r_id").alias("detail_id"),
        F.col("r_sku_id").alias("sku_id"), F.col("r_split_total_amount").alias("split_total_amount"),
        F.col("l_create_ts").alias("order_ms"), F.col("r_create_ts").alias("detail_ms"))


@query
def payment_interval_join(w: Warehouse) -> DataFrame:
    pairs = wide.join_payments(w.inputs.payments(), w.order_rows)
    return pairs.select(
        F.col("l_id").alias("payment_id"), F.col("l_order_id").alias("order_id"),
        F.col("r_detail_id").alias("detail_id"), F.col("r_sku_id").alias("sku_id"),
        F.col("l_create_time").alias("payment_create_time"),
        F.col("r_create_time").alias("order_create_time"))


@query
def order_wide(w: Warehouse) -> DataFrame:
    return w.order_wide


@query
def payment_wide(w: Warehouse) -> DataFrame:
    return w.payment_wide


@query
def dim_user(w: Warehouse) -> DataFrame:
    orders = w.inputs.orders().select("id", "user_id")
    return dims.with_user(orders, w.inputs.users(), w.settings.as_of_ms)


@query
def dim_province(w: Warehouse) -> DataFrame:
    return dims.with_province(w.inputs.orders().select("id", "province_id"), w.inputs.provinces())


@query
def dim_product(w: Warehouse) -> DataFrame:
    return dims.with_product(w.inputs.details().select("id", "sku_id"), w.products, price=True)


@query
def dim_lookup_multi(w: Warehouse) -> DataFrame:
    """Refunded lines with the finished line of the same order and product, if there is one."""
    lines = w.inputs.tables("lineitem")
    refunds = lines.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        money("l_extendedprice").alias("refund_amount"))
    finished = lines.filter("l_linestatus = 'F'").groupBy("l_orderkey", "l_partkey").agg(
        F.min("l_linestatus").alias("status"), F.min(money("l_extendedprice")).alias("price"))
    return dims.lookup(refunds, finished, {"order_id": "l_orderkey", "sku_id": "l_partkey"},
                       {"line_status": "status", "first_price": "price"})


@query
def wide_coalesce_merge(w: Warehouse) -> DataFrame:
    """Wide rows of all details that know only their order, completed by rows that know only
    the detail."""
    orders = wide.order_time_parts(w.inputs.orders()).withColumnRenamed("id", "order_id")
    details = w.inputs.details().withColumnRenamed("id", "detail_id")
    types = dict(w.order_rows.dtypes)

    def shaped(df: DataFrame, known: tuple[str, ...]) -> DataFrame:
        return df.select("order_id", "detail_id", *[
            (F.col(name) if name in known else F.lit(None)).cast(types[name]).alias(name)
            for name in (*wide.MERGED_COLUMNS, *wide.OWN_COLUMNS)])

    of_details = shaped(details, ("sku_id", "sku_name", "order_price", "sku_num"))
    of_orders = shaped(
        details.select("order_id", "detail_id").join(orders, "order_id"),
        ("order_status", "create_time", "create_date", "coupon_reduce_amount", "activity_reduce_amount",
         "original_total_amount", "feight_fee", "total_amount", "user_id"))
    return wide.merge_wide(of_orders, of_details, "order_id", "detail_id")


# ---- products and provinces -----------------------------------------------------------

@query
def product_click(w: Warehouse) -> DataFrame:
    return stats.product_clicks(w.raw_pages).select("sku_id", "ts", "click_ct")


@query
def product_display(w: Warehouse) -> DataFrame:
    return stats.product_displays(w.raw_pages).select("sku_id", "ts", "display_ct")


@query
def product_favor_cart(w: Warehouse) -> DataFrame:
    both = stats.product_favors(w.inputs.favors()).unionByName(stats.product_carts(w.inputs.carts()))
    return both.select("sku_id", "ts", "favor_ct", "cart_ct")


@query
def product_order(w: Warehouse) -> DataFrame:
    return stats.product_orders(w.order_rows).select(
        "sku_id", "ts", "order_id", "order_sku_num", "order_amount", "order_split_amount")


@query
def product_payment(w: Warehouse) -> DataFrame:
    return stats.product_payments(w.payment_rows).select(
        "sku_id", "ts", "order_id", "payment_amount")


@query
def product_refund(w: Warehouse) -> DataFrame:
    return stats.product_refunds(w.inputs.refunds()).select(
        "sku_id", "ts", "order_id", "refund_amount")


@query
def product_comment(w: Warehouse) -> DataFrame:
    return stats.product_comments(w.inputs.comments()).select(
        "sku_id", "ts", "comment_ct", "good_comment_ct")


@query
def product_events(w: Warehouse) -> DataFrame:
    return w.product_events()


@query
def product_stats(w: Warehouse) -> DataFrame:
    return w.product_stats()


@query
def product_stats_enriched(w: Warehouse) -> DataFrame:
    return w.product_stats_enriched()


@query
def sink_projection(w: Warehouse) -> DataFrame:
    finished = stats.stamped(w.product_stats_enriched(), w.settings.stats_ms)
    return stats.sink_row(finished, PRODUCT_STATS_COLUMNS)


@query
def province_stats(w: Warehouse) -> DataFrame:
    return stats.province_stats(dims.with_province(w.order_rows, w.inputs.provinces()),
                                w.settings.window)


@query
def ts_parse_plus8(w: Warehouse) -> DataFrame:
    return w.inputs.orders().select("id", "create_time",
                                    times.parse_ms_plus8("create_time").alias("ts"))


@query
def code_labels(w: Warehouse) -> DataFrame:
    # The code table is a fixed list of under 50 rows.
    labels = F.broadcast(code_table(w.inputs.spark).filter("code_group = 'order_status'"))
    orders = w.inputs.orders().select("id", "order_status")
    return orders.join(labels, F.col("order_status") == F.col("code"), "left").select(
        "id", "order_status", "label")


# ---- rules ----------------------------------------------------------------------------

def flat_rules(df: DataFrame) -> DataFrame:
    return df.select("seq", "rule_id", "rule_state",
                     F.array_join("grouping_keys", "&").alias("grouping_keys"),
                     "aggregate_field", "aggregator", "limit_operator", "limit_value",
                     "window_minutes", "control_type")


@query
def rule_ingest(w: Warehouse) -> DataFrame:
    return flat_rules(rules.valid_rules(w.rule_lines))


@query
def rule_dropped(w: Warehouse) -> DataFrame:
    return rules.dropped_rules(w.rule_lines).select("seq")


@query
def rule_active_set(w: Warehouse) -> DataFrame:
    return flat_rules(w.active_rules)


@query
def rule_unusable(w: Warehouse) -> DataFrame:
    return rules.unusable_rules(w.active_rules).select("seq", "rule_id", "reason")


@query
def rules_in_force(w: Warehouse) -> DataFrame:
    return rules.rules_in_force(w.active_rules)


@query
def txn_ingest(w: Warehouse) -> DataFrame:
    return rules.parse_transactions(w.inputs.transaction_feed(),
                                    ingested_ms=w.settings.as_of_ms).drop("seq")


@query
def rule_fanout(w: Warehouse) -> DataFrame:
    return w.fanned().select(*w.inputs.transactions().columns, "rule_id", "key")


@query
def rule_as_of(w: Warehouse) -> DataFrame:
    """Transactions fanned out by the rules in force at their place in the feed, not by those at its end."""
    placed, lines = w.inputs.placed_transactions(), rules.valid_rules(w.rule_lines)
    return rules.fan_out_as_of(placed, lines, "place").select(
        "transactionId", "place", "rule_id", "key", "amount", "aggregator", "limit_value")


@query
def rule_alerts(w: Warehouse) -> DataFrame:
    return rules.rule_alerts(w.fanned()).select(
        "rule_id", "key", "transactionId", "eventTime", "value")


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)
