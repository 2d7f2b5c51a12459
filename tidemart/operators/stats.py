"""Windowed visitor, product and province statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.codes import GOOD_APPRAISE
from tidemart.functions.records import is_entry_page, with_evaluated
from tidemart.functions.times import event_time, parse_ms, parse_ms_plus8, second_text, tumbling

VISITOR_KEYS = ("vc", "ch", "ar", "is_new")
VISITOR_MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")


def _now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def stamped(stats: DataFrame, stats_ms: int | None = None) -> DataFrame:
    """Statistics with the moment they were made, now unless given."""
    return stats.withColumn("ts", _now_ms() if stats_ms is None
                            else F.lit(stats_ms).cast("bigint"))


def _timed(events: DataFrame, delay: str) -> DataFrame:
    # The time may be parsed text, and a window looks at it several times.
    timed = with_evaluated(events, "event_time", event_time("ts"))
    return timed.withWatermark("event_time", delay) if events.isStreaming else timed


def _bounds() -> list[Column]:
    return [second_text(F.col("window.start")).alias("stt"),
            second_text(F.col("window.end")).alias("edt")]


# ---- visitors -------------------------------------------------------------------------

def _visitor_row(df: DataFrame, **measures: Column) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return df.select(*[F.col(f"common.{name}").alias(name) for name in VISITOR_KEYS],
                     *[measures.get(name, zero).cast("bigint").alias(name)
                       for name in VISITOR_MEASURES], "ts")


def visitor_events(pages: DataFrame, uniques: DataFrame, bounced: DataFrame,
                   compact: bool = False) -> DataFrame:
    """Page views, sessions, unique visits and bounces in one shape.

    ``compact`` puts the view and the session start of a page into one row: the sums are
    the same and the pages are read once.
    """
    one, duration = F.lit(1), F.coalesce("page.during_time", F.lit(0))
    if compact:
        views = _visitor_row(pages, pv_ct=one, dur_sum=duration,
                             sv_ct=is_entry_page().cast("bigint"))
    else:
        views = _visitor_row(pages, pv_ct=one, dur_sum=duration).unionByName(
            _visitor_row(pages.filter(is_entry_page()), sv_ct=one))
    return (views.unionByName(_visitor_row(uniques, uv_ct=one))
                 .unionByName(_visitor_row(bounced, uj_ct=one)))


def visitor_rows(flagged: DataFrame, compact: bool = False) -> DataFrame:
    """The rows of `visitor_events` from pages that know what they are (`flagged_pages`)."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    duration = F.coalesce("page.during_time", F.lit(0)).cast("bigint")
    entry = is_entry_page()
    if compact:
        return _visitor_row(flagged, pv_ct=one, dur_sum=duration, sv_ct=entry.cast("bigint"),
                            uv_ct=F.col("unique_visit").cast("bigint"), uj_ct=F.col("bounced").cast("bigint"))

    def row(when: Column | None = None, **measures: Column) -> Column:
        record = F.struct(*[measures.get(name, zero).alias(name) for name in VISITOR_MEASURES])
        return record if when is None else F.when(when, record)

    parts = F.array_compact(F.array(
        row(pv_ct=one, dur_sum=duration), row(entry, sv_ct=one), row(F.col("unique_visit"), uv_ct=one),
        row(F.col("bounced"), uj_ct=one)))
    return flagged.select(*[F.col(f"common.{name}").alias(name) for name in VISITOR_KEYS],
                          "ts", F.inline(parts)).select(*VISITOR_KEYS, *VISITOR_MEASURES, "ts")


def visitor_stats(events: DataFrame, size: str = "2 seconds",
                  delay: str = "10 seconds") -> DataFrame:
    grouped = _timed(events, delay).groupBy(tumbling("event_time", size), *VISITOR_KEYS)
    sums = grouped.agg(*[F.sum(name).alias(name) for name in VISITOR_MEASURES])
    return sums.select(*_bounds(), *VISITOR_KEYS, *VISITOR_MEASURES)


def visitor_running_totals(events: DataFrame) -> DataFrame:
    """Totals per key since the start; on a stream, to be written in update mode."""
    return events.groupBy(*VISITOR_KEYS).agg(
        *[F.sum(name).alias(name) for name in VISITOR_MEASURES])


# ---- products -------------------------------------------------------------------------

# Result measure: its type.  The three id columns feed the distinct order counts.
PRODUCT_COUNTS = ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
                  "comment_ct", "good_comment_ct")
PRODUCT_AMOUNTS = ("order_amount", "order_split_amount", "payment_amount", "refund_amount")
PRODUCT_ORDERS = {"order_ct": "order", "paid_order_ct": "paid", "refund_order_ct": "refund"}


def _product_columns(sku: Column, ts: Column, **measures: Column) -> list[Column]:
    def measure(name: str, kind_of: str) -> Column:
        value = F.coalesce(measures[name], F.lit(0)) if name in measures else F.lit(0)
        return value.cast(kind_of).alias(name)
    return [
        sku.cast("bigint").alias("sku_id"), ts.cast("bigint").alias("ts"),
        *[measure(name, "bigint") for name in PRODUCT_COUNTS],
        *[measure(name, "decimal(18,2)") for name in PRODUCT_AMOUNTS]]


def _of_order(kind: str | None = None, order_id: Column | None = None) -> list[Column]:
    # The kind stands beside a generator, never inside one, so that Spark sees which rows have which.
    return [F.lit(kind).cast("string").alias("order_kind"),
            (F.lit(None) if order_id is None else order_id).cast("bigint").alias("order_id")]


def _product_row(df: DataFrame, sku: Column, ts: Column, kind: str | None = None,
                 order_id: Column | None = None, **measures: Column) -> DataFrame:
    return df.select(*_product_columns(sku, ts, **measures), *_of_order(kind, order_id))


def product_clicks(pages: DataFrame) -> DataFrame:
    shown = pages.filter(F.col("page.page_id") == "good_detail")
    return _product_row(shown, F.col("page.item"), F.col("ts"), click_ct=F.lit(1))


def product_displays(pages: DataFrame) -> DataFrame:
    shown = pages.select("ts", F.explode("displays").alias("_display"))
    skus = shown.filter(F.col("_display.item_type") == "sku_id")
    return _product_row(skus, F.col("_display.item"), F.col("ts"), display_ct=F.lit(1))


def product_favors(favors: DataFrame) -> DataFrame:
    return _product_row(favors, F.col("sku_id"), parse_ms_plus8("create_time"), favor_ct=F.lit(1))


def product_carts(carts: DataFrame) -> DataFrame:
    return _product_row(carts, F.col("sku_id"), parse_ms_plus8("create_time"), cart_ct=F.lit(1))


def product_orders(wide: DataFrame) -> DataFrame:
    """The amount counts the whole order once per detail row; the split amount does not."""
    return _product_row(
        wide, F.col("sku_id"), parse_ms_plus8("create_time"), "order", F.col("order_id"),
        order_amount=F.col("total_amount"), order_split_amount=F.col("split_total_amount"),
        order_sku_num=F.col("sku_num"))


def product_payments(wide: DataFrame) -> DataFrame:
    return _product_row(
        wide, F.col("sku_id"), parse_ms_plus8("payment_create_time"), "paid", F.col("order_id"),
        payment_amount=F.col("split_total_amount"))


def product_refunds(refunds: DataFrame) -> DataFrame:
    return _product_row(
        refunds, F.col("sku_id"), parse_ms_plus8("create_time"), "refund", F.col("order_id"),
        refund_amount=F.col("refund_amount"))


def product_comments(comments: DataFrame) -> DataFrame:
    good = F.coalesce((F.col("appraise") == GOOD_APPRAISE).cast("bigint"), F.lit(0))
    return _product_row(comments, F.col("sku_id"), parse_ms_plus8("create_time"),
                        comment_ct=F.lit(1), good_comment_ct=good)


def product_events(pages: DataFrame, favors: DataFrame, carts: DataFrame, orders: DataFrame,
                   payments: DataFrame, refunds: DataFrame, comments: DataFrame) -> DataFrame:
    parts = [product_clicks(pages), product_displays(pages), product_favors(favors),
             product_carts(carts), product_orders(orders), product_payments(payments),
             product_refunds(refunds), product_comments(comments)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def product_page_events(pages: DataFrame) -> DataFrame:
    """Clicks and displays of the pages, which are read once."""
    one = F.lit(1)
    click = F.struct(*_product_columns(F.col("page.item"), F.col("ts"), click_ct=one))
    clicks = F.array_compact(F.array(F.when(F.col("page.page_id") == "good_detail", click)))
    shown = F.transform(
        F.filter("displays", lambda d: d["item_type"] == "sku_id"),
        lambda d: F.struct(*_product_columns(d["item"], F.col("ts"), display_ct=one)))
    return pages.select(F.inline(F.concat(clicks, F.coalesce(shown, F.slice(clicks, 1, 0))))).select("*", *_of_order())


def product_line_rows(lines: DataFrame) -> DataFrame:
    """Favors, carts, refunds and comments of rows that may be several of them at once, all with the
    order of their line.

    A row tells by ``favor``, ``cart``, ``refund_amount`` and ``appraise`` what it is; their
    common input is read, joined and its time parsed once.  The order stands beside the generator, so
    that rows which come out of a join on it need not move to be reduced per order.
    """
    sku, ts, one = F.col("sku_id"), F.col("_ts"), F.lit(1)
    good = F.coalesce((F.col("appraise") == GOOD_APPRAISE).cast("bigint"), F.lit(0))

    def row(when: Column, kind: str | None = None, **measures: Column) -> Column:
        return F.when(when, F.struct(*_product_columns(sku, ts, **measures),
                                     F.lit(kind).cast("string").alias("order_kind")))

    kinds = [
        row(F.col("favor"), favor_ct=one), row(F.col("cart"), cart_ct=one),
        row(F.col("refund_amount").isNotNull(), "refund", refund_amount=F.col("refund_amount")),
        row(F.col("appraise").isNotNull(), comment_ct=one, good_comment_ct=good)]
    timed = with_evaluated(lines, "_ts", parse_ms_plus8("create_time"))
    return timed.select(F.inline(F.array_compact(F.array(*kinds))), F.col("order_id").cast("bigint").alias("order_id"))


def product_line_events(lines: DataFrame) -> DataFrame:
    """The rows above as events: only those that count an order name it."""
    return product_line_rows(lines).withColumn(
        "order_id", F.when(F.col("order_kind").isNotNull(), F.col("order_id")))


def product_sums(plain: DataFrame, *of_orders: DataFrame, size: str = "2 seconds") -> DataFrame:
    """Sums and exact distinct order counts per product and window, which is known by its ``_start``.

    ``plain`` are events that count no order.  Those of orders are first reduced per order; all events
    of a kind of order are in one part.  That makes every order count once without keeping sets of ids,
    spreads the rows of a hot product over its orders, and moves no row where a part comes out of
    a join on the order.  The others are reduced per product at once.
    """
    counts = [F.sum(name).alias(name) for name in PRODUCT_COUNTS]

    def money(least: Column | None = None) -> list[Column]:
        sums = {name: F.sum(name).cast("decimal(28,2)") for name in PRODUCT_AMOUNTS}
        return [(value if least is None else F.coalesce(value, least)).alias(name) for name, value in sums.items()]

    def timed(events: DataFrame) -> DataFrame:
        # The time may be parsed text, and a window looks at it several times.
        told = with_evaluated(events.filter(F.col("sku_id").isNotNull()), "event_time", event_time("ts"))
        # Most rows have one amount of four: decimals that are left out need not be added up.
        return told.select(tumbling("event_time", size)["start"].alias("_start"), "sku_id", "order_kind", "order_id",
                           *PRODUCT_COUNTS, *[F.when(F.col(name) != 0, F.col(name)).alias(name) for name in PRODUCT_AMOUNTS])

    def reduced(events: DataFrame, counted: bool = True) -> DataFrame:
        def orders(kind: str) -> Column:
            told = (F.col("order_kind") == kind) & F.col("order_id").isNotNull()
            return F.coalesce(told, F.lit(False)).cast("bigint") if counted else F.lit(0).cast("bigint")

        rows = timed(events)
        if counted:
            rows = rows.groupBy("_start", "sku_id", "order_kind", "order_id").agg(*counts, *money())
        return rows.select("_start", "sku_id", *PRODUCT_COUNTS, *PRODUCT_AMOUNTS,
                           *[orders(kind).alias(name) for name, kind in PRODUCT_ORDERS.items()])

    union = reduce(DataFrame.unionByName, [reduced(plain, False), *map(reduced, of_orders)])
    return union.groupBy("_start", "sku_id").agg(
        *counts, *money(F.lit(0).cast("decimal(28,2)")), *[F.sum(name).alias(name) for name in PRODUCT_ORDERS])


def product_result(sums: DataFrame, size: str = "2 seconds") -> DataFrame:
    """The sums with the bounds of their windows as text: what goes on carries a number instead."""
    told = sums.withColumn("window", tumbling("_start", size))
    return told.select(*_bounds(), *[name for name in sums.columns if name != "_start"])


def product_stats(events: DataFrame, size: str = "2 seconds",
                  delay: str = "10 seconds") -> DataFrame:
    """Sums and exact distinct order counts per product and window, of a stream by two aggregates
    that share its watermark."""
    if not events.isStreaming:
        counted = F.coalesce(F.col("order_kind").isin(*PRODUCT_ORDERS.values()), F.lit(False))
        return product_result(product_sums(events.filter(~counted), events.filter(counted), size=size), size)
    sums = [F.sum(name).alias(name) for name in PRODUCT_COUNTS]
    money = [F.sum(name).cast("decimal(28,2)").alias(name) for name in PRODUCT_AMOUNTS]
    per_order = (_timed(events.filter(F.col("sku_id").isNotNull()), delay)
                 .groupBy(tumbling("event_time", size), "sku_id", "order_kind", "order_id")
                 .agg(*sums, *money))
    orders = [F.count_if((F.col("order_kind") == kind) & F.col("order_id").isNotNull()).alias(name)
              for name, kind in PRODUCT_ORDERS.items()]
    per_sku = per_order.groupBy("window", "sku_id").agg(*sums, *money, *orders)
    return per_sku.select(*_bounds(), "sku_id", *PRODUCT_COUNTS, *PRODUCT_AMOUNTS, *PRODUCT_ORDERS)


# ---- provinces ------------------------------------------------------------------------

# What the statistics read of a wide order row.
PROVINCE_INPUTS = ("province_id", "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
                   "order_id", "split_total_amount", "create_time")


def province_stats(wide: DataFrame, size: str = "2 seconds", delay: str = "1 millisecond",
                   offset: str = "+00:00") -> DataFrame:
    """Order amount and detail rows per province and window, in SQL.

    ``order_count`` counts detail rows; ``distinct_order_count`` counts orders, which is
    why rows are first reduced per order.
    """
    timed = _timed(wide.withColumn("ts", parse_ms("create_time", offset)), delay)
    per_order = wide.sparkSession.sql("""
        SELECT window(event_time, {size}) AS window, province_id, province_name,
               province_area_code, province_iso_code, province_3166_2_code, order_id,
               sum(split_total_amount) AS amount, count(*) AS details
        FROM {wide}
        GROUP BY window(event_time, {size}), province_id, province_name, province_area_code,
                 province_iso_code, province_3166_2_code, order_id
        """, wide=timed, size=size)
    return wide.sparkSession.sql("""
        SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
               province_id, province_name, province_area_code, province_iso_code,
               province_3166_2_code, order_amount, order_count, distinct_order_count
        FROM (SELECT window, province_id, province_name, province_area_code,
                     province_iso_code, province_3166_2_code,
                     CAST(sum(amount) AS DECIMAL(28, 2)) AS order_amount,
                     sum(details) AS order_count, count(order_id) AS distinct_order_count
              FROM {orders}
              GROUP BY window, province_id, province_name, province_area_code,
                       province_iso_code, province_3166_2_code)
        """, orders=per_order)


def sink_row(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly the columns of a positional sink, in its order; helper columns stay behind."""
    return stats.select(*[F.col(f"`{name}`") for name in columns])
