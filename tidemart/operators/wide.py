"""Interval joins and the wide order and payment rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.records import with_evaluated
from tidemart.functions.times import event_time, parse_ms
from tidemart.schemas import MONEY, ORDER_WIDE_COLUMNS, PAYMENT_WIDE_COLUMNS

# A watermark one step below the maximum: rows tied with it still count as in time.
IN_ORDER = "1 millisecond"


def order_time_parts(orders: DataFrame, offset: str = "+00:00") -> DataFrame:
    """Date, time of day and epoch milliseconds of ``create_time``.

    ``create_hour`` is the whole time of day.
    """
    parts = F.split("create_time", " ")
    dated = orders.withColumns({"create_date": parts[0], "create_hour": parts[1]})
    return with_evaluated(dated, "create_ts", parse_ms("create_time", offset))


def _timed(df: DataFrame, prefix: str, ts: str, delay: str) -> DataFrame:
    timed = df.withColumn("event_time", event_time(ts))
    if df.isStreaming:
        timed = timed.withWatermark("event_time", delay)
    return timed.select(*[F.col(name).alias(prefix + name) for name in timed.columns])


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, earliest: str, latest: str,
                  delay: str = IN_ORDER) -> DataFrame:
    """Pairs with equal keys and ``right`` within ``[left+earliest, left+latest]``.

    Both ends count.  Columns come out as ``l_*`` and ``r_*``.  On streams both sides get a
    watermark, and the bounds let Spark drop join state behind it.
    """
    a, b = _timed(left, "l_", left_ts, delay), _timed(right, "r_", right_ts, delay)
    low = F.col("l_event_time") + F.expr(f"INTERVAL {earliest}")
    high = F.col("l_event_time") + F.expr(f"INTERVAL {latest}")
    return a.join(b, (F.col("l_" + left_key) == F.col("r_" + right_key))
                  & (F.col("r_event_time") >= low) & (F.col("r_event_time") <= high))


def join_order_details(orders: DataFrame, details: DataFrame, offset: str = "+00:00",
                       slack: str = "5 seconds") -> DataFrame:
    timed_orders = order_time_parts(orders, offset)
    timed_details = with_evaluated(details, "create_ts", parse_ms("create_time", offset))
    return interval_join(timed_orders, timed_details, "id", "order_id",
                         "create_ts", "create_ts", f"-{slack}", slack)


# Result column: source column in the joined pair.
_FROM_ORDER = {
    "order_id": "id", "order_status": "order_status", "create_time": "create_time",
    "create_date": "create_date", "create_hour": "create_hour",
    "activity_reduce_amount": "activity_reduce_amount",
    "coupon_reduce_amount": "coupon_reduce_amount",
    "original_total_amount": "original_total_amount", "feight_fee": "feight_fee",
    "total_amount": "total_amount", "province_id": "province_id", "user_id": "user_id"}
_FROM_DETAIL = {
    "detail_id": "id", "sku_id": "sku_id", "sku_name": "sku_name", "order_price": "order_price",
    "sku_num": "sku_num", "split_activity_amount": "split_activity_amount",
    "split_coupon_amount": "split_coupon_amount", "split_total_amount": "split_total_amount"}
# Filled by lookups, or never filled.
_LOOKED_UP = ("user_age", "user_gender")
_TYPES_OF_EMPTY = {"split_feight_fee": MONEY, "user_age": "int", "spu_id": "bigint",
                   "tm_id": "bigint", "category3_id": "bigint"}


def order_wide(pairs: DataFrame) -> DataFrame:
    """Wide order row of a joined pair; dimension columns are null but for those the order knows already."""
    known = set(pairs.columns)

    def column(name: str):
        if name in _LOOKED_UP and "l_" + name in known:
            return F.col("l_" + name).cast(_TYPES_OF_EMPTY.get(name, "string")).alias(name)
        if name in _FROM_ORDER:
            return F.col("l_" + _FROM_ORDER[name]).alias(name)
        if name in _FROM_DETAIL:
            return F.col("r_" + _FROM_DETAIL[name]).alias(name)
        return F.lit(None).cast(_TYPES_OF_EMPTY.get(name, "string")).alias(name)
    return pairs.select(*[column(name) for name in ORDER_WIDE_COLUMNS])


def join_payments(payments: DataFrame, wide: DataFrame, offset: str = "+00:00",
                  reach: str = "15 minutes", delay: str = IN_ORDER) -> DataFrame:
    """Payments with the wide orders created at most ``reach`` before them, never after."""
    timed_payments = with_evaluated(payments, "create_ts", parse_ms("create_time", offset))
    timed_wide = with_evaluated(wide, "create_ts", parse_ms("create_time", offset))
    return interval_join(timed_payments, timed_wide, "order_id", "order_id",
                         "create_ts", "create_ts", f"-{reach}", "0 seconds", delay)


_FROM_PAYMENT = {
    "payment_id": "id", "subject": "subject", "payment_type": "payment_type",
    "payment_create_time": "create_time", "callback_time": "callback_time",
    # Columns both sides have are the payment's, also when null.
    "order_id": "order_id", "user_id": "user_id", "total_amount": "total_amount"}


def payment_wide(pairs: DataFrame) -> DataFrame:
    def column(name: str):
        if name in _FROM_PAYMENT:
            return F.col("l_" + _FROM_PAYMENT[name]).alias(name)
        if name == "order_create_time":
            return F.col("r_create_time").alias(name)
        return F.col("r_" + name).alias(name)
    return pairs.select(*[column(name) for name in PAYMENT_WIDE_COLUMNS])


# Columns a merge fills from the other row, and those it leaves alone.
MERGED_COLUMNS = (
    "order_status", "create_time", "create_date", "coupon_reduce_amount",
    "activity_reduce_amount", "original_total_amount", "feight_fee", "total_amount",
    "user_id", "sku_id", "sku_name", "order_price", "sku_num")
OWN_COLUMNS = ("split_activity_amount", "split_coupon_amount", "split_total_amount")


def merge_wide(rows: DataFrame, others: DataFrame, *keys: str) -> DataFrame:
    """Rows completed by the rows of another set with the same keys (``order_id`` if none is named).

    Rows known to one side only are kept.  Where keys repeat, each row meets each.
    """
    keys = keys or ("order_id",)
    other = others.select(*[F.col(key).alias("_key_" + key) for key in keys],
                          *[F.col(name).alias("_other_" + name) for name in MERGED_COLUMNS])
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(key) == F.col("_key_" + key))
    return rows.join(other, same, "full").select(
        *[F.coalesce(key, "_key_" + key).alias(key) for key in keys],
        *[F.coalesce(name, "_other_" + name).alias(name)
          for name in MERGED_COLUMNS if name not in keys],
        *[F.col(name) for name in OWN_COLUMNS])
