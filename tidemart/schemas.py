"""Declared schemas of every record type; nothing is inferred on a stream."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
MONEY = T.DecimalType(18, 2)
LIMIT = T.DecimalType(28, 4)


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# User-activity log.  `start` stays raw text: only its emptiness matters.
LOG = record(
    common=record(mid=STRING, vc=STRING, ch=STRING, ar=STRING, is_new=STRING),
    page=record(page_id=STRING, last_page_id=STRING, during_time=LONG, item=STRING,
                item_type=STRING),
    displays=T.ArrayType(record(item=STRING, item_type=STRING)),
    start=STRING, ts=LONG)

# Database change as it arrives; `data` stays raw text until it is known to be non-empty.
CHANGE = record(database=STRING, table=STRING, type=STRING, data=STRING)
CHANGE_DATA = T.MapType(STRING, STRING)

ORDER_INFO = record(
    id=LONG, province_id=LONG, order_status=STRING, user_id=LONG, total_amount=MONEY,
    activity_reduce_amount=MONEY, coupon_reduce_amount=MONEY, original_total_amount=MONEY,
    feight_fee=MONEY, expire_time=STRING, create_time=STRING, operate_time=STRING)

ORDER_DETAIL = record(
    id=LONG, order_id=LONG, sku_id=LONG, order_price=MONEY, sku_num=LONG, sku_name=STRING,
    create_time=STRING, split_total_amount=MONEY, split_activity_amount=MONEY,
    split_coupon_amount=MONEY)

PAYMENT_INFO = record(
    id=LONG, order_id=LONG, user_id=LONG, total_amount=MONEY, subject=STRING,
    payment_type=STRING, create_time=STRING, callback_time=STRING)

TABLE_PROCESS = record(
    source_table=STRING, operate_type=STRING, sink_type=STRING, sink_table=STRING,
    sink_columns=STRING, sink_pk=STRING, sink_extend=STRING)

RULE_JSON = record(
    ruleId=INT, ruleState=STRING, groupingKeyNames=T.ArrayType(STRING),
    unique=T.ArrayType(STRING), aggregateFieldName=STRING, aggregatorFunctionType=STRING,
    limitOperatorType=STRING, limit=LIMIT, windowMinutes=INT, controlType=STRING)

# A rule as the later steps use it.
RULE = record(
    rule_id=INT, rule_state=STRING, grouping_keys=T.ArrayType(STRING),
    unique_keys=T.ArrayType(STRING), aggregate_field=STRING, aggregator=STRING,
    limit_operator=STRING, limit_value=LIMIT, window_minutes=INT, control_type=STRING)

TRANSACTION_JSON = record(
    transactionId=LONG, eventTime=LONG, payeeId=LONG, beneficiaryId=LONG, paymentAmount=MONEY,
    paymentType=STRING, ingestionTimestamp=LONG)

# Column order of the wide tables and of the positional OLAP sinks.
ORDER_WIDE_COLUMNS = (
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
    "province_id", "order_status", "user_id",
    "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "split_feight_fee",
    "split_activity_amount", "split_coupon_amount", "split_total_amount",
    "expire_time", "create_time", "operate_time", "create_date", "create_hour",
    "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
    "user_age", "user_gender",
    "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")

PAYMENT_WIDE_COLUMNS = (
    "payment_id", "subject", "payment_type", "payment_create_time", "callback_time",
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
    "province_id", "order_status", "user_id",
    "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "split_feight_fee",
    "split_activity_amount", "split_coupon_amount", "split_total_amount",
    "order_create_time",
    "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
    "user_age", "user_gender",
    "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")

VISITOR_STATS_COLUMNS = (
    "stt", "edt", "vc", "ch", "ar", "is_new",
    "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts")

PRODUCT_STATS_COLUMNS = (
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name",
    "tm_id", "tm_name", "category3_id", "category3_name",
    "display_ct", "click_ct", "favor_ct", "cart_ct",
    "order_sku_num", "order_amount", "order_ct",
    "payment_amount", "paid_order_ct", "refund_order_ct", "refund_amount",
    "comment_ct", "good_comment_ct", "ts")

PROVINCE_STATS_COLUMNS = (
    "stt", "edt", "province_id", "province_name", "province_area_code",
    "province_iso_code", "province_3166_2_code", "order_amount", "order_count", "ts")

KEYWORD_STATS_COLUMNS = ("keyword", "ct", "source", "stt", "edt", "ts")
