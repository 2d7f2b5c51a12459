"""Edges of the operators, on hand-made rows."""

import random

import pytest
from pyspark.sql import Observation, functions as F

from tests.rows import page, pages, seqs
from tidemart.functions.records import drop_blank_entries, keep_listed, listed, words
from tidemart.functions.times import age_years, parse_ms, parse_ms_plus8, rowtime
from tidemart.operators import changelog, dims, keywords, logs, routing, rules, stats, visits, wide
from tidemart.schemas import (KEYWORD_STATS_COLUMNS, ORDER_DETAIL, ORDER_INFO, ORDER_WIDE_COLUMNS,
                              PAYMENT_INFO, PAYMENT_WIDE_COLUMNS, TABLE_PROCESS)

GAP = 10_000


# ---- logs -----------------------------------------------------------------------------

def test_dirty_branch_keeps_the_text(spark):
    good = '{"common":{"mid":"m"},"page":{"page_id":"p"},"ts":5}'
    raw = spark.createDataFrame(
        [(good, 1), ('{"common":', 2), ("no json", 3), ('{"common":{"mid":"m"}}', 4),
         ('{"common":{},"ts":1}', 5), ('{"common":{"mid":"m"},"ts":"late"}', 6), (None, 7)],
        "value STRING, seq BIGINT")
    parsed = logs.parse_logs(raw)
    assert seqs(logs.clean_logs(parsed)) == [1]
    dirty = {r.seq: (r.problem, r.raw) for r in logs.dirty_logs(parsed).collect()}
    assert dirty[2] == ("malformed", '{"common":')
    assert dirty[3][0] == dirty[6][0] == dirty[7][0] == "malformed"
    assert dirty[4][0] == dirty[5][0] == "missing_key"


def test_strict_parse_fails(spark):
    from tidemart.schemas import LOG
    raw = spark.createDataFrame([("no json",)], "value STRING")
    with pytest.raises(Exception):
        logs.parse_strict(raw, LOG).collect()


def test_only_the_first_claim_stays(spark):
    df = pages(spark, [page("a", 10, 1, is_new="0"), page("a", 20, 2, is_new="1"),
                       page("a", 30, 3, is_new="1"), page("a", 90_000_000, 4, is_new="1"),
                       page("b", 5, 5, is_new="1"), page("c", 7, 7, is_new="1"),
                       page("c", 7, 6, is_new="1")])
    flags = {r.seq: r.is_new for r in logs.repair_new_users(df).select("seq", "common.is_new").collect()}
    assert flags == {1: "0", 2: "1", 3: "0", 4: "0", 5: "1", 6: "1", 7: "0"}


def test_split(spark):
    df = pages(spark, [page("a", 1, 1, start='{"e":1}', displays=[("9", "sku_id")]),
                       page("a", 2, 2, start="", displays=[("1", "sku_id"), ("2", "promotion")]),
                       page("a", 3, 3), page("a", 4, 4, displays=[])])
    assert seqs(logs.split_starts(df)) == [1]
    assert seqs(logs.split_pages(df)) == [2, 3, 4]
    shown = logs.split_displays(df)
    assert shown.columns == ["item", "item_type", "page_id"]
    assert sorted(r.item for r in shown.collect()) == ["1", "2"]


# ---- visits ---------------------------------------------------------------------------

def test_unique_visit_per_day(spark):
    day = 86_400_000
    df = pages(spark, [page("a", 1, 1, last="home"), page("a", 2, 2), page("a", 3, 3, last=""),
                       page("a", day, 4), page("b", 5, 5), page("a", day - 1, 6)])
    assert seqs(visits.daily_unique_visits(df)) == [2, 4, 5]


@pytest.mark.parametrize("offset", [0, 3, 9_999, 12_345])
def test_bounce_bounds(spark, offset):
    """Exactly the gap later is a bounce, a millisecond less is not, wherever slices fall."""
    o = offset
    df = pages(spark, [
        page("exact", o, 1), page("exact", o + GAP, 2, last="home"),
        page("within", o, 3), page("within", o + GAP - 1, 4, last="home"),
        page("two", o, 5), page("two", o + 4_000, 6), page("two", o + 8_000, 7, last="home"),
        page("alone", o, 8), page("before", o, 10, last="home"), page("before", o, 11),
        page("tie", o, 12), page("tie", o, 13, last="home"),
        page("other", o, 14), page("someone", o + 1, 15, last="home")])
    assert seqs(visits.bounces(df, GAP)) == [1, 8, 11, 14]


def test_bounces_against_brute_force(spark):
    rng = random.Random(7)
    rows = [page(f"m{rng.randrange(3)}", rng.randrange(60_000), n,
                 last=rng.choice([None, "", "home"])) for n in range(400)]
    flat = [(r[0][0], r[4], r[5], r[1][1] in (None, "")) for r in rows]
    expected = sorted(
        seq for mid, ts, seq, entry in flat if entry and not any(
            m == mid and not e and (t, s) > (ts, seq) and t < ts + 700 for m, t, s, e in flat))
    assert seqs(visits.bounces(pages(spark, rows), 700)) == expected


def test_late_records_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), n, n * 10 + rng.randrange(200)) for n in range(300)]
    expected, high = [], {}
    for mid, arrival, ts in rows:
        if ts < high.get(mid, ts) - 50:
            expected.append(arrival)
        high[mid] = max(high.get(mid, ts), ts)
    df = spark.createDataFrame(rows, "mid STRING, arrival BIGINT, ts BIGINT")
    for block in (1, 7, 100_000):
        found = visits.late_records(df, 50, block=block)
        assert sorted(r.arrival for r in found.collect()) == expected


# ---- changes --------------------------------------------------------------------------

def test_payload_filter_and_types(spark):
    raw = spark.createDataFrame([
        ('{"table":"t","type":"insert","data":{}}', 1), ('{"table":"t","type":"insert","data":""}', 2),
        ('{"table":"t","type":"insert"}', 3), ('{"table":"t","type":"bootstrap-insert","data":{"a":1}}', 4)],
        "value STRING, seq BIGINT")
    kept = routing.normalize_type(routing.non_empty(routing.parse_changes(raw)))
    assert {(r.seq, r.type) for r in kept.collect()} == {(1, "insert"), (4, "insert")}


def config(spark, *rows):
    return spark.createDataFrame(list(rows), TABLE_PROCESS)


def test_routing(spark):
    routes = config(spark, ("t", "insert", "kafka", "facts", "id,Name, spaced", "id", None),
                    ("d", "insert", "hbase", "dims", None, None, None),
                    ("c", "insert", "clickhouse", "x", "id", None, None))
    data = {"id": "1", "name": "n", "Name": "N", "spaced": "s"}
    changes = spark.createDataFrame(
        [("s", t, k, data, n) for n, (t, k) in enumerate(
            [("t", "insert"), ("d", "insert"), ("c", "insert"), ("t", "delete")])],
        "database STRING, table STRING, type STRING, data MAP<STRING,STRING>, seq BIGINT")
    checked = routing.checked_config(routes)
    fact, = routing.fact_changes(changes, checked).collect()
    assert fact.sink_table == "facts" and fact.data == {"id": "1", "Name": "N"} and fact.pk == "1"
    dim, = routing.dim_changes(changes, checked).collect()
    assert dim.data == data and dim.pk == "1"
    reasons = {r.seq: r.reason for r in routing.unrouted_changes(changes, checked).collect()}
    assert reasons == {2: "unknown_sink", 3: "no_route"}
    with pytest.raises(ValueError):
        routing.checked_config(routes.limit(0))


def test_dim_statement(spark):
    routes = config(spark, ("b", "update", "hbase", "t", "k,v", "k", None),
                    ("a", "insert", "hbase", "t", "id,v", None, " salted"),
                    ("c", "insert", "kafka", "f", "id", None, None))
    found = {r.sink_table: r.statement for r in routing.dim_statements(routes, "s").collect()}
    assert found == {"t": "create table if not exists s.t(id varchar primary key,v varchar) salted"}


def test_envelope(spark):
    feed = spark.createDataFrame([("srv.db.tab", "UPDATE", '{"a":1,"b":"x"}'), ("srv.db.tab", "DELETE", None)],
                                 "topic STRING, op STRING, after STRING")
    rows = {r.type: (r.database, r.table, r.data) for r in changelog.envelope(feed).collect()}
    assert rows == {"update": ("db", "tab", {"a": "1", "b": "x"}), "delete": ("db", "tab", {})}


def test_latest_images_and_upserts(spark):
    rows = [("t", "1", "insert", {"id": "1", "a": "x", "b": "y"}, 1), ("t", "1", "update", {"id": "1", "a": "z"}, 2),
            ("t", "2", "insert", {"id": "2", "a": "q"}, 3), ("t", "2", "delete", {"id": "2"}, 4),
            ("t", "3", "delete", {"id": "3", "b": "old"}, 5), ("t", "3", "insert", {"id": "3"}, 6)]
    df = spark.createDataFrame(rows, "sink_table STRING, pk STRING, type STRING, data MAP<STRING,STRING>, seq BIGINT")
    latest = {r.pk: r.data for r in changelog.latest_images(df, ["sink_table", "pk"]).collect()}
    assert latest == {"1": {"id": "1", "a": "z"}, "3": {"id": "3"}}
    assert {r.pk for r in changelog.latest_images(df, ["pk"], keep_deletes=True).collect()} == {"1", "2", "3"}
    upserted = {r.pk: r.data for r in changelog.upserted_rows(df).collect()}
    assert upserted == {"1": {"id": "1", "a": "z", "b": "y"}, "3": {"id": "3"}}
    kept = {r.pk: r.data for r in changelog.upserted_rows(df, keep_deletes=True).collect()}
    assert kept["2"] == {"id": "2", "a": "q"} and kept["3"] == {"id": "3", "b": "old"}


def test_blank_entries(spark):
    df = spark.createDataFrame([({"sss": "", "sssr": "sss", "": "dd", " ": "x", "n": None, "t": "\t"},)],
                               "m MAP<STRING,STRING>")
    assert df.select(drop_blank_entries(F.col("m")).alias("m")).first().m == {"sssr": "sss"}


def test_keep_listed_without_list(spark):
    df = spark.createDataFrame([({"a": "1"}, None), ({"a": "1"}, "A")], "m MAP<STRING,STRING>, l STRING")
    found = [r.m for r in df.select(keep_listed(F.col("m"), listed(F.col("l"))).alias("m")).collect()]
    assert found == [{"a": "1"}, {}]


# ---- times ----------------------------------------------------------------------------

def test_times(spark):
    df = spark.createDataFrame([("2021-03-01 08:00:00", "1990-01-01"), ("nonsense", None)], "t STRING, b STRING")
    as_of = 631_152_000_000 + 365 * 86_400_000 * 5 - 1
    row, bad = df.select(parse_ms("t").alias("utc"), parse_ms_plus8("t").alias("east"),
                         age_years("b", as_of).alias("age")).collect()
    assert row.utc - row.east == 8 * 3_600_000 and row.utc == 1_614_585_600_000
    assert row.age == 4 and bad.utc is None and bad.age is None
    early = df.select(age_years("b", 631_152_000_000 - 1).alias("age")).first()
    assert early.age == 0
    cut = spark.range(1).select(rowtime(F.lit(1_614_585_600_999)).cast("string").alias("t")).first()
    assert cut.t == "2021-03-01 08:00:00"


# ---- wide rows ------------------------------------------------------------------------

def order(i, time):
    return (i, 1, "1001", 7, 10, 1, 2, 13, 3, None, time, None)


def detail(i, order_id, time):
    return (i, order_id, 5, 4, 2, "line", time, 6, 7, None)


def orders_and_details(spark, rows, detail_rows):
    from decimal import Decimal
    fix = lambda r, s: tuple(Decimal(v) if v is not None and f.dataType.typeName() == "decimal" else v
                             for v, f in zip(r, s.fields))
    return (spark.createDataFrame([fix(r, ORDER_INFO) for r in rows], ORDER_INFO),
            spark.createDataFrame([fix(r, ORDER_DETAIL) for r in detail_rows], ORDER_DETAIL))


def test_order_interval_bounds(spark):
    orders, details = orders_and_details(
        spark, [order(1, "2021-01-01 00:00:10")],
        [detail(n, 1, f"2021-01-01 00:00:{s:02d}") for n, s in enumerate((4, 5, 10, 15, 16))]
        + [detail(9, 2, "2021-01-01 00:00:10")])
    rows = wide.order_wide(wide.join_order_details(orders, details))
    assert rows.columns == list(ORDER_WIDE_COLUMNS)
    assert sorted(r.detail_id for r in rows.collect()) == [1, 2, 3]
    first = rows.first()
    assert (first.create_date, first.create_hour) == ("2021-01-01", "00:00:10")
    assert first.expire_time is None and first.split_feight_fee is None


def test_payment_interval_bounds(spark):
    orders, details = orders_and_details(spark, [order(1, "2021-01-01 00:20:00")],
                                         [detail(1, 1, "2021-01-01 00:20:00")])
    rows = wide.order_wide(wide.join_order_details(orders, details))
    times = ["00:19:59", "00:20:00", "00:35:00", "00:35:01"]
    payments = spark.createDataFrame(
        [(n, 1, None, None, "s", "1101", f"2021-01-01 {t}", None) for n, t in enumerate(times)], PAYMENT_INFO)
    paid = wide.payment_wide(wide.join_payments(payments, rows))
    assert paid.columns == list(PAYMENT_WIDE_COLUMNS)
    assert sorted(r.payment_id for r in paid.collect()) == [1, 2]
    # The payment's columns win, also when null.
    assert paid.first().user_id is None and paid.first().total_amount is None


def test_lookup(spark):
    facts = spark.createDataFrame([(1, "a", "own"), (2, "b", "own"), (None, "c", "own")], "id BIGINT, k STRING, name STRING")
    dim = spark.createDataFrame([("1", "a", "dim", "x"), ("2", "z", "dim", "y")], "id STRING, k STRING, name STRING, more STRING")
    found = dims.lookup(facts, dim, {"id": "id", "k": "k"}, {"name": "name", "extra": "more"})
    assert found.columns == ["id", "k", "name", "extra"]
    assert {r.k: (r.name, r.extra) for r in found.collect()} == {
        "a": ("dim", "x"), "b": ("own", None), "c": ("own", None)}
    with pytest.raises(ValueError):
        dims.lookup(facts, dim, {}, {"name": "name"})


# ---- statistics -----------------------------------------------------------------------

def test_visitor_stats_windows(spark):
    df = pages(spark, [page("a", 0, 1, during=5), page("a", 1_999, 2, last="home", during=None),
                       page("a", 2_000, 3)])
    both = [stats.visitor_stats(stats.visitor_events(df, df.limit(1), df.limit(0), compact=c)) for c in (False, True)]
    rows = [sorted(map(tuple, s.collect())) for s in both]
    assert rows[0] == rows[1] == [
        ("1970-01-01 00:00:00", "1970-01-01 00:00:02", "v1", "c1", "a1", "0", 1, 2, 1, 0, 5),
        ("1970-01-01 00:00:02", "1970-01-01 00:00:04", "v1", "c1", "a1", "0", 0, 1, 1, 0, 1)]


def test_product_stats_count_orders_once(spark):
    refunds = spark.createDataFrame(
        [(1, o, "1970-01-01 08:00:00") for o in (5, 5, 6, None)], "sku_id BIGINT, order_id BIGINT, create_time STRING"
    ).withColumn("refund_amount", F.lit("2.50").cast("decimal(18,2)"))
    row, = stats.product_stats(stats.product_refunds(refunds)).collect()
    assert (row.refund_order_ct, str(row.refund_amount), row.order_ct, row.stt) == (2, "10.00", 0, "1970-01-01 00:00:00")
    single = stats.product_stats(stats.product_refunds(refunds.limit(1)))
    assert single.first().refund_order_ct <= 1


def test_product_sums_of_parts_and_of_all_events_agree(spark):
    lines = spark.createDataFrame(
        [(1, 5, "1970-01-01 08:00:00", True, False, "2.50", None), (1, 5, "1970-01-01 08:00:01", False, True, "0.00", "1201"),
         (1, 6, "1970-01-01 08:00:02", False, False, None, "1202"), (1, None, "1970-01-01 08:00:00", False, False, "4.00", None),
         (None, 7, "1970-01-01 08:00:00", True, False, "9.00", None), (1, 8, "no time", True, False, "9.00", None)],
        "sku_id BIGINT, order_id BIGINT, create_time STRING, favor BOOLEAN, cart BOOLEAN, refund_amount STRING, appraise STRING"
    ).withColumn("refund_amount", F.col("refund_amount").cast("decimal(18,2)"))
    clicks = stats.product_clicks(pages(spark, [page("a", 1_500, 1, page_id="good_detail", item="1")]))
    whole = stats.product_stats(stats.product_line_events(lines).unionByName(clicks))
    parts = stats.product_result(stats.product_sums(clicks, stats.product_line_rows(lines)))
    assert whole.schema == parts.schema
    rows = [sorted((r.stt[-2:], r.favor_ct, r.cart_ct, r.comment_ct, r.good_comment_ct, r.click_ct, str(r.refund_amount),
                    str(r.order_amount), r.refund_order_ct, r.order_ct) for r in found.collect()) for found in (whole, parts)]
    assert rows[0] == rows[1] == [("00", 1, 1, 1, 1, 1, "6.50", "0.00", 1, 0), ("02", 0, 0, 1, 0, 0, "0.00", "0.00", 0, 0)]


def test_keywords(spark):
    df = pages(spark, [page("a", 1_500, 1, item="Big RED ring, red!", item_type="keyword"),
                       page("a", 1_500, 2, item="--", item_type="keyword"),
                       page("a", 1_500, 3, item="9", item_type="sku_id"),
                       page("a", 1_500, 4, item=None, item_type="keyword")])
    tokens = keywords.keyword_tokens(keywords.keyword_rows(df))
    counted = keywords.keyword_stats(tokens)
    assert {r.keyword: (r.ct, r.source, r.stt) for r in counted.collect()} == {
        w: (n, "SEARCH", "1970-01-01 00:00:00") for w, n in (("big", 1), ("red", 2), ("ring", 1))}
    known = spark.createDataFrame([("red",)], "word STRING")
    assert keywords.keyword_tokens(keywords.keyword_rows(df), known).count() == 2
    sink = stats.sink_row(stats.stamped(counted, 5), KEYWORD_STATS_COLUMNS)
    assert sink.columns == list(KEYWORD_STATS_COLUMNS) and sink.first().ts == 5
    assert spark.range(1).select(words(F.lit("Ünï 大数据 x1"))).first()[0] == ["ünï", "大数据", "x1"]


# ---- rules ----------------------------------------------------------------------------

def feed(spark, *lines):
    return spark.createDataFrame(list(enumerate(lines)), "seq BIGINT, value STRING")


PLAIN = "1,(active),(payeeId&beneficiaryId),(),(paymentAmount),(SUM),(>),(500),(20)"


def test_rule_lines(spark):
    parsed = rules.parse_rules(feed(
        spark, PLAIN, PLAIN + ",,", "1,(active)", PLAIN.replace("SUM", "COUNT"), PLAIN.replace("(>)", "(~)"),
        PLAIN.replace("(500)", "(many)"), '{"ruleId":2,"ruleState":"PAUSE","limit":1.5}', '{"ruleState":"ACTIVE"}',
        '{"ruleState":"CONTROL","controlType":"DELETE_RULES_ALL"}', '{"ruleId":3,"colour":"red"}', '{"ruleId":', "",
        '{"ruleId":4,"limitOperatorType":">"}', PLAIN.replace("1,(act", " 1,(act")))
    kept = {r.seq: r for r in rules.valid_rules(parsed).collect()}
    assert sorted(kept) == [0, 1, 4, 6, 8]
    assert kept[0].grouping_keys == ["payeeId", "beneficiaryId"] and kept[0].unique_keys == []
    assert kept[0].limit_operator == "GREATER" and kept[4].limit_operator is None
    assert kept[6].rule_state == "PAUSE" and str(kept[6].limit_value) == "1.5000"
    assert {r.seq for r in rules.dropped_rules(parsed).collect()} == {2, 3, 5, 7, 9, 10, 11, 12, 13}


def test_rule_lifecycle(spark):
    wipe = '{"ruleState":"CONTROL","controlType":"DELETE_RULES_ALL"}'
    other = '{"ruleState":"CONTROL","controlType":"CLEAR_STATE_ALL"}'
    line = lambda i, state: PLAIN.replace("1,(active)", f"{i},({state})", 1)

    def active(*lines):
        parsed = rules.parse_rules(feed(spark, *lines))
        return sorted(r.rule_id for r in rules.active_rules(rules.valid_rules(parsed)).collect())
    assert active(line(1, "active"), line(2, "active"), line(2, "pause"), other) == [1]
    assert active(line(1, "active"), wipe, line(3, "active")) == [3]
    assert active(line(1, "delete"), line(1, "active")) == [1]
    assert active(line(1, "active"), wipe) == []


def transactions(spark, rows):
    return spark.createDataFrame(
        rows, "transactionId BIGINT, eventTime BIGINT, payeeId BIGINT, beneficiaryId BIGINT, amount STRING"
    ).select("transactionId", "eventTime", "payeeId", "beneficiaryId",
             F.col("amount").cast("decimal(18,2)").alias("paymentAmount"))


def test_fan_out(spark):
    active = rules.valid_rules(rules.parse_rules(feed(
        spark, PLAIN, "2,(active),(),(),(paymentAmount),(MAX),(<),(1),(1)",
        "3,(active),(nowhere),(),(paymentAmount),(MAX),(<),(1),(1)")))
    events = transactions(spark, [(1, 0, 7, None, "1")])
    for per_literal in (1, 2, 500):
        gauge = Observation()
        fanned = rules.fan_out(events, active, per_literal, gauge)
        assert {r.rule_id: r.key for r in fanned.collect()} == {
            1: "{payeeId=7;beneficiaryId=null}", 2: "{}", 3: "{nowhere=null}"}
        assert gauge.get["active_rules"] == 3
    assert rules.fan_out(events, active.limit(0)).count() == 0


@pytest.mark.parametrize("aggregator", ["SUM", "AVG", "MIN", "MAX"])
def test_rule_windows_against_brute_force(spark, aggregator):
    from decimal import ROUND_HALF_UP, Decimal
    rng = random.Random(5)
    rows = [(n, rng.randrange(400_000), rng.randrange(3), 1, None if n % 17 == 0 else str(rng.randrange(100)))
            for n in range(300)]
    line = f"1,(active),(payeeId),(),(paymentAmount),({aggregator}),(>=),(40),(1)"
    active = rules.valid_rules(rules.parse_rules(feed(spark, line)))
    alerts = rules.rule_alerts(rules.fan_out(transactions(spark, rows), active))
    found = {r.transactionId: r.value for r in alerts.collect()}
    expected = {}
    for n, ts, payee, _, _ in rows:
        window = [Decimal(a) for _, t, p, _, a in rows if p == payee and ts - 60_000 <= t <= ts and a is not None]
        if window:
            value = {"SUM": sum(window), "AVG": sum(window) / len(window), "MIN": min(window), "MAX": max(window)}[aggregator]
            value = Decimal(value).quantize(Decimal("0.0001"), ROUND_HALF_UP)
            if value >= 40:
                expected[n] = value
    assert found == expected


@pytest.mark.parametrize("symbol,hits", [("=", [2]), ("!=", [1, 3]), (">", [3]), ("<", [1]), (">=", [2, 3]), ("<=", [1, 2])])
def test_limit_operators(spark, symbol, hits):
    line = f"1,(active),(payeeId),(),(paymentAmount),(MAX),({symbol}),(20),(1)"
    active = rules.valid_rules(rules.parse_rules(feed(spark, line)))
    events = transactions(spark, [(1, 0, 1, 1, "10"), (2, 0, 2, 1, "20"), (3, 0, 3, 1, "30")])
    alerts = rules.rule_alerts(rules.fan_out(events, active))
    assert sorted(r.transactionId for r in alerts.collect()) == hits


def test_transactions(spark):
    parsed = rules.parse_transactions(feed(
        spark, '{"transactionId":1,"eventTime":5,"payeeId":2,"beneficiaryId":3,"paymentAmount":1.5,"paymentType":"CSH"}',
        "2,2021-01-01 00:00:00,2,3,CRD,7.25,99", "2,2021-01-01 00:00:00,2,3,CRD,7.25", '{"transactionId":',
        '{"transactionId":3,"paymentType":"GOLD"}', "4,2021-01-01 00:00:00,2,3,GOLD,7.25,99", "x,2021-01-01 00:00:00,2,3,CRD,7,9"),
        ingested_ms=1)
    found = {r.transactionId: (r.paymentType, r.ingestionTimestamp) for r in parsed.collect()}
    assert found == {1: ("CSH", 1), 2: ("CRD", 99), 4: (None, 99)}
