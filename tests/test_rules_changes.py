"""Rules that cannot be applied or change meanwhile, change text that cannot be used, times before 1970."""

import os
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.rows import LOG_WITH_SEQ, page, pages, seqs
from tests.test_boundaries import detail, feed, order, orders_and_details, transactions
from tests.test_streams import FLUSH, alerts_of, in_files
from tidemart.operators import changelog, logs, routing, rules, visits, wide
from tidemart.schemas import TABLE_PROCESS
from tidemart.session import run_folder
from tidemart.sinks import dimensions
from tidemart.streaming.jobs import Streams, fan_out_changing, look_up_changing, route_changes

NO_WINDOW = ('{"ruleId":3,"ruleState":"ACTIVE","groupingKeyNames":["payeeId"],"unique":[],"aggregateFieldName":'
             '"paymentAmount","aggregatorFunctionType":"SUM","limitOperatorType":"GREATER_EQUAL","limit":0}')
ODD_RULES = ("1,(active),(payeeId),(),(paymentAmount),(SUM),(>=),(0),(0)",
             "2,(active),(payeeId),(),(paymentAmount),(SUM),(>=),(0),(-5)", NO_WINDOW,
             "4,(active),(payeeId),(),(paymentAmount),(SUM),(~),(0),(5)",
             "5,(active),(payeeId),(),(paymentAmount),(SUM),(>=),(0),(1)")
ROWS = [(1, 1000, 7, 1, "10"), (2, 1000, 7, 1, "20"), (3, 31_000, 7, 1, "5"), (4, 62_000, 7, 1, "1")]


def odd_rules(spark):
    return rules.active_rules(rules.valid_rules(rules.parse_rules(feed(spark, *ODD_RULES))))


def found_alerts(df):
    return sorted((r.rule_id, r.transactionId, r.value) for r in df.collect())


WANTED = [(1, 1, Decimal(30)), (1, 2, Decimal(30)), (1, 3, Decimal(5)), (1, 4, Decimal(1)),
          (5, 1, Decimal(30)), (5, 2, Decimal(30)), (5, 3, Decimal(35)), (5, 4, Decimal(6))]


def test_rules_without_a_usable_window_are_set_apart(spark):
    active = odd_rules(spark)
    assert {r.rule_id: r.reason for r in rules.unusable_rules(active).collect()} == {
        2: "negative_window", 3: "no_window", 4: "no_operator"}
    assert [tuple(r) for r in rules.rules_in_force(active).collect()] == [(2, 3)]
    alerts = rules.rule_alerts(rules.fan_out(transactions(spark, ROWS), active))
    assert found_alerts(alerts) == WANTED


def test_odd_rules_do_not_stop_a_stream(spark):
    batch = transactions(spark, ROWS)
    parts = [transactions(spark, p).collect() for p in (ROWS[:2], ROWS[2:], [(9, FLUSH, 1, 1, "1")])]
    _, stream = in_files(spark, parts, batch.schema, "odd")
    active = odd_rules(spark)
    assert found_alerts(alerts_of(spark, stream, lambda: active)) == WANTED


@pytest.mark.parametrize("run_blocks,block_rows", [(1, 1 << 30), (3, 1 << 30), (16, 1 << 30), (3, 60)])
def test_alerts_are_dealt_out_once_and_agree_with_brute_force(spark, monkeypatch, run_blocks, block_rows):
    """Also where some rules have blocks that are too long for a task, and go through their moments."""
    monkeypatch.setattr(rules, "RUN_BLOCKS", run_blocks)
    monkeypatch.setattr(rules, "BLOCK_ROWS", block_rows)
    rng = random.Random(5)
    rows = [(n, rng.randrange(-60, 60) * 10_000, rng.randrange(2), 1, str(rng.randrange(100))) for n in range(200)]
    lines = [(1, "", "SUM", 2), (2, "payeeId", "MAX", 3), (3, "payeeId", "MIN", 0), (4, "", "AVG", 7)]
    active = rules.valid_rules(rules.parse_rules(feed(spark, *[
        f"{n},(active),({keys}),(),(paymentAmount),({kind}),(>=),(0),({minutes})" for n, keys, kind, minutes in lines])))
    fanned = rules.fan_out(transactions(spark, rows), active)
    assert bool(rules.long_blocks(fanned)) == (block_rows == 60)
    alerts = rules.rule_alerts(fanned)
    if block_rows > 60:
        plan = alerts._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning\([^)]*key#", plan)) == 1
    found = alerts.collect()
    got = {(r.rule_id, r.transactionId): r.value for r in found}
    assert len(found) == len(got) == 4 * len(rows)
    of = {"SUM": sum, "MAX": max, "MIN": min, "AVG": lambda x: round(Decimal(sum(x)) / len(x), 4)}
    for n, ts, payee, _, _ in rows:
        for rule, keys, kind, minutes in lines:
            window = [Decimal(a) for _, t, p, _, a in rows if ts - minutes * 60_000 <= t <= ts and (p == payee or not keys)]
            assert abs(got[rule, n] - of[kind](window)) <= Decimal("0.0001")


def test_a_hot_key_over_many_parts(spark):
    rng = random.Random(3)
    rows = [(n, rng.randrange(-600_000, 600_000), 1, 1, str(rng.randrange(100))) for n in range(400)]
    active = rules.valid_rules(rules.parse_rules(feed(
        spark, "1,(active),(),(),(paymentAmount),(SUM),(>=),(0),(2)", "2,(active),(),(),(paymentAmount),(MAX),(>=),(0),(3)")))
    got = {(r.rule_id, r.transactionId): r.value
           for r in rules.rule_alerts(rules.fan_out(transactions(spark, rows), active), parts=7).collect()}
    for n, ts, _, _, _ in rows:
        for rule, minutes, total in ((1, 2, sum), (2, 3, max)):
            window = [Decimal(a) for _, t, _, _, a in rows if ts - minutes * 60_000 <= t <= ts]
            assert got[rule, n] == total(window)


def test_rules_change_while_the_job_runs(spark):
    lines = [["1,(active),(payeeId),(),(paymentAmount),(MAX),(>),(1),(1)"],
             ["2,(active),(),(),(paymentAmount),(MAX),(>),(1),(1)"],
             ["1,(pause),(payeeId),(),(paymentAmount),(MAX),(>),(1),(1)"],
             ['{"ruleState":"CONTROL","controlType":"DELETE_RULES_ALL"}'],
             ["3,(active),(payeeId),(),(paymentAmount),(MAX),(>),(1),(1)"]]
    known = []

    def in_force():
        known.extend(lines[len(seen)])
        seen.append(1)
        return rules.active_rules(rules.valid_rules(rules.parse_rules(feed(spark, *known))))

    seen = []
    batch = transactions(spark, [(n, n * 1000, 7, 1, "1") for n in range(5)])
    _, stream = in_files(spark, [[r] for r in batch.orderBy("transactionId").collect()], batch.schema, "changing")
    out = run_folder(spark, "changing-out")
    fan_out_changing(stream, in_force, os.path.join(out, "layer"), os.path.join(out, "checkpoint"),
                     once=True).start().awaitTermination()
    layer = spark.read.parquet(os.path.join(out, "layer"))
    got = {}
    for r in layer.collect():
        got.setdefault(r.transactionId, set()).add((r.rule_id, r.key))
    assert got == {0: {(1, "{payeeId=7}")}, 1: {(1, "{payeeId=7}"), (2, "{}")}, 2: {(2, "{}")}, 4: {(3, "{payeeId=7}")}}


CHANGES = ('{"database":"d","table":"t","type":"insert","data":{"id":"1","x":"y"}}',
           '{"database":"d","table":"t","type":"insert","data":{"id":"2"', "not json at all", None,
           '{"database":"d","table":"t","type":"insert","data":"text"}',
           '{"database":"d","table":"t","type":"insert","data":[1]}',
           '{"database":"d","table":"t","type":"insert","data":""}',
           '{"database":"d","table":"t","type":"insert"}',
           '{"database":"d","table":"t","type":"insert","data":{"x":"no key"}}',
           '{"database":"d","table":"u","type":"insert","data":{"id":"3"}}')
ROUTES = [("t", "insert", "hbase", "dim_t", "x", "id", None)]


def test_every_change_is_somewhere(spark):
    raw = feed(spark, *CHANGES)
    config = routing.checked_config(spark.createDataFrame(ROUTES, TABLE_PROCESS))
    parsed = routing.parse_changes(raw)
    dirty = {r.seq: r.problem for r in routing.dirty_changes(parsed).collect()}
    first = min(r.seq for r in raw.collect())
    assert dirty == {first + 1: "malformed", first + 2: "malformed", first + 3: "malformed",
                     first + 4: "no_object", first + 5: "no_object"}
    clean = routing.clean_changes(parsed)
    filled = routing.non_empty(clean)
    routed = routing.dim_changes(filled, config).collect()
    # The key comes from the change, though its column is not listed.
    assert [(r.pk, r.data) for r in routed] == [("1", {"x": "y"})]
    assert routing.keyless_changes(filled, config).count() == 1
    assert routing.unrouted_changes(filled, config).count() == 1
    assert len(CHANGES) == len(dirty) + (clean.count() - filled.count()) + len(routed) + 1 + 1


def test_rows_with_unlisted_keys_are_not_merged(spark):
    raw = feed(spark, *[f'{{"table":"t","type":"insert","data":{{"id":"{i}","x":"{x}"}}}}' for i, x in ((1, "a"), (2, "b"))])
    config = routing.checked_config(spark.createDataFrame(ROUTES, TABLE_PROCESS))
    routed = routing.dim_changes(routing.non_empty(routing.clean_changes(routing.parse_changes(raw))), config)
    assert {r.pk: r.data for r in changelog.upserted_rows(routed).collect()} == {"1": {"x": "a"}, "2": {"x": "b"}}


def test_the_routing_job_keeps_dirty_text(spark):
    raw = feed(spark, *CHANGES)
    _, stream = in_files(spark, [raw.collect()], raw.schema, "dirty")
    out = run_folder(spark, "dirty-out")
    route_changes(routing.parse_changes(stream), lambda: spark.createDataFrame(ROUTES, TABLE_PROCESS), out,
                  out + "-checkpoint", once=True).start().awaitTermination()
    problems = [r.problem for r in spark.read.parquet(os.path.join(out, "dirty")).collect()]
    assert sum(p in ("malformed", "no_object") for p in problems) == 5 and len(problems) == len(CHANGES) - 1


def test_a_deleted_route_is_gone(spark):
    image = '{"source_table":"%s","operate_type":"insert","sink_type":"kafka","sink_table":"x"}'
    rows = [("s.d.table_process", "CREATE", None, image % "a", 1), ("s.d.table_process", "CREATE", None, image % "b", 2),
            ("s.d.table_process", "DELETE", image % "a", None, 3)]
    routes = spark.createDataFrame(rows, "topic STRING, op STRING, before STRING, after STRING, seq BIGINT")
    assert [r.source_table for r in routing.latest_config(changelog.envelope(routes)).collect()] == ["b"]


def test_a_running_job_sees_changed_dimensions(spark):
    store, out = run_folder(spark, "dims"), run_folder(spark, "dims-out")
    entry = lambda seq, table, pk, **data: (table, pk, "insert", seq, {"id": pk, **data})
    first = [entry(1, "dim_province", "1", name="old", area_code="9"), entry(1, "dim_user", "5", gender="F", birthday="1990-01-01")]
    dimensions.append_changes(spark.createDataFrame(first, dimensions.STORED), store, 0)
    orders, details = orders_and_details(
        spark, [order(n, f"2021-01-01 00:0{n}:00") for n in (1, 2)], [detail(n, n, f"2021-01-01 00:0{n}:01") for n in (1, 2)])
    layer = wide.order_wide(wide.join_order_details(orders, details))
    rows = layer.orderBy("order_id").collect()
    topic, result = os.path.join(out, "topic"), os.path.join(out, "layer")

    def run(row):
        spark.createDataFrame([row], layer.schema).coalesce(1).write.mode("append").parquet(topic)
        stream = spark.readStream.schema(layer.schema).parquet(topic)
        look_up_changing(stream, store, 0, result, os.path.join(out, "checkpoint"), once=True).start().awaitTermination()

    run(rows[0])
    dimensions.append_changes(spark.createDataFrame(
        [entry(7, "dim_province", str(rows[1].province_id), name="new", area_code="8")], dimensions.STORED), store, 1)
    run(rows[1])
    got = {r.order_id: r.province_name for r in spark.read.parquet(result).collect()}
    assert got == {rows[0].order_id: "old", rows[1].order_id: "new"}


def test_the_store_is_compacted_by_its_job(spark):
    store, out = run_folder(spark, "compacted"), run_folder(spark, "compacted-out")
    rows = [("t", str(n % 3), "insert", n, {"id": str(n % 3), f"c{n % 2}": str(n)}) for n in range(12)]
    _, stream = in_files(spark, [rows[n:n + 2] for n in range(0, 12, 2)], dimensions.STORED, "changes")
    dimensions.dimension_sink(stream, store, out, once=True, compact_every=2).start().awaitTermination()
    got = {r.pk: r.data for r in dimensions.read_rows(spark, store).collect()}
    batch = changelog.upserted_rows(spark.createDataFrame(rows, dimensions.STORED))
    assert got == {r.pk: r.data for r in batch.collect()}
    assert sorted(os.listdir(os.path.join(store, "snapshot"))) == ["upto=3", "upto=5"]
    assert sorted(os.listdir(os.path.join(store, "changes"))) == ["batch=4", "batch=5"]


def before_1970():
    return [page("m", -9_000, 1), page("m", 9_000, 2, last="home"), page("m", 40_000, 3), page("n", -5_000, 4),
            page("n", 4_999, 5, last="home")]


def test_bounces_around_the_epoch(spark):
    """In batches; a stream's watermark starts at 1970, what is older comes late there."""
    assert seqs(visits.bounces(pages(spark, before_1970()), 10_000)) == [1, 3]


def test_restarts_and_the_count_of_late_rows(spark):
    """The log job, stopped after each file: repaired flags as in one run; the engine counts what
    came too late for a window."""
    rows = [page(f"m{n % 3}", n * 1000, n, is_new="1") for n in range(60)]
    folder, out = run_folder(spark, "log-restart"), run_folder(spark, "log-restart-out")
    schema = "value STRING, seq BIGINT"
    for part in (rows[:20], rows[20:40], rows[40:]):
        text = pages(spark, part).select(F.to_json(F.struct("common", "page", "displays", "start", "ts")).alias("value"), "seq")
        text.coalesce(1).write.mode("append").parquet(folder)
        lines = spark.readStream.schema(schema).parquet(folder)
        (Streams(None, None).repaired(lines).writeStream.option("checkpointLocation", out + "-checkpoint")
         .trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination())
    got = spark.read.schema(LOG_WITH_SEQ).parquet(out)
    wanted = logs.repair_new_users(pages(spark, rows))
    assert sorted((r.seq, r.common.is_new) for r in got.collect()) == sorted((r.seq, r.common.is_new) for r in wanted.collect())

    from tidemart.operators import stats
    parts = [[page("a", 100_000, 1)], [page("a", 200_000, 2)], [page("a", 1_000, 3)], [page("a", FLUSH, 4)]]
    _, stream = in_files(spark, parts, LOG_WITH_SEQ, "late-count")
    events = stats.visitor_events(stream, stream.filter("false"), stream.filter("false"), compact=True)
    late = run_folder(spark, "late-count-out")
    job = (stats.visitor_stats(events).writeStream.option("checkpointLocation", late + "-checkpoint")
           .trigger(availableNow=True).format("parquet").option("path", late).start())
    job.awaitTermination()
    assert sum(s["numRowsDroppedByWatermark"] for p in job.recentProgress for s in p["stateOperators"]) == 1
