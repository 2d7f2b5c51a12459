"""Streaming forms against batch forms: several micro-batches, restarts, disorder, lateness."""

import os
import random

import pyarrow as pa
from pyspark.sql import functions as F

from tests.rows import LOG_WITH_SEQ, page, pages, seqs
from tests.test_boundaries import detail, feed, order, orders_and_details, transactions
from tidemart.operators import keywords, logs, rules, stats, visits, wide
from tidemart.session import run_folder
from tidemart.sinks import dimensions
from tidemart.sinks.olap import olap_sink
from tidemart.sinks.topics import table_sink, topic_sink
from tidemart.sources.tables import read_topic, table_source
from tidemart.sources.topics import subscribe
from tidemart.streaming import state
from tidemart.streaming.jobs import drained, route_changes
from tidemart.streaming.thresholds import alert_changing

FLUSH = 10_000_000_000


def in_files(spark, parts, schema, name):
    """Every part in one file, in order of arrival."""
    folder = run_folder(spark, name)
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    return folder, subscribe(spark, folder, schema, files_per_trigger=1)


def some_pages(seed=1, n=240):
    rng = random.Random(seed)
    times = sorted(rng.randrange(120_000) for _ in range(n))
    return [page(f"m{rng.randrange(4)}", ts, seq, last=rng.choice([None, "", "home"]),
                 is_new=rng.choice("01"), item=rng.choice(["red ring", "blue bolt"]), item_type="keyword")
            for seq, ts in enumerate(times)]


def alerts_of(spark, stream, read_rules, delay_ms=0, folder=None):
    """What the alert job writes, without those of the last record far ahead."""
    folder = folder or run_folder(spark, "alerts")
    alert_changing(stream, read_rules, folder, folder + "-checkpoint", delay_ms=delay_ms, once=True).start().awaitTermination()
    return spark.read.parquet(os.path.join(folder, "alerts")).filter(F.col("eventTime") < FLUSH)


def thirds(rows):
    cut = len(rows) // 3
    return [rows[:cut], rows[cut:2 * cut], rows[2 * cut:]]


def as_set(df):
    return sorted(map(str, df.collect()))


def test_new_user_repair_over_batches(spark):
    rows = some_pages()
    _, stream = in_files(spark, thirds(rows), LOG_WITH_SEQ, "repair")
    assert as_set(drained(spark, state.repair_new_users(stream), "t")) == as_set(
        logs.repair_new_users(pages(spark, rows)))


def test_unique_visits_over_batches(spark):
    rows = [page(m, (ts + 1) * 3_600_000, n, last=random.Random(n).choice([None, "home"]))
            for n, (ts, m) in enumerate((t, m) for t in range(60) for m in "ab")]
    _, stream = in_files(spark, thirds(rows), LOG_WITH_SEQ, "visits")
    assert as_set(drained(spark, state.daily_unique_visits(stream), "t")) == as_set(
        visits.daily_unique_visits(pages(spark, rows)))


def test_bounces_over_batches_with_flush(spark):
    rows = some_pages()
    parts = thirds(rows) + [[page("flush", FLUSH, 10_000, last="home")]]
    _, stream = in_files(spark, parts, LOG_WITH_SEQ, "bounce")
    found = drained(spark, state.bounces(stream, 2_000), "t")
    assert as_set(found) == as_set(visits.bounces(pages(spark, rows), 2_000))


def test_bounces_with_disorder_inside_the_delay(spark):
    rows = some_pages(seed=4)
    mixed = sorted(rows, key=lambda r: r[4] + random.Random(r[5]).randrange(3_000))
    parts = thirds(mixed) + [[page("flush", FLUSH, 10_000, last="home")]]
    _, stream = in_files(spark, parts, LOG_WITH_SEQ, "disorder")
    found = drained(spark, state.bounces(stream, 2_000, "5 seconds"), "t")
    assert as_set(found) == as_set(visits.bounces(pages(spark, rows), 2_000))


def test_windows_do_not_depend_on_order_inside_the_delay(spark):
    rows = some_pages(seed=2)
    mixed = sorted(rows, key=lambda r: r[4] + random.Random(r[5]).randrange(8_000))
    results = []
    for arrival in (rows, mixed):
        parts = thirds(arrival) + [[page("flush", FLUSH, 10_000)]]
        _, stream = in_files(spark, parts, LOG_WITH_SEQ, "windows")
        events = stats.visitor_events(stream, stream.filter("false"), stream.filter("false"), compact=True)
        results.append(as_set(drained(spark, stats.visitor_stats(events), "t")))
    batch = pages(spark, rows)
    assert results[0] == results[1] == as_set(stats.visitor_stats(
        stats.visitor_events(batch, batch.limit(0), batch.limit(0), compact=True)))


def test_late_rows_are_dropped(spark):
    parts = [[page("a", 100_000, 1)], [page("a", 200_000, 2)], [page("a", 1_000, 3)], [page("a", FLUSH, 4)]]
    _, stream = in_files(spark, parts, LOG_WITH_SEQ, "late")
    events = stats.visitor_events(stream, stream.filter("false"), stream.filter("false"), compact=True)
    found = drained(spark, stats.visitor_stats(events), "t")
    assert sorted(r.stt for r in found.collect()) == ["1970-01-01 00:01:40", "1970-01-01 00:03:20"]


def test_keyword_stats_over_batches(spark):
    rows = some_pages()
    parts = thirds(rows) + [[page("flush", FLUSH, 10_000, item="flush", item_type="keyword")]]
    _, stream = in_files(spark, parts, LOG_WITH_SEQ, "keywords")
    count = lambda df: keywords.keyword_stats(keywords.keyword_tokens(keywords.keyword_rows(df)))
    assert as_set(drained(spark, count(stream), "t")) == as_set(count(pages(spark, rows)))


def test_restart_from_checkpoint(spark):
    """A job stopped after the first file goes on with the rest: nothing lost, nothing doubled."""
    rows = some_pages()
    parts = thirds(rows) + [[page("flush", FLUSH, 10_000, last="home")]]
    folder, out = run_folder(spark, "restart"), run_folder(spark, "restart-out")
    for part in parts:
        spark.createDataFrame(part, LOG_WITH_SEQ).coalesce(1).write.mode("append").parquet(folder)
        bounced = state.bounces(subscribe(spark, folder, LOG_WITH_SEQ), 2_000)
        table_sink(bounced, out + "-checkpoint", out, once=True).start().awaitTermination()
    assert seqs(spark.read.schema(LOG_WITH_SEQ).parquet(out)) == seqs(
        visits.bounces(pages(spark, rows), 2_000))


def test_interval_join_over_batches(spark):
    rng = random.Random(6)
    clock = lambda s: f"2021-01-01 00:{s // 60:02d}:{s % 60:02d}"
    orders, details = orders_and_details(
        spark, [order(n, clock(n * 20)) for n in range(90)],
        [detail(n, n % 90, clock(max(0, (n % 90) * 20 + rng.randrange(-7, 8)))) for n in range(270)])
    order_parts = thirds(orders.orderBy("create_time").collect())
    detail_parts = thirds(details.orderBy("create_time").collect())
    _, order_stream = in_files(spark, order_parts, orders.schema, "orders")
    _, detail_stream = in_files(spark, detail_parts, details.schema, "details")
    rows = lambda o, d: wide.order_wide(wide.join_order_details(o, d))
    assert as_set(drained(spark, rows(order_stream, detail_stream), "t")) == as_set(rows(orders, details))


def test_rule_alerts_over_batches(spark):
    rng = random.Random(8)
    times = sorted(rng.randrange(400_000) for _ in range(200))
    rows = [(n, ts, rng.randrange(3), rng.randrange(2), str(rng.randrange(100))) for n, ts in enumerate(times)]
    lines = ["1,(active),(payeeId),(),(paymentAmount),(SUM),(>),(200),(1)",
             "2,(active),(),(),(paymentAmount),(AVG),(<),(45),(2)",
             "3,(active),(beneficiaryId),(),(paymentAmount),(MIN),(>=),(5),(1)",
             "4,(active),(payeeId&beneficiaryId),(),(paymentAmount),(MAX),(=),(99),(1)"]
    active = rules.valid_rules(rules.parse_rules(feed(spark, *lines)))
    batch = transactions(spark, rows)
    parts = [transactions(spark, p).collect() for p in thirds(rows) + [[(9999, FLUSH, 1, 1, "1")]]]
    _, stream = in_files(spark, parts, batch.schema, "rules")
    found = alerts_of(spark, stream, lambda: active)
    expected = rules.rule_alerts(rules.fan_out(batch, active))
    columns = ["rule_id", "key", "transactionId", "value"]
    assert as_set(found.select(columns)) == as_set(expected.select(columns))


def test_alerts_with_disorder_late_rows_and_a_repeated_batch(spark):
    rng = random.Random(18)
    rows = [(n, 60_000 + n * 500 + rng.randrange(2_000), n % 2, 1, str(rng.randrange(100))) for n in range(120)]
    lines = ["1,(active),(),(),(paymentAmount),(SUM),(>=),(0),(1)", "2,(active),(payeeId),(),(paymentAmount),(MIN),(>=),(0),(0)"]
    active = rules.valid_rules(rules.parse_rules(feed(spark, *lines)))
    batch = transactions(spark, rows)
    late = (777, 1_000, 1, 1, "5")
    parts = [transactions(spark, p).collect() for p in (*thirds(rows), [late], [(9999, FLUSH, 1, 1, "1")])]
    folder, stream = in_files(spark, parts, batch.schema, "disorder")
    out = run_folder(spark, "alerts")
    found = alerts_of(spark, stream, lambda: active, delay_ms=2_000, folder=out)
    columns = ["rule_id", "key", "transactionId", "value"]
    wanted = as_set(rules.rule_alerts(rules.fan_out(batch, active)).select(columns))
    assert as_set(found.select(columns)) == wanted
    dropped = spark.read.parquet(os.path.join(out, "late"))
    assert {(r.transactionId, r.rule_id) for r in dropped.collect()} == {(777, 1), (777, 2)}
    # A batch that failed after its write is done again: the commit of the last one is taken back.
    commits = os.path.join(out + "-checkpoint", "commits")
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.remove(os.path.join(commits, name))
    again = alerts_of(spark, subscribe(spark, folder, batch.schema, files_per_trigger=1), lambda: active, 2_000, out)
    assert as_set(again.select(columns)) == wanted


def test_a_rule_without_names_spreads_over_tasks(spark):
    """Its moments lie in panes; a plan with one group of the key would have one task."""
    rows = [(n, n * 10, 1, 1, "1") for n in range(3_000)]
    active = rules.valid_rules(rules.parse_rules(feed(spark, "1,(active),(),(),(paymentAmount),(SUM),(>=),(0),(1)")))
    told = rules.moments(rules.fan_out(transactions(spark, rows), active))
    found = {r._ts: int(r.value) for r in rules.alerting_moments(told, parts=16).collect()}
    assert found == {n * 10: n + 1 for n in range(3_000)}
    part = F.call_function("div", F.pmod(F.col("_ts"), F.lit(60_000)) * 16, F.lit(60_000))
    assert told.select(part).distinct().count() > 4


def test_bounces_within_a_millisecond_and_without_python(spark):
    rows = [page("a", 1_000, 1), page("a", 1_000, 2, last="home"), page("b", 1_000, 4), page("b", 1_000, 3, last="home"),
            page("c", 1_000, 5), page("c", 10_999, 6, last="home"), page("d", 1_000, 7), page("d", 11_000, 8, last="home")]
    parts = [rows[:3], rows[3:6], rows[6:], [page("flush", FLUSH, 10_000, last="home")]]
    _, stream = in_files(spark, parts, LOG_WITH_SEQ, "ms")
    bounced = state.bounces(stream, 10_000, "20 seconds")
    assert "Pandas" not in bounced._jdf.queryExecution().logical().toString()
    found = drained(spark, bounced, "t")
    assert seqs(found) == seqs(visits.bounces(pages(spark, rows), 10_000)) == [4, 7]


def test_every_change_goes_somewhere(spark):
    from tidemart.operators.routing import parse_changes
    from tidemart.schemas import TABLE_PROCESS
    texts = ['{"table":"t","type":"insert","data":{"id":"1"}}', '{"table":"t","type":"insert","data":{"x":"1"}}',
             '{"table":"u","type":"insert","data":{"id":"1"}}', '{"table":"v","type":"insert","data":{"id":"1"}}',
             '{"table":"w","type":"insert","data":{"id":"1"}}', '{"table":"t","type":"insert"}', "no json", '{"table":"t","type":"insert","data":"x"}']
    schema = "value STRING, seq BIGINT"
    rows = list(enumerate(texts * 2))
    _, stream = in_files(spark, [[(t, n) for n, t in rows[:5]], [(t, n) for n, t in rows[5:]]], spark.createDataFrame([], schema).schema, "all")
    config = spark.createDataFrame([("t", "insert", "kafka", "out", "id", "id", None), ("u", "insert", "hbase", "dim", "id", "id", None),
                                    ("w", "insert", "elsewhere", "x", "id", "id", None)], TABLE_PROCESS)
    out = run_folder(spark, "all-routes")
    route_changes(parse_changes(stream), lambda: config, out, out + "-checkpoint", once=True).start().awaitTermination()
    apart = spark.read.parquet(os.path.join(out, "dirty")).collect()
    kept = spark.read.parquet(os.path.join(out, "facts")).count() + spark.read.parquet(os.path.join(out, "dims", "changes")).count()
    assert kept + len(apart) == len(rows) and kept == 4
    assert {r.problem: r.raw for r in apart}.keys() == {"missing_key", "no_route", "unknown_sink", "empty", "malformed", "no_object"}


def test_routing_parses_a_change_once(spark):
    from tidemart.operators.routing import parse_changes
    from tidemart.schemas import TABLE_PROCESS
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(text):
        seen.add(1)
        return text
    rows = [('{"table":"t","type":"insert","data":{"id":"%d"}}' % n, n) for n in range(20)] + [("no json", 20)]
    _, stream = in_files(spark, [rows[:10], rows[10:]], spark.createDataFrame([], "value STRING, seq BIGINT").schema, "once")
    config = spark.createDataFrame([("t", "insert", "kafka", "out", "id", "id", None)], TABLE_PROCESS)
    out = run_folder(spark, "parsed-once")
    route_changes(parse_changes(stream.withColumn("value", noted("value"))), lambda: config, out, out + "-checkpoint",
                  once=True).start().awaitTermination()
    assert spark.read.parquet(os.path.join(out, "facts")).count() == 20 and seen.value == len(rows)


def test_dimension_store(spark):
    folder = run_folder(spark, "store")
    schema = dimensions.STORED
    first = [("t", "1", "insert", 1, {"id": "1", "a": "x", "b": "y"}), ("t", "2", "insert", 2, {"id": "2"})]
    second = [("t", "1", "update", 3, {"id": "1", "a": "z"}), ("u", "9", "insert", 4, {"id": "9"})]
    third = [("t", "2", "delete", 5, {"id": "2"})]
    batches = [spark.createDataFrame(rows, schema) for rows in (first, second, third)]
    for n, batch in enumerate(batches[:2]):
        dimensions.append_changes(batch, folder, n)
    dimensions.append_changes(batches[1], folder, 1)      # a repeated attempt
    before = {r.pk: r.data for r in dimensions.read_rows(spark, folder).collect()}
    assert before == {"1": {"id": "1", "a": "z", "b": "y"}, "2": {"id": "2"}, "9": {"id": "9"}}
    assert dimensions.compact(spark, folder) == 1
    assert {r.pk: r.data for r in dimensions.read_rows(spark, folder).collect()} == before
    dimensions.append_changes(batches[2], folder, 2)
    table = dimensions.read_dimension(spark, folder, "t", ["id", "a", "b"])
    assert [tuple(r) for r in table.collect()] == [("1", "z", "y")]
    assert dimensions.compact(spark, folder) == 2
    assert {r.pk for r in dimensions.read_rows(spark, folder).collect()} == {"1", "9"}


def test_routing_job_reads_config_per_batch(spark):
    from tidemart.operators.routing import parse_changes
    from tidemart.schemas import TABLE_PROCESS
    text = lambda n: f'{{"table":"t","type":"insert","data":{{"id":"{n}","x":"y"}}}}'
    schema = spark.createDataFrame([("", 1)], "value STRING, seq BIGINT").schema
    _, stream = in_files(spark, [[(text(1), 1)], [(text(2), 2)]], schema, "cdc")
    seen = []

    def config():
        seen.append(1)
        sink = "kafka" if len(seen) == 1 else "hbase"
        return spark.createDataFrame([("t", "insert", sink, "out", "id", "id", None)], TABLE_PROCESS)
    out = run_folder(spark, "routing")
    route_changes(parse_changes(stream), config, out, out + "-checkpoint", once=True).start().awaitTermination()
    facts = spark.read.parquet(os.path.join(out, "facts"))
    assert [(r.topic, r.value) for r in facts.collect()] == [("out", '{"id":"1"}')]
    assert [r.pk for r in dimensions.read_rows(spark, os.path.join(out, "dims")).collect()] == ["2"]


def test_topics_and_olap_sink(spark):
    folder = run_folder(spark, "topics")
    text = spark.createDataFrame([("a", '{"ts":1500}'), ("b", '{"ts":2}')], "topic STRING, value STRING")
    source = os.path.join(folder, "in")
    text.write.parquet(source)
    stream = subscribe(spark, source, text.schema)
    out = os.path.join(folder, "out")
    topic_sink(stream, out + "-checkpoint", folder=out, once=True).start().awaitTermination()
    assert sorted((r.topic, r.value) for r in spark.read.parquet(out).collect()) == [
        ("a", '{"ts":1500}'), ("b", '{"ts":2}')]

    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("ts", T.LongType())])
    lines = read_topic(spark, os.path.join(out, "topic=a"), format="parquet")
    table = table_source(lines, schema, "2 seconds", view="typed")
    assert spark.table("typed").isStreaming
    rows = table.select("ts", F.lit("x").alias("helper"))
    sink = os.path.join(folder, "olap")
    olap_sink(rows, ["ts"], sink + "-checkpoint", folder=sink, stats_ms=7, once=True).start().awaitTermination()
    stored = spark.read.parquet(sink)
    assert stored.columns == ["ts", "batch"] and [r.ts for r in stored.collect()] == [7]


def test_unique_visits_pick_the_first_of_a_micro_batch_without_python_state(spark):
    """Several pages of a device and day in one micro-batch, out of order; a page late by less than its day."""
    hour, day = 3_600_000, 86_400_000
    parts = [[page("a", 5 * hour, 3), page("a", 2 * hour, 2), page("a", 2 * hour, 1), page("b", 23 * hour, 4)],
             [page("b", 22 * hour, 5), page("a", day + 9 * hour, 6), page("c", 3 * hour, 7), page("c", 20 * hour, 8)],
             [page("c", 4 * hour, 9), page("a", day + 8 * hour, 10)]]
    _, stream = in_files(spark, parts, LOG_WITH_SEQ, "visits-disorder")
    uniques = state.daily_unique_visits(stream)
    assert "WithState" not in uniques._jdf.queryExecution().logical().toString()
    assert seqs(drained(spark, uniques, "t")) == [1, 4, 6, 7]


def test_first_rows_at_hand_are_cut_again_as_they_grow(monkeypatch):
    rng = random.Random(3)
    rows = [{"k": rng.randrange(50), "t": rng.randrange(1_000), "s": n, "m": rng.randrange(9)} for n in range(2_000)]
    monkeypatch.setattr(state, "_AT_ONCE", 64)
    batches = [pa.RecordBatch.from_pylist(rows[n:n + 30]) for n in range(0, len(rows), 30)]
    found = pa.Table.from_batches(state._first_at_hand(["k"], ["t", "s"], "m")(batches)).to_pylist()
    of = lambda k: [r for r in rows if r["k"] == k]
    assert sorted(found, key=lambda r: r["k"]) == [
        min(of(k), key=lambda r: (r["t"], r["s"])) | {"m": max(r["m"] for r in of(k))} for k in range(50)]


def test_repair_within_a_micro_batch_without_python_state(spark, monkeypatch):
    """Claims out of order in a micro-batch; a device that claimed before; one that only ever claims an old user."""
    parts = [[page("a", 30, 3, is_new="1"), page("a", 10, 2, is_new="1"), page("a", 10, 1, is_new="1"), page("b", 5, 4)],
             [page("a", 40, 5, is_new="1"), page("a", 50, 6, is_new="1"), page("b", 50, 8, is_new="1"), page("b", 45, 7, is_new="1")],
             [page("b", 1, 9, is_new="1"), page("c", 60, 10, is_new="1"), page("c", 61, 11)]]
    _, stream = in_files(spark, parts, LOG_WITH_SEQ, "repair-disorder")
    repaired = state.repair_new_users(stream)
    assert "WithState" not in repaired._jdf.queryExecution().logical().toString()
    found = drained(spark, repaired, "t").collect()
    assert sorted(r.seq for r in found) == list(range(1, 12))
    assert sorted(r.seq for r in found if r.common.is_new == "1") == [1, 7, 10]
    assert all(r.common.vc == "v1" and r.page.page_id == "home" for r in found)


def test_claims_pass_while_others_are_held(monkeypatch):
    rng = random.Random(5)
    rows = [{"mid": f"m{rng.randrange(40)}", "mark": False, "ts": rng.randrange(500), "seq": n} for n in range(1_500)]
    marks = [{"mid": f"m{n}", "mark": True, "ts": None, "seq": None} for n in range(0, 40, 2)]
    mixed = rows + marks
    rng.shuffle(mixed)
    monkeypatch.setattr(state, "_AT_ONCE", 50)
    schema = pa.schema([("mid", pa.string()), ("mark", pa.bool_()), ("ts", pa.int64()), ("seq", pa.int64())])
    batches = [pa.RecordBatch.from_pylist(mixed[n:n + 20], schema) for n in range(0, len(mixed), 20)]
    found = pa.Table.from_batches(state._flagged(iter(batches))).to_pylist()
    wanted = {min((r["ts"], r["seq"]) for r in rows if r["mid"] == m["mid"])[1] for m in marks}
    assert sorted(r["seq"] for r in found) == list(range(1_500))
    assert {r["seq"] for r in found if r["is_new"] == "1"} == wanted
