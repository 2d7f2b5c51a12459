"""As-of joins, snapshots joined up with changes, and the bucketed dimension store."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tidemart.operators import asof, changelog, routing, rules
from tidemart.session import run_folder
from tidemart.sinks import dimensions
from tests.test_boundaries import feed, transactions
from tests.test_plans import plan_of

EVENTS = "id BIGINT, key STRING, other BIGINT, place BIGINT"
VERSIONS = "key STRING, other BIGINT, seq BIGINT, value STRING"


def by_hand(events, versions):
    """Each event with the value of its key's last version not after its place."""
    found = []
    for id_, key, other, place in events:
        before = [(seq, value) for k, o, seq, value in versions
                  if None not in (key, other, place, seq) and (k, o) == (key, other) and seq <= place]
        found.append((id_, max(before)[1] if before else None))
    return sorted(found)


def joined(spark, events, versions, **options):
    found = asof.as_of_join(spark.createDataFrame(events, EVENTS), spark.createDataFrame(versions, VERSIONS),
                            ["key", "other"], "place", **options)
    assert found.columns == ["id", "key", "other", "place", "version"]
    return sorted((r.id, r.version.value if r.version else None) for r in found.collect())


def mixed():
    events = [(n, "hot" if n % 3 else f"k{n % 7}", n % 2, n * 37 % 211 - 20) for n in range(400)]
    events += [(1000 + n, "hot", 0, 50) for n in range(60)]                       # many at one place
    events += [(2000, None, 0, 5), (2001, "hot", None, 5), (2002, "hot", 0, None), (2003, "unknown", 0, 9)]
    events += [events[0]]                                                         # a repeated row
    versions = [("hot", n % 2, n * 5 - 15, f"h{n}") for n in range(50)]
    versions += [(f"k{n % 7}", n % 2, n * 13 % 180, f"v{n}") for n in range(40)]
    versions += [(None, 0, 1, "nobody"), ("hot", 0, None, "never"), ("k1", 1, 60, None)]
    unique = {(k, o, s): v for k, o, s, v in versions}
    return events, [(*key, value) for key, value in unique.items()]


@pytest.mark.parametrize("options", [{}, {"width": 1}, {"width": 16}, {"width": 1000}, {"most": 20}])
def test_events_find_the_version_in_force(spark, options):
    events, versions = mixed()
    assert joined(spark, events, versions, **options) == by_hand(events, versions)


def test_panes_hold_what_a_task_may_order(spark):
    events, versions = mixed()
    rows = spark.createDataFrame(events, EVENTS).selectExpr("key", "other", "place AS _place").dropna()
    width = asof.pane_width(rows.distinct(), ["key", "other"], 20)
    fullest = rows.distinct().groupBy("key", "other", asof._pane("_place", width)).count().agg({"count": "max"})
    assert fullest.first()[0] <= 20
    assert asof.pane_width(rows, ["key", "other"], 10_000) is None


def test_nothing_to_join(spark):
    events, versions = mixed()
    assert joined(spark, [], versions) == []
    assert joined(spark, events[:3], []) == sorted((e[0], None) for e in events[:3])


def test_a_change_takes_the_route_of_its_place(spark):
    image = '{"source_table":"a","operate_type":"insert","sink_type":"kafka","sink_table":"%s"}'
    feed = [("s.d.p", "CREATE", None, image % "one", 10), ("s.d.p", "UPDATE", None, image % "two", 20),
            ("s.d.p", "DELETE", image % "two", None, 30), ("s.d.p", "CREATE", None, image % "three", 40)]
    config = changelog.envelope(spark.createDataFrame(
        feed, "topic STRING, op STRING, before STRING, after STRING, seq BIGINT"))
    places = [9, 10, 19, 20, 29, 30, 39, 40, 99]
    changes = spark.createDataFrame([("a", "insert", place) for place in places], "table STRING, type STRING, place BIGINT")
    got = {r.place: r.route and r.route.sink_table for r in routing.routes_as_of(changes, config, "place").collect()}
    assert got == dict(zip(places, [None, "one", "one", "two", "two", None, None, "three", "three"]))


def test_the_feed_wins_between_the_marks(spark):
    snapshot = spark.createDataFrame([
        ("1", "as read", 10, 20),         # changed inside the marks, the row shows it or not
        ("2", "as read", 10, 20),         # no change
        ("3", "as read", 10, 20),         # deleted inside the marks, after the row was read
        ("4", "as read", 10, 20),         # only an old change
        ("5", "as read", 10, 20)], "pk STRING, value STRING, low BIGINT, high BIGINT")
    changes = spark.createDataFrame([
        ("1", "update", "inside", 15), ("3", "delete", None, 12), ("4", "update", "old", 9),
        ("5", "update", "inside", 11), ("5", "delete", None, 13), ("5", "insert", "again", 25),
        ("6", "insert", "new", 14)], "pk STRING, type STRING, value STRING, seq BIGINT")
    feed = changelog.bootstrapped(snapshot, changes)
    got = {r.pk: r.value for r in changelog.latest_images(feed, ["pk"]).collect()}
    assert got == {"1": "inside", "2": "as read", "4": "as read", "5": "again", "6": "new"}
    marks = {r.pk: r.type for r in changelog.last_images(feed, "pk").collect()}
    assert marks["3"] == "delete" and len(marks) == 6


def current(spark, store):
    return {(r.sink_table, r.pk): r.data for r in dimensions.read_rows(spark, store).collect()}


def test_late_changes_find_their_place_after_compaction(spark):
    early = [("t", "1", "insert", 10, {"id": "1", "a": "x", "b": "y"}), ("t", "1", "update", 30, {"a": "z"}),
             ("t", "2", "insert", 10, {"id": "2", "a": "x"}), ("t", "2", "delete", 30, {}),
             ("t", "3", "delete", 10, {}), ("t", "3", "insert", 20, {"id": "3"})]
    late = [("t", "1", "update", 20, {"a": "too late", "b": "between"}),       # after b's, before a's
            ("t", "2", "update", 20, {"a": "before the delete"}),
            ("t", "3", "update", 5, {"a": "before the delete"}), ("t", "3", "update", 15, {"a": "after it"})]
    frames = [spark.createDataFrame(rows, dimensions.STORED) for rows in (early, late)]
    wanted = {(r.sink_table, r.pk): r.data
              for r in changelog.upserted_rows(frames[0].unionByName(frames[1])).collect()}
    store = run_folder(spark, "late")
    dimensions.append_changes(frames[0], store, 0)
    assert dimensions.compact(spark, store) == 0
    dimensions.append_changes(frames[1], store, 1)
    assert current(spark, store) == wanted
    assert wanted == {("t", "1"): {"id": "1", "a": "z", "b": "between"}, ("t", "3"): {"id": "3", "a": "after it"}}
    assert dimensions.compact(spark, store) == 1
    assert current(spark, store) == wanted


def test_compaction_keeps_no_row_that_says_nothing(spark):
    rows = [("t", "1", "update", n, {"id": "1", "a": str(n)}) for n in range(50)] + [("t", "1", "update", 60, {"b": "x"})]
    kept = changelog.effective_changes(spark.createDataFrame(rows, dimensions.STORED)).collect()
    assert sorted((r.seq, r.type, r.data) for r in kept) == [
        (49, "insert", {"id": "1", "a": "49"}), (60, "insert", {"b": "x"})]


def test_a_lookup_opens_only_the_buckets_of_its_keys(spark):
    store = run_folder(spark, "buckets")
    rows = [(table, str(n), "insert", n, {"id": str(n), "a": table}) for table in ("t", "u") for n in range(200)]
    dimensions.append_changes(spark.createDataFrame(rows, dimensions.STORED), store, 0)
    dimensions.compact(spark, store)
    dimensions.append_changes(spark.createDataFrame(
        [("t", "7", "update", 900, {"a": "new"})], dimensions.STORED), store, 1)
    keys = spark.createDataFrame([("7",), ("missing",), (None,)], "pk STRING")
    found = dimensions.read_dimension(spark, store, "t", ["id", "a"], keys)
    assert [tuple(r) for r in found.collect()] == [("7", "new")]
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_of(found))
    assert filters and all("sink_table" in f and "bucket" in f for f in filters)
    # What must not be opened cannot be read: the lookup works, a read of everything does not.
    needed = {f"bucket={r[0]}" for r in keys.select(dimensions.bucket_of("pk")).collect()}
    spoilt = 0
    for folder, _, names in os.walk(store):
        if "bucket=" in folder and not ("sink_table=t" in folder and os.path.basename(folder) in needed):
            for name in names:
                os.chmod(os.path.join(folder, name), 0o644)
                with open(os.path.join(folder, name), "wb") as file:
                    file.write(b"spoilt")
                spoilt += 1
    assert spoilt > 10
    again = dimensions.read_dimension(spark, store, "t", ["id", "a"], keys)
    assert [tuple(r) for r in again.collect()] == [("7", "new")]
    with pytest.raises(Exception):
        dimensions.read_rows(spark, store).collect()


def test_a_transaction_meets_the_rules_of_its_place(spark):
    """At every place the rules in force are those that the feed up to there leaves."""
    plain = "%d,(%s),(payeeId),(),(paymentAmount),(SUM),(>),(%d),(1)"
    lines = [plain % (1, "active", 1), plain % (2, "active", 2), plain % (1, "active", 3), plain % (2, "pause", 4),
             plain % (3, "active", 5), '{"ruleState":"CONTROL","controlType":"EXPORT_RULES_CURRENT"}',
             '{"ruleState":"CONTROL","controlType":"DELETE_RULES_ALL"}', plain % (2, "active", 8), "odd",
             plain % (2, "delete", 9), plain % (4, "active", 10), (plain % (4, "active", 11)).replace("(1)", "(-1)"),
             '{"ruleState":"CONTROL","controlType":"DELETE_RULES_ALL"}', plain % (1, "active", 13)]
    parsed = rules.valid_rules(rules.parse_rules(feed(spark, *lines)))
    rows = transactions(spark, [(n, n, n % 3, 1, "5") for n in range(32)])
    placed = rows.withColumn("place", F.expr("IF(transactionId = 31, NULL, transactionId div 2 - 1)"))
    columns = ["transactionId", "rule_id", "key", "amount", "limit_value"]
    expected = []
    for place in range(-1, 15):
        active = rules.active_rules(parsed.filter(F.col("seq") <= place))
        expected += rules.fan_out(placed.filter(F.col("place") == place), active).select(columns).collect()
    found = rules.fan_out_as_of(placed, parsed, "place").select(columns).collect()
    assert len(found) > 15 and sorted(map(str, found)) == sorted(map(str, expected))
    nothing = rules.fan_out_as_of(placed, parsed.limit(0), "place")
    assert nothing.count() == 0 and nothing.columns == [*placed.columns, *rules.fan_out(rows, parsed).columns[len(rows.columns):]]
    assert rules.fan_out_as_of(placed.limit(0), parsed, "place").count() == 0


def test_places_are_worked_out_once(spark):
    events, versions = mixed()
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(key):
        seen.add(1)
        return key
    asked = spark.createDataFrame(events, EVENTS).withColumn("key", noted.asNondeterministic()("key"))
    found = asof.as_of_join(asked, spark.createDataFrame(versions, VERSIONS), ["key", "other"], "place", most=20).collect()
    assert sorted((r.id, r.version.value if r.version else None) for r in found) == by_hand(events, versions)
    # Once for the places, whatever the rounds that find the width, and once for the events themselves.
    assert seen.value <= 2 * len(events), seen.value / len(events)
