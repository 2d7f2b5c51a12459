"""The interval join over held tables: against batch, with restarts, late rows, a repeated micro-batch."""

import os
import random

from pyspark.sql import functions as F

from tests.test_boundaries import detail, order, orders_and_details
from tests.test_streams import as_set
from tidemart.functions.times import parse_ms
from tidemart.operators import wide
from tidemart.session import run_folder, shuffles_let_go
from tidemart.sources.topics import subscribe
from tidemart.streaming.intervals import join_changing


def clock(s):
    return f"2021-01-01 {s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}"


def rows_of(orders, details):
    return wide.order_wide(wide.join_order_details(orders, details))


class Job:
    def __init__(self, spark, orders, details):
        self.spark, self.folder = spark, run_folder(spark, "intervals")
        self.schemas = {"orders": orders.schema, "details": details.schema}

    def take_up(self, orders, details):
        for name, rows in (("orders", orders), ("details", details)):
            self.spark.createDataFrame(rows, self.schemas[name]).coalesce(1).write.mode("append").parquet(
                os.path.join(self.folder, name))
        return self.go_on()

    def go_on(self):
        read = [subscribe(self.spark, os.path.join(self.folder, name), schema) for name, schema in self.schemas.items()]
        join_changing(*read, rows_of, parse_ms("create_time"), -5_000, 5_000, self.folder,
                      os.path.join(self.folder, "checkpoint"), once=True).start().awaitTermination()
        return self.spark.read.parquet(os.path.join(self.folder, "batches")).drop("batch")

    def table(self, *names):
        return self.spark.read.parquet(os.path.join(self.folder, *names))


def test_pairs_across_restarts_are_those_of_the_batch(spark):
    rng = random.Random(6)
    orders, details = orders_and_details(
        spark, [order(n, clock(100 + n * 2)) for n in range(90)],
        [detail(n, n % 90, clock(100 + (n % 90) * 2 + rng.randrange(-7, 8))) for n in range(360)])
    job = Job(spark, orders, details)
    # Cut at the same times, so that pairs lie across the cuts both ways.
    cuts = [clock(160), clock(220)]
    part = lambda rows, n: [r for r in rows if sum(r.create_time > c for c in cuts) == n]
    for n in range(3):
        found = job.take_up(part(orders.collect(), n), part(details.collect(), n))
    assert as_set(found) == as_set(rows_of(orders, details))
    assert job.table("late").count() == 0
    # No more is held than may still meet something: both sides' last 5 seconds, and what is newer.
    newest = min(r.agg(F.max(parse_ms("create_time"))).first()[0] for r in (orders, details))
    held = job.table("state", "turn-0", "held_left")
    assert 0 < held.count() < 10 and held.agg(F.min("_ms")).first()[0] >= newest - 5_001
    # A micro-batch that failed after its write is done again.
    commits = os.path.join(job.folder, "checkpoint", "commits")
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.remove(os.path.join(commits, name))
    assert as_set(job.go_on()) == as_set(rows_of(orders, details))


def test_a_late_row_meets_nothing_and_is_kept_apart(spark):
    orders, details = orders_and_details(
        spark, [order(1, clock(10)), order(2, clock(100))], [detail(1, 1, clock(10)), detail(2, 2, clock(100)), detail(3, 1, clock(12))])
    o, d = orders.orderBy("create_time").collect(), {r.id: r for r in details.collect()}
    job = Job(spark, orders, details)
    job.take_up(o, [d[1], d[2]])
    found = job.take_up([], [d[3]])
    assert sorted(r.detail_id for r in found.collect()) == [1, 2]
    assert [r.id for r in job.table("late", "side=right").collect()] == [3]


def test_one_side_waits_for_the_other(spark):
    orders, details = orders_and_details(spark, [order(1, clock(10))], [detail(1, 1, clock(15)), detail(2, 1, clock(16))])
    job = Job(spark, orders, details)
    job.take_up(orders.collect(), [])
    found = job.take_up([], details.collect())
    assert [r.detail_id for r in found.collect()] == [1]


def test_a_micro_batch_leaves_no_copy_of_its_rows_and_shuffles_nothing_twice(spark):
    """What only it looks at is deleted; the clock and the held rows stay for the next."""
    orders, details = orders_and_details(spark, [order(n, clock(100 + n)) for n in range(6)],
                                         [detail(n, n % 6, clock(100 + n % 6)) for n in range(12)])
    job = Job(spark, orders, details)
    first = [r for r in orders.collect() if r.id < 3], [r for r in details.collect() if r.order_id < 3]
    job.take_up(*first)
    found = job.take_up(orders.filter("id >= 3").collect(), details.filter("order_id >= 3").collect())
    assert as_set(found) == as_set(rows_of(orders, details))
    for turn in (0, 1):
        assert sorted(os.listdir(os.path.join(job.folder, "state", f"turn-{turn}"))) == ["clock", "held_left", "held_right"]


def test_shuffled_rows_go_with_the_action_inside_and_stay_outside(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    with shuffles_let_go(spark):
        assert spark.conf.get(key) == "true"
        assert spark.range(100).groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    assert spark.conf.get(key) == before
