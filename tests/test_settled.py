"""Jobs over rows that time has settled: against batch, with restarts, late rows, a repeated micro-batch, no store of keys."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.rows import LOG_WITH_SEQ, page, pages, seqs
from tidemart.functions.times import event_time
from tidemart.operators import stats, visits
from tidemart.plans import stream_catalog
from tidemart.session import run_folder
from tidemart.sources.topics import subscribe
from tidemart.streaming import jobs
from tidemart.streaming.settled import bounces_changing, windows_changing

GAP = 10_000
FLUSH = page("flush", 4_102_444_800_000, 10**9)


class Job:
    def __init__(self, spark, start):
        self.spark, self.start, self.folder = spark, start, run_folder(spark, "settled")

    def take_up(self, rows):
        pages(self.spark, rows).coalesce(1).write.mode("append").parquet(os.path.join(self.folder, "rows"))
        return self.go_on()

    def go_on(self):
        read = subscribe(self.spark, os.path.join(self.folder, "rows"), LOG_WITH_SEQ)
        self.start(read, self.folder, os.path.join(self.folder, "checkpoint")).start().awaitTermination()
        return self.table("batches")

    def table(self, *names):
        return self.spark.read.parquet(os.path.join(self.folder, *names))

    def fail_last(self):
        commits = os.path.join(self.folder, "checkpoint", "commits")
        last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
        for name in (last, f".{last}.crc"):
            os.remove(os.path.join(commits, name))


def bounce_job(spark):
    return Job(spark, lambda read, folder, checkpoint: bounces_changing(read, GAP, folder, checkpoint, once=True))


def window_job(spark, delay_ms=1_000):
    def start(read, folder, checkpoint):
        events = stats._visitor_row(read, pv_ct=F.lit(1))
        return windows_changing(events, stats.visitor_stats, event_time("ts"), "2 seconds", folder, checkpoint, delay_ms, once=True)
    return Job(spark, start)


def drawn(rng, n=400):
    moments = sorted(rng.randrange(0, 400_000) for _ in range(n))
    return [page(f"m{rng.randrange(6)}", t, i, last=rng.choice([None, "home"])) for i, t in enumerate(moments)]


def test_bounces_across_restarts_are_those_of_the_batch(spark):
    rows = [*drawn(random.Random(3)), FLUSH]
    # Cuts within pairs: pages of one moment must not lie on both sides.
    parts = [[r for r in rows if low < r[4] <= high] for low, high in ((-1, 120_000), (120_000, 251_000), (251_000, FLUSH[4]))]
    job = bounce_job(spark)
    for part in parts:
        found = job.take_up(part)
    expected = [n for n in seqs(visits.bounces(pages(spark, rows), GAP)) if n != FLUSH[5]]
    assert expected and seqs(found) == expected
    assert job.table("late").count() == 0
    # Held is what may still be followed: the last page here.
    assert seqs(job.table("state", "turn-0", "held")) == [FLUSH[5]]
    job.fail_last()
    assert seqs(job.go_on()) == expected


@pytest.mark.parametrize("offset, bounced", [(GAP - 1, []), (GAP, [1])])
def test_the_gap_ends_as_in_batch_across_micro_batches(spark, offset, bounced):
    job = bounce_job(spark)
    job.take_up([page("a", 100_000, 1)])
    job.take_up([page("a", 100_000 + offset, 2, last="home")])
    assert seqs(job.take_up([FLUSH])) == bounced


def test_a_late_page_follows_nothing_and_is_kept_apart(spark):
    job = bounce_job(spark)
    job.take_up([page("a", 100_000, 1), page("b", 105_000, 2, last="home")])
    job.take_up([page("a", 101_000, 3, last="home")])
    assert seqs(job.take_up([FLUSH])) == [1]
    assert [r.seq for r in job.table("late").collect()] == [3]


def test_windows_across_restarts_with_a_late_row(spark):
    job = window_job(spark)
    job.take_up([page("a", 500, 1), page("a", 2_500, 2), page("a", 3_500, 3)])
    # 500 belongs to a window that ended at 2,000 with the watermark at 2,500; 2,100 to one still open.
    job.take_up([page("a", 700, 4), page("a", 2_100, 5)])
    found = job.take_up([page("a", 9_000, 6)])
    assert sorted((r.stt[-2:], r.pv_ct) for r in found.collect()) == [("00", 1), ("02", 3)]
    assert job.table("late").count() == 1
    job.fail_last()
    assert sorted((r.stt[-2:], r.pv_ct) for r in job.go_on().collect()) == [("00", 1), ("02", 3)]


def test_held_rows_are_those_of_open_windows(spark):
    job = window_job(spark)
    job.take_up([page("a", t, t) for t in range(0, 20_000, 500)])
    assert job.table("state", "turn-0", "held").agg(F.min("ts")).first()[0] == 18_000


@pytest.mark.parametrize("name", ["stream_user_bounce", "stream_keyword_stats"])
def test_no_join_or_window_of_a_stream_keeps_rows_in_a_store(spark, monkeypatch, name):
    """Jobs that go through Spark's own state: none but the repair, whose state is a flag a device."""
    went = []
    for module in (stream_catalog, jobs):
        monkeypatch.setattr(module, "taken_up", lambda spark, stream, folder, *rest, old=jobs.taken_up: (
            went.append(os.path.basename(folder)), old(spark, stream, folder, *rest))[1])
    assert stream_catalog.registry()[name](spark, "/root/testdata/sf0.001").count() > 0
    assert set(went) == {"clean", "repaired", "pages"}


def test_lines_are_joined_once_and_give_the_same_details(spark):
    inputs, kept = [stream_catalog.warehouse(spark, "/root/testdata/sf0.001").inputs for _ in range(2)]
    kept.keep_lines()
    for name in ("details", "favors", "carts", "refunds", "comments"):
        ours, theirs = getattr(kept, name)(), getattr(inputs, name)()
        assert ours.schema == theirs.schema and ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
        assert "Join" not in ours._jdf.queryExecution().executedPlan().toString()
