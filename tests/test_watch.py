"""What the listener and the state reader tell: late rows, flags that fall away, what a restart finds."""

import time

import pytest
from pyspark.sql import functions as F

from tests.rows import LOG_WITH_SEQ, page, pages, seqs
from tests.test_streams import FLUSH, in_files
from tidemart.operators import stats, visits
from tidemart.session import run_folder
from tidemart.sinks.topics import table_sink
from tidemart.sources.topics import subscribe
from tidemart.streaming import state, watch

HOUR, DAY = 3_600_000, 86_400_000


@pytest.fixture
def told(spark):
    folder = run_folder(spark, "progress")
    listener = watch.StateProgress(spark, folder)
    spark.streams.addListener(listener)
    yield folder
    spark.streams.removeListener(listener)


def heard(spark, folder, query):
    """The rows of the query, once its last micro-batch has been told of."""
    last = query.lastProgress.batchId
    for _ in range(120):
        try:
            found = watch.state_progress(spark, folder).filter(F.col("query") == str(query.id))
            if found.filter(F.col("batch") >= last).count():
                return found
        except Exception as missing:  # the folder is not there before the first row
            if "PATH_NOT_FOUND" not in str(missing):
                raise
        time.sleep(0.25)
    raise AssertionError("the last micro-batch was never told of")


def run(spark, stream, name):
    out = run_folder(spark, name)
    query = table_sink(stream, out + "-checkpoint", out, once=True).start()
    query.awaitTermination()
    return query, out


def test_late_rows_of_windows_are_counted(spark, told):
    parts = [[page("a", 100_000, 1)], [page("a", 200_000, 2)], [page("a", 1_000, 3)],
             [page("a", 2_000, 4)], [page("a", FLUSH, 5)]]
    _, stream = in_files(spark, parts, LOG_WITH_SEQ, "late-told")
    events = stats.visitor_events(stream, stream.filter("false"), stream.filter("false"), compact=True)
    query, _ = run(spark, stats.visitor_stats(events), "late-told-out")
    progress = heard(spark, told, query)
    assert [r.rows_dropped for r in watch.dropped_rows(progress).collect()] == [2]
    assert {r.batch for r in progress.filter("rows_dropped > 0").collect()} == {2, 3}


def test_no_row_of_a_stream_in_order_is_late(spark, told):
    rows = [page("m", ts, n, last=None) for n, ts in enumerate(range(1_000, 90_000, 1_000))]
    _, stream = in_files(spark, [rows[:30], rows[30:60], rows[60:]], LOG_WITH_SEQ, "in-order")
    query, _ = run(spark, state.bounces(stream, 2_000), "in-order-out")
    progress = heard(spark, told, query)
    assert {r.rows_dropped for r in progress.collect()} == {0}
    assert progress.agg(F.max("rows_held")).first()[0] > 0


def flags(spark, checkpoint, batch=None):
    return sorted((r.mid, r.day) for r in watch.held_state(spark, checkpoint, batch=batch).select("key.mid", "key.day").collect())


def test_a_visit_flag_falls_away_after_its_day(spark):
    """While the watermark, a day behind, is inside the day the flag is there; then it is gone."""
    parts = [[page("a", HOUR, 1)], [page("a", 2 * HOUR, 2)], [page("b", 2 * DAY + HOUR, 3)], [page("b", 2 * DAY + 2 * HOUR, 4)]]
    folder, checkpoint = run_folder(spark, "flags"), run_folder(spark, "flags-out") + "-checkpoint"
    out, held = run_folder(spark, "flags-table"), []
    for part in parts:
        spark.createDataFrame(part, LOG_WITH_SEQ).coalesce(1).write.mode("append").parquet(folder)
        uniques = state.daily_unique_visits(subscribe(spark, folder, LOG_WITH_SEQ))
        table_sink(uniques, checkpoint, out, once=True).start().awaitTermination()
        held.append(flags(spark, checkpoint))
    assert held[0] == held[1] == [("a", 0)]
    assert held[-1] == [("b", 2)]
    rows = [r for part in parts for r in part]
    assert seqs(spark.read.schema(LOG_WITH_SEQ).parquet(out)) == seqs(visits.daily_unique_visits(pages(spark, rows))) == [1, 3]


def test_a_claim_is_held_for_ever_and_found_by_a_restart(spark):
    parts = [[page("a", HOUR, 1, is_new="1"), page("b", HOUR, 2, is_new="0")], [page("a", 400 * DAY, 3, is_new="1")]]
    folder, checkpoint = run_folder(spark, "claims"), run_folder(spark, "claims-out") + "-checkpoint"
    out = run_folder(spark, "claims-table")
    for part in parts:
        spark.createDataFrame(part, LOG_WITH_SEQ).coalesce(1).write.mode("append").parquet(folder)
        repaired = state.repair_new_users(subscribe(spark, folder, LOG_WITH_SEQ))
        table_sink(repaired, checkpoint, out, once=True).start().awaitTermination()
        assert [r.mid for r in watch.held_state(spark, checkpoint).select("key.mid").collect()] == ["a"]
    found = {r.seq: r.common.is_new for r in spark.read.schema(LOG_WITH_SEQ).parquet(out).collect()}
    assert found == {1: "1", 2: "0", 3: "0"}
