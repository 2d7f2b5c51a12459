"""Shape of the physical plans: what must not appear, and what must."""

import re

import pytest
from pyspark.sql import functions as F

from tidemart.operators import rules, stats, visits
from tidemart.plans.catalog import registry, warehouse

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(build(spark, FOLDER)) for name, build in registry().items()}


def test_no_pairing_joins_and_no_python(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan and "Pandas" not in plan, name


def test_no_single_partition_step(plans):
    """Nothing gathers rows in one task, but for one-row results: the last delete-all, which
    all that reads the rules in force asks for, and their number."""
    last_wipe = {"rule_active_set", "rule_unusable", "rules_in_force", "rule_fanout", "rule_alerts"}
    for name, plan in plans.items():
        main = plan.split("Subqueries")[0]
        for exchange in re.findall(r"Exchange SinglePartition", main):
            assert name in last_wipe, (name, exchange)


@pytest.mark.parametrize("name", ["log_new_user_repair", "daily_unique_visit", "changelog_latest",
                                  "config_latest", "rule_active_set"])
def test_first_per_key_is_cut_before_the_shuffle(plans, name):
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", plans[name]), name


def test_bounces_bring_no_history_together(spark):
    w = warehouse(spark, FOLDER)
    plan = plan_of(visits.bounces(w.raw_pages, 10_000))
    assert "Window" not in plan
    assert re.search(r"SortAggregate\(.*partial_max", plan)


def test_aggregates_start_before_the_shuffle(plans):
    for name in ("visitor_stats", "product_stats", "province_stats", "keyword_stats"):
        assert "partial_sum" in plans[name] or "partial_count" in plans[name], name


def test_scans_read_only_what_they_need(spark, plans):
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plans["product_refund"]).group(1)
    assert "l_tax" not in scan and "l_shipdate" not in scan
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(l_returnflag,R\)", plans["product_refund"])
    tokens = re.findall(r"ReadSchema: struct<([^>]*)>", plans["keyword_stats"])
    assert all("value" not in scan and "props" not in scan for scan in tokens)


@pytest.mark.parametrize("name,table,most", [
    ("visitor_stats", "events", 4), ("visitor_events", "events", 4), ("visitor_stats", "part", 0),
    ("product_events", "lineitem", 3), ("product_events", "orders", 6), ("product_events", "events", 1)])
def test_inputs_are_read_a_few_times_at_most(plans, name, table, most):
    assert len(re.findall(rf"sf0.001/{table}.parquet", plans[name])) <= most


@pytest.mark.parametrize("name", ["cdc_column_prune", "dim_upsert", "cdc_route_fact"])
def test_the_change_log_is_read_once_and_not_dealt_by_route(plans, name):
    assert len(re.findall(r"sf0.001/nation.parquet", plans[name])) == 1
    assert not re.search(r"hashpartitioning\(table#\d+, type#", plans[name])


def test_rule_moments_and_windows_are_added_up_without_sorting(spark):
    told = rules.moments(warehouse(spark, FOLDER).fanned())
    assert "SortAggregate" not in plan_of(told)
    windows = plan_of(rules.alerting_moments(told))
    assert "SortAggregate" not in windows
    # Every block fits a task: there is nothing around a pane, and no row carries what its rule asks for.
    assert "SortMergeJoin" not in windows
    dealt = re.findall(r"Exchange hashpartitioning\(rule_id#\d+, key#\d+, _at#\d+L, _part#\d+L", windows)
    assert len(dealt) == 1


def test_rules_of_whole_and_of_cut_blocks_go_together(spark, monkeypatch):
    """Blocks over the bound are cut, others stay whole: the alerts are those of whole blocks."""
    told = rules.moments(warehouse(spark, FOLDER).fanned()).persist()
    alerts = lambda: sorted(map(tuple, rules.alerting_moments(told).collect()))
    whole = alerts()
    blocks = told.groupBy("rule_id", "key").count().agg({"count": "max"}).first()[0]
    monkeypatch.setattr(rules, "PART_ROWS", 2)
    assert whole and blocks > 2 and alerts() == whole
    told.unpersist()


def test_a_window_parses_its_time_once(spark):
    """Also: the province statistics need no other column of the wide row than those their stream keeps."""
    orders = warehouse(spark, FOLDER).inputs.orders().withColumn("order_id", F.col("id")).withColumn(
        "split_total_amount", F.col("total_amount"))
    names = getattr(stats, "PROVINCE_INPUTS", ())
    wide = orders.withColumns({name: F.lit("x") for name in (
        "province_name", "province_area_code", "province_iso_code", "province_3166_2_code")})
    wide = wide.select(*names) if names else wide
    assert plan_of(stats.province_stats(wide, "1 hour")).count("+00:00") == 1


def plan_of_large(spark, name: str) -> str:
    """The plan where no side is small enough to be sent to all."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        return plan_of(registry()[name](spark, FOLDER))
    finally:
        spark.conf.set(threshold, before)


@pytest.mark.parametrize("name", ["product_stats", "product_stats_enriched", "sink_projection"])
def test_product_events_move_once_and_their_lines_are_shuffled_once(spark, name):
    """Rows are reduced per order where the join on the order left them; all steps ask for the same lines."""
    plan = plan_of_large(spark, name)
    assert len(re.findall(r"Exchange hashpartitioning\((?:window|_start)#", plan)) == 1
    assert "order_id" not in "".join(re.findall(r"Exchange hashpartitioning\([^)]*sku_id[^)]*\)", plan))
    lines = [re.sub(r"#\d+L?", "", scan) for scan in re.findall(r"FileScan parquet (\[l_.*)", plan)]
    assert len(lines) == 3 and len(set(lines)) == 1


def test_payments_meet_wide_rows_where_these_were_joined(spark):
    """Wide rows move once, for their products; orders are looked up before they are joined with their lines."""
    plan = plan_of_large(spark, "payment_wide")
    assert not re.search(r"Exchange hashpartitioning\(r_order_id#", plan)
    assert len(re.findall(r"Exchange hashpartitioning\(cast\(sku_id#", plan)) == 1
