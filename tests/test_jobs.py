"""The layered batch jobs and the dimension tables."""

import os

from tidemart.plans.catalog import SETTINGS, registry
from tidemart.plans.jobs import LAYERS, LayeredWarehouse
from tidemart.schemas import (PRODUCT_STATS_COLUMNS, PROVINCE_STATS_COLUMNS, TABLE_PROCESS,
                              VISITOR_STATS_COLUMNS)
from tidemart.session import run_folder
from tidemart.sinks.dimensions import create_tables
from tidemart.sources.derived import Inputs
from tidemart.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def as_set(df):
    return sorted(map(str, df.collect()))


def test_layers_give_the_same_statistics(spark):
    folder = run_folder(spark, "layers")
    w = LayeredWarehouse(Inputs(Tables(spark, FOLDER)), SETTINGS, folder)
    w.write_layers()
    w.write_statistics()
    for name in LAYERS:
        assert os.path.join(folder, name) in w.__dict__[name].inputFiles()[0]
    for name, columns in (("visitor_stats", VISITOR_STATS_COLUMNS), ("province_stats", PROVINCE_STATS_COLUMNS),
                          ("sink_projection", PRODUCT_STATS_COLUMNS)):
        table = spark.read.parquet(os.path.join(folder, name.replace("sink_projection", "product_stats")))
        assert table.columns == list(columns)
        expected = registry()[name](spark, FOLDER)
        shared = [c for c in columns if c in expected.columns]
        assert as_set(table.select(shared)) == as_set(expected.select(shared))


def test_dimension_tables_are_created_once(spark):
    config = spark.createDataFrame(
        [("a", "insert", "hbase", "dim_a", "id,name", "id", None),
         ("a", "update", "hbase", "dim_a", "id", "id", None),
         ("b", "insert", "kafka", "fact_b", "id", "id", None)], TABLE_PROCESS)
    assert create_tables(spark, config, "dims_test") == ["dim_a"]
    assert create_tables(spark, config, "dims_test") == ["dim_a"]
    table = spark.table("dims_test.dim_a")
    assert [(f.name, f.dataType.simpleString()) for f in table.schema] == [("id", "string"), ("name", "string")]
