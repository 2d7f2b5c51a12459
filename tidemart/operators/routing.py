"""Config-driven routing of database changes to fact topics and dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.functions.records import camel_case, keep_listed, listed, sorted_json, with_evaluated
from tidemart.operators.asof import as_of_join
from tidemart.operators.changelog import latest_images
from tidemart.operators.keyed import first_per_key
from tidemart.schemas import CHANGE, CHANGE_DATA, TABLE_PROCESS

_CHANGE_PARSED = T.StructType(CHANGE.fields + [T.StructField("_corrupt", T.StringType())])

# Sink types of the routing config.
FACT_SINK = "kafka"
DIM_SINK = "hbase"

# Text of the table statement, and the key used when none is configured.
DEFAULT_KEY = "id"


def parse_changes(raw: DataFrame, value: str = "value") -> DataFrame:
    """Change text as database, table, type and data, with the text and what is wrong with it.

    ``problem`` is null for a usable change, ``malformed`` when the text is not the declared
    JSON, ``no_object`` when its payload is text but no object.  Absent and empty payloads
    are no problem; their data is null.
    """
    rest = [name for name in raw.columns if name != value]
    parsed = with_evaluated(raw, "_record", F.from_json(
        value, _CHANGE_PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    filled = F.coalesce(F.length("_record.data"), F.lit(0)) > 0
    parsed = with_evaluated(parsed, "_data", F.when(filled, F.from_json("_record.data", CHANGE_DATA)))
    problem = (F.when(F.col("_record").isNull() | F.col("_record._corrupt").isNotNull(), "malformed")
                .when(filled & F.col("_data").isNull(), "no_object"))
    return parsed.select(
        "_record.database", "_record.table", "_record.type", F.col("_data").alias("data"), *rest,
        F.col(value).alias("_raw"), problem.alias("problem"))


def clean_changes(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).drop("_raw", "problem")


def dirty_changes(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull()).select(
        *[name for name in ("seq",) if name in parsed.columns], F.col("_raw").alias("raw"), "problem")


def non_empty(changes: DataFrame) -> DataFrame:
    """Changes with a payload; ``{}`` is a payload, an absent or empty text is none."""
    return changes.filter(F.col("data").isNotNull())


def normalize_type(changes: DataFrame) -> DataFrame:
    """Rows copied when a feed is set up count as inserts."""
    return changes.withColumn(
        "type", F.when(F.col("type") == "bootstrap-insert", "insert").otherwise(F.col("type")))


def config_versions(config_changes: DataFrame) -> DataFrame:
    """The images of all routes, with the kind of change and its place in the feed.

    A deleted route is known by its image before.
    """
    image = F.when(F.col("type") == "delete", F.col("before")).otherwise(F.col("data"))
    routes = config_changes.select(
        *[image[field.name].alias(field.name) for field in TABLE_PROCESS.fields],
        "type", "seq")
    return routes.filter(F.col("source_table").isNotNull())


def latest_config(config_changes: DataFrame) -> DataFrame:
    """Routing config as it stands after its own change feed: last image per route."""
    return (latest_images(config_versions(config_changes), ["source_table", "operate_type"])
            .select(*TABLE_PROCESS.fieldNames()))


def routes_as_of(changes: DataFrame, config_changes: DataFrame, place: str) -> DataFrame:
    """Every change with the route in force at its place in the feed of the config, as a struct
    ``route``; null before a route's first image, and from its delete to its next image.

    ``changes`` have ``table``, ``type`` and ``place``, on the scale of the config's ``seq``.
    """
    versions = config_versions(config_changes).withColumnsRenamed(
        {"type": "change", "source_table": "table", "operate_type": "type"})
    found = as_of_join(changes, versions, ["table", "type"], place, into="route")
    return found.withColumn("route", F.when(F.col("route.change") != "delete", F.col("route")))


def checked_config(config: DataFrame) -> DataFrame:
    """The config, which must not be empty, ready to be joined with every change."""
    if config.isEmpty():
        raise ValueError("the routing config is empty")
    return config.select(*TABLE_PROCESS.fieldNames())


def match_routes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Every change with the route of its table and type, or nulls when there is none."""
    routes = config.withColumnsRenamed(
        {"source_table": "_route_table", "operate_type": "_route_type"})
    return changes.join(
        routes, (F.col("table") == F.col("_route_table")) & (F.col("type") == F.col("_route_type")),
        "left")


def routed_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Changes for facts and dimensions with sink and key; listed columns only.

    The key is that of the change, whether its column is listed or not; null if it has none.
    """
    # The list of columns is split once per route, not per change.
    wanted = (config.filter(F.col("sink_type").isin(FACT_SINK, DIM_SINK))
                    .withColumn("_listed", listed(F.col("sink_columns"))))
    matched = match_routes(changes, wanted).filter(F.col("_route_table").isNotNull())
    return (matched.withColumn("pk", F.col("data")[F.coalesce("sink_pk", F.lit(DEFAULT_KEY))])
                   .withColumn("data", keep_listed(F.col("data"), F.col("_listed")))
                   .select(*changes.columns, "sink_type", "sink_table", "pk"))


def _to_sink(changes: DataFrame, config: DataFrame, sink_type: str) -> DataFrame:
    routed = routed_changes(changes, config)
    return routed.filter((F.col("sink_type") == sink_type) & F.col("pk").isNotNull()).drop("sink_type")


def fact_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    return _to_sink(changes, config, FACT_SINK)


def dim_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    return _to_sink(changes, config, DIM_SINK)


def keyless_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Routed changes without a key: they could only be merged under a null key."""
    return routed_changes(changes, config).filter(F.col("pk").isNull())


def unrouted_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Changes no route sends anywhere, with the reason."""
    matched = match_routes(changes, config)
    reason = (F.when(F.col("_route_table").isNull(), "no_route")
               .when(~F.coalesce(F.col("sink_type").isin(FACT_SINK, DIM_SINK), F.lit(False)),
                     "unknown_sink"))
    return (matched.withColumn("reason", reason).filter(F.col("reason").isNotNull())
                   .select(*changes.columns, "reason"))


def fact_messages(facts: DataFrame) -> DataFrame:
    """Topic and payload per fact: the payload is the data alone."""
    return facts.select(F.col("sink_table").alias("topic"), sorted_json(F.col("data")).alias("value"))


def rename_to_camel(config: DataFrame) -> DataFrame:
    return config.toDF(*[camel_case(name) for name in config.columns])


def dim_statements(config: DataFrame, schema: str, using: str = "") -> DataFrame:
    """One CREATE TABLE text per dimension route: every column text, one primary key."""
    key = F.coalesce("sink_pk", F.lit(DEFAULT_KEY))
    columns = F.transform(listed(F.col("sink_columns")), lambda name: F.when(
        name == key, F.concat(name, F.lit(" varchar primary key"))
    ).otherwise(F.concat(name, F.lit(" varchar"))))
    text = F.concat(F.lit(f"create table if not exists {schema}."), F.col("sink_table"),
                    F.lit("("), F.array_join(columns, ","), F.lit(")"),
                    F.coalesce("sink_extend", F.lit("")), F.lit(using))
    # A table with several routes is created from the first of them.
    first = first_per_key(config.filter(F.col("sink_type") == DIM_SINK), ["sink_table"],
                          ["source_table", "operate_type"])
    return first.select("sink_table", text.alias("statement"))
