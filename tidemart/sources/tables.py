"""Reading topics, tables and databases."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemart.functions.records import camel_case
from tidemart.functions.times import rowtime


class Tables:
    """The tables of one folder; those named in ``streams`` are opened as streams."""

    def __init__(self, spark: SparkSession, folder: str, streams: tuple[str, ...] = (),
                 files_per_trigger: int | None = None):
        self.spark, self.folder = spark, folder
        self.streams, self.files_per_trigger = streams, files_per_trigger
        self._opened: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        # Opening lists files and reads a footer, so it is done once per table.
        if name not in self._opened:
            self._opened[name] = self._open(name)
        return self._opened[name]

    def _open(self, name: str) -> DataFrame:
        path = os.path.join(self.folder, f"{name}.parquet")
        table = self.spark.read.parquet(path)
        if name not in self.streams:
            return table
        reader = self.spark.readStream.schema(table.schema)
        if self.files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.files_per_trigger)
        # Written as a pattern, so that one file and a folder of files both work.
        return reader.parquet(os.path.join(self.folder, "{" + name + ".parquet}"))


def read_topic(spark: SparkSession, topic: str, *, servers: str | None = None,
               format: str = "kafka", starting: str = "latest",
               options: dict[str, str] | None = None) -> DataFrame:
    """A stream of text records in one ``value`` column.

    ``kafka`` subscribes to the topic; a file format reads the folder of that name, one
    record per line for ``text``.
    """
    reader = spark.readStream.format(format)
    if format == "kafka":
        reader = (reader.option("kafka.bootstrap.servers", servers)
                        .option("subscribe", topic).option("startingOffsets", starting))
        reader = reader.options(**(options or {}))
        return reader.load().select(F.col("value").cast("string").alias("value"),
                                    F.struct("partition", "offset").alias("position"))
    if format != "text":
        reader = reader.schema("value STRING")
    return reader.options(**(options or {})).load(topic)


def table_source(stream: DataFrame, schema: T.StructType, delay: str, view: str | None = None,
                 ts: str = "ts") -> DataFrame:
    """A typed table over a text stream: parsed columns, event time, watermark, SQL name."""
    table = stream.select(F.from_json("value", schema).alias("_record")).select("_record.*")
    table = table.withColumn("rowtime", rowtime(ts)).withWatermark("rowtime", delay)
    if view:
        table.createOrReplaceTempView(view)
    return table


def read_database(spark: SparkSession, url: str, query: str, *, camel: bool = False,
                  partition: dict[str, str] | None = None,
                  options: dict[str, str] | None = None) -> DataFrame:
    """Rows of a database query, with snake_case names turned to camelCase on request.

    A large result needs ``partition`` (column, lower and upper bound, number), so that
    tasks read ranges of it side by side.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    if partition:
        reader = reader.option("dbtable", f"({query}) q").options(**partition)
    else:
        reader = reader.option("query", query)
    rows = reader.load()
    return rows.toDF(*[camel_case(name) for name in rows.columns]) if camel else rows
