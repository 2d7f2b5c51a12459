"""Layers written once and read back as streams, as jobs hand them to each other."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemart.session import SMALL
from tidemart.sources.derived import Inputs
from tidemart.sources.tables import Tables


def publish(layer: DataFrame, folder: str, name: str) -> str:
    path = os.path.join(folder, name)
    layer.write.mode("overwrite").options(**SMALL).parquet(path)
    return path


def cuts(layer: DataFrame, order: str | Column, parts: int = 3) -> list[float]:
    """Values that cut the layer into about even parts."""
    return sorted(set(layer.select(F.col(order) if isinstance(order, str) else order.alias("_order")).approxQuantile(
        order if isinstance(order, str) else "_order", [n / parts for n in range(1, parts)], 0.01)))


def in_turn(layer: DataFrame, order: str | Column, parts: int = 3, at: list[float] | None = None) -> list[DataFrame]:
    """The layer cut into parts by ranges of a column, as they would arrive one after the other;
    ``at`` gives the cuts, so that several layers can be cut alike."""
    bounds = [None, *(cuts(layer, order, parts) if at is None else at), None]
    place = F.col(order) if isinstance(order, str) else order
    return [layer.filter((F.lit(True) if low is None else place > low)
                         & (F.lit(True) if high is None else F.coalesce(place <= high, F.lit(False))))
            for low, high in zip(bounds, bounds[1:])]


def add_to_topic(part: DataFrame, path: str) -> None:
    part.write.mode("append").options(**SMALL).parquet(path)


def subscribe(spark: SparkSession, path: str, schema: T.StructType,
              files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


class PublishedInputs(Inputs):
    """Inputs of which some are published layers, read as streams."""

    def __init__(self, tables: Tables, streams: dict[str, DataFrame]):
        super().__init__(tables)
        for name, stream in streams.items():
            if not hasattr(Inputs, name):
                raise ValueError(f"no input is called {name}")
            setattr(self, name, lambda stream=stream: stream)
