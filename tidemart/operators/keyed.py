"""Small building blocks shared by the keyed operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[Column | str],
                  order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in the given order.

    Written as ``row_number() = 1`` so that Spark keeps one row per key already in
    every map task (WindowGroupLimit): a hot key shuffles a row per task, not its group.
    """
    rank = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(rank))
              .filter(F.col("_rank") == 1).drop("_rank"))

