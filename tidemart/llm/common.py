"""What the corpus operators share: reading, written intermediate tables, ranks without hot tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.session import run_folder

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str, *parts: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder, with a folder per value of `parts`.

    Cuts the lineage: what follows survives lost executors and sees one version of the rows.
    """
    folder = run_folder(df.sparkSession, name)
    (df.write.partitionBy(*parts) if parts else df.write).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(seed: int, *columns: str) -> Column:
    """A hash that fixes the order in which documents are chosen."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns])


def ranked(df: DataFrame, group: list[str], hashed: str, ties: list[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 in the order of `hashed`, then `ties`.

    In two levels, so that a group may hold any share of the rows: a group is cut into 4,096
    ranges of the hash, whose counts (at most 4,096 a group) give each range its first number.
    Group columns must not be null.  Rows alike in hash and ties take their numbers in any order.
    """
    cut = df.withColumn("_cut", F.shiftrightunsigned(hashed, 52).cast("int"))
    before = Window.partitionBy(*group).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    first = (cut.groupBy(*group, "_cut").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(*group, "_cut").orderBy(
        F.shiftrightunsigned(hashed, 0), *[F.col(c) for c in ties])
    return (cut.join(first, [*group, "_cut"])
            .withColumn(name, (F.row_number().over(inside) - 1 + F.col("_first")).cast("long"))
            .drop("_cut", "_first"))
