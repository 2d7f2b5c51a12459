"""Search keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.codes import SEARCH_SOURCE
from tidemart.functions.records import words
from tidemart.functions.times import rowtime


def keyword_rows(pages: DataFrame) -> DataFrame:
    """Searched texts with their event time; rows need ``ts`` and a page."""
    return (pages.filter((F.col("page.item_type") == "keyword") & F.col("page.item").isNotNull())
                 .select(F.col("page.item").alias("full_word"), rowtime("ts").alias("rowtime")))


def keyword_tokens(rows: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """One row per word; texts without words disappear.

    With a dictionary (column ``word``) only its words are kept.
    """
    tokens = rows.select(F.explode(words(F.col("full_word"))).alias("keyword"), "rowtime")
    if dictionary is None:
        return tokens
    return tokens.join(dictionary.select(F.col("word").alias("keyword")), "keyword", "left_semi")


def keyword_stats(tokens: DataFrame, size: str = "2 seconds",
                  delay: str = "2 seconds") -> DataFrame:
    """Searches per word and window, in SQL."""
    timed = tokens.withWatermark("rowtime", delay) if tokens.isStreaming else tokens
    return tokens.sparkSession.sql("""
        SELECT keyword, ct, {source} AS source,
               date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt
        FROM (SELECT keyword, window(rowtime, {size}) AS window, count(*) AS ct
              FROM {tokens} GROUP BY keyword, window(rowtime, {size}))
        """, tokens=timed, size=size, source=SEARCH_SOURCE)
