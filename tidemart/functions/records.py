"""Column expressions over log and change records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_evaluated(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column (parsed text) that later filters and fields share.

    As the output of a generator it is computed once per row; as a plain column the
    optimizer would copy the expression into every filter and field that uses it.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def is_entry_page() -> Column:
    """The page was not reached from another page."""
    return F.coalesce(F.col("page.last_page_id"), F.lit("")) == ""


def listed(names: Column) -> Column:
    """A comma list as an array of names, untrimmed."""
    return F.split(names, ",")


def keep_listed(data: Column, names: Column) -> Column:
    """Map entries whose key is among the names: exact and case-sensitive.

    A missing list keeps every entry.
    """
    return F.when(names.isNull(), data).otherwise(
        F.map_filter(data, lambda key, _: F.array_contains(names, key)))


def drop_blank_entries(data: Column) -> Column:
    """Map entries whose key and value both hold something other than blanks."""
    def filled(text: Column) -> Column:
        return F.coalesce(F.length(F.regexp_replace(text, r"\s+", "")), F.lit(0)) > 0
    return F.map_filter(data, lambda key, value: filled(key) & filled(value))


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1)


def camel_case(name: str) -> str:
    head, *tail = name.lower().split("_")
    return head + "".join(part.capitalize() for part in tail)


def sorted_json(data: Column) -> Column:
    """A string map as JSON text with its keys in order, so equal maps give equal text."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(data))))
