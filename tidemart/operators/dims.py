"""Dimension lookups."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.times import age_years


def lookup(facts: DataFrame, dim: DataFrame, on: Mapping[str, str],
           columns: Mapping[str, str]) -> DataFrame:
    """Left join facts to a dimension on one or more equalities.

    ``on`` maps fact columns to dimension columns, ``columns`` maps result columns to
    dimension columns.  A found row overwrites result columns the fact already has; a fact
    without a dimension row passes unchanged.  Keys of a dimension are unique.

    No side is hinted: Spark broadcasts a dimension it measures as small and otherwise
    shuffles both sides, where adaptive execution splits hot keys.
    """
    if not on:
        raise ValueError("a dimension lookup needs at least one equality")
    side = dim.select(
        *[F.col(column).cast("string").alias(f"_key{i}") for i, column in enumerate(on.values())],
        *[F.col(column).alias(f"_dim_{name}") for name, column in columns.items()],
        F.lit(True).alias("_found"))
    match = reduce(lambda a, b: a & b, (
        F.col(fact).cast("string") == F.col(f"_key{i}") for i, fact in enumerate(on)))
    joined = facts.join(side, match, "left")

    def result(name: str):
        kept = F.col(name) if name in facts.columns else F.lit(None)
        return F.when(F.col("_found"), F.col(f"_dim_{name}")).otherwise(kept).alias(name)

    added = [name for name in columns if name not in facts.columns]
    return joined.select(
        *[result(name) if name in columns else F.col(name) for name in facts.columns],
        *[result(name) for name in added])


def with_user(facts: DataFrame, users: DataFrame, as_of_ms: int) -> DataFrame:
    aged = users.select("id", "gender", age_years("birthday", as_of_ms).alias("age"))
    return lookup(facts, aged, {"user_id": "id"}, {"user_age": "age", "user_gender": "gender"})


def with_province(facts: DataFrame, provinces: DataFrame) -> DataFrame:
    return lookup(facts, provinces, {"province_id": "id"}, {
        "province_name": "name", "province_area_code": "area_code",
        "province_iso_code": "iso_code", "province_3166_2_code": "iso_3166_2"})


def product_dimension(skus: DataFrame, spus: DataFrame, trademarks: DataFrame,
                      categories: DataFrame) -> DataFrame:
    """The product snowflake as one table per sku, so facts are joined once, not four times."""
    wide = lookup(skus, spus, {"spu_id": "id"}, {"spu_name": "spu_name"})
    wide = lookup(wide, trademarks, {"tm_id": "id"}, {"tm_name": "tm_name"})
    wide = lookup(wide, categories, {"category3_id": "id"}, {"category3_name": "name"})
    return wide.select(
        "id", "sku_name", F.col("price").cast("decimal(18,2)").alias("price"),
        F.col("spu_id").cast("bigint").alias("spu_id"), "spu_name",
        F.col("tm_id").cast("bigint").alias("tm_id"), "tm_name",
        F.col("category3_id").cast("bigint").alias("category3_id"), "category3_name")


_PRODUCT = {name: name for name in (
    "sku_name", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")}


def with_product(facts: DataFrame, products: DataFrame, price: bool = False) -> DataFrame:
    columns = dict(_PRODUCT, sku_price="price") if price else _PRODUCT
    return lookup(facts, products, {"sku_id": "id"}, columns)
