"""Log layer: parse, dirty branch, new-user repair, split into pages, starts, displays."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.functions.records import with_evaluated
from tidemart.operators.keyed import first_per_key
from tidemart.schemas import LOG

_PARSED = T.StructType(LOG.fields + [T.StructField("_corrupt", T.StringType())])


def parse_strict(raw: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse JSON text and fail the job on a malformed record."""
    rest = [name for name in raw.columns if name != value]
    record = F.from_json(value, schema, {"mode": "FAILFAST"})
    return with_evaluated(raw, "_record", record).select("_record.*", *rest)


def parse_logs(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse log text, keeping the text and why a record cannot be used.

    ``problem`` is null for a usable record, ``malformed`` when the text is not the
    declared JSON, ``missing_key`` when device or time is absent: such a record could
    only be grouped under a null key.
    """
    rest = [name for name in raw.columns if name != value]
    parsed = with_evaluated(raw, "_record", F.from_json(
        value, _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    record = F.col("_record")
    problem = (F.when(record.isNull() | record["_corrupt"].isNotNull(), "malformed")
                .when(record["common"]["mid"].isNull() | record["ts"].isNull(), "missing_key"))
    return parsed.select(
        *[record[field.name].alias(field.name) for field in LOG.fields],
        *rest, F.col(value).alias("_raw"), problem.alias("problem"))


def clean_logs(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).drop("_raw", "problem")


def dirty_logs(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull()).select(
        *[name for name in ("seq",) if name in parsed.columns],
        F.col("_raw").alias("raw"), "problem")


def repair_new_users(logs: DataFrame) -> DataFrame:
    """Per device only the first record that claims a new user keeps the claim.

    Needs ``ts`` and ``seq``, which together identify a record of a device.  Records that
    claim an old user are never shuffled.  The claims are joined on device, time and
    sequence, so the rows of a hot device spread over all partitions.
    """
    claims = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    fresh, settled = logs.filter(claims), logs.filter(~claims)
    firsts = first_per_key(
        fresh.select(F.col("common.mid").alias("_mid"), F.col("ts").alias("_ts"),
                     F.col("seq").alias("_seq")),
        ["_mid"], ["_ts", "_seq"])
    joined = fresh.join(
        firsts,
        (F.col("common.mid") == F.col("_mid")) & (F.col("ts") == F.col("_ts"))
        & (F.col("seq") == F.col("_seq")), "left")
    flag = F.when(F.col("_mid").isNull(), "0").otherwise("1")
    repaired = joined.withColumn("common", F.col("common").withField("is_new", flag))
    return repaired.select(*logs.columns).unionByName(settled)


def _is_start():
    return F.coalesce(F.length("start"), F.lit(0)) > 0


def split_starts(logs: DataFrame) -> DataFrame:
    return logs.filter(_is_start())


def split_pages(logs: DataFrame) -> DataFrame:
    return logs.filter(~_is_start())


def split_displays(logs: DataFrame) -> DataFrame:
    """One row per displayed element of a page record, with the page it was shown on.

    Device and time of the page are not carried over.
    """
    return (logs.filter(~_is_start())
                .select(F.col("page.page_id").alias("page_id"),
                        F.explode("displays").alias("_display"))
                .select("_display.item", "_display.item_type", "page_id"))
