"""Time functions: text, epoch milliseconds and event time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text formats of the records and of the results.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"


def event_time(ms: Column | str) -> Column:
    """Epoch milliseconds as TIMESTAMP, the type a watermark needs."""
    return F.timestamp_millis(ms)


def day_text(ms: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(ms), DAY_FORMAT)


def second_text(moment: Column) -> Column:
    return F.date_format(moment, SECOND_FORMAT)


def parse_ms(text: Column | str, offset: str = "+00:00") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` read at a fixed offset, as epoch milliseconds.

    The offset is part of the call, so the result does not hang on the session zone.
    Text that is no time gives null.
    """
    column = F.col(text) if isinstance(text, str) else text
    return F.unix_millis(F.concat(column, F.lit(offset)).try_cast("timestamp"))


def parse_ms_plus8(text: Column | str) -> Column:
    return parse_ms(text, "+08:00")


def rowtime(ms: Column | str) -> Column:
    """Event time cut to whole seconds, as FROM_UNIXTIME(ms/1000) does."""
    return F.date_trunc("second", F.timestamp_millis(ms))


def tumbling(moment: Column | str, size: str) -> Column:
    return F.window(moment, size)


def age_years(birthday: Column | str, as_of_ms: int) -> Column:
    """Years of 365 days between a ``yyyy-MM-dd`` birthday and a moment, cut toward zero."""
    column = F.col(birthday) if isinstance(birthday, str) else birthday
    born = F.unix_millis(F.concat(column, F.lit(" 00:00:00+00:00")).try_cast("timestamp"))
    elapsed = F.lit(as_of_ms).cast("bigint") - born
    return F.call_function("div", elapsed, F.lit(365 * 86_400_000).cast("bigint")).cast("int")
