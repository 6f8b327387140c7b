"""Time expressions that never depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def utc_ntz(ts: Column, dtype: T.DataType) -> Column:
    """A timestamp as UTC wall-clock time; a zone-less timestamp is UTC already."""
    if isinstance(dtype, T.TimestampNTZType):
        return ts
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(EPOCH))
    raise TypeError(f"not a timestamp: {dtype.simpleString()}")


def epoch_s(ntz: Column) -> Column:
    """Whole seconds since 1970, from the parts of the wall-clock time.

    Spark's timestamp difference would read both ends in the session zone and count its clock changes.
    """
    day = F.unix_date(ntz.cast("date")).cast("bigint")
    return day * 86_400 + F.hour(ntz) * 3_600 + F.minute(ntz) * 60 + F.second(ntz)


def epoch_ms(ntz: Column) -> Column:
    fraction = F.date_part(F.lit("SECOND"), ntz) - F.second(ntz)
    return epoch_s(ntz) * 1_000 + F.floor(fraction * 1_000).cast("bigint")


def day_text(ntz: Column) -> Column:
    return ntz.cast("date").cast("string")


def hour_text(ntz: Column) -> Column:
    return F.lpad(F.hour(ntz).cast("string"), 2, "0")


def window_start_ms(date: Column, hour: Column) -> Column:
    """Epoch ms of ``YYYY-MM-DD`` plus ``HH`` in UTC, null where they are not a valid hour."""

    def part(text: Column, start: int, length: int) -> Column:
        return F.substring(text, start, length).try_cast("int")

    start = F.try_make_timestamp_ntz(
        part(date, 1, 4), part(date, 6, 2), part(date, 9, 2), hour.try_cast("int"), F.lit(0), F.lit(0)
    )
    shaped = (F.length(date) == 10) & (F.length(hour) == 2)
    start_ms = F.unix_date(start.cast("date")).cast("bigint") * 86_400_000 + hour.try_cast("int") * 3_600_000
    return F.when(shaped, start_ms)


def window_ms(date: Column, hour: Column, minutes: int = 60) -> tuple[Column, Column]:
    start = window_start_ms(date, hour)
    return start, start + F.lit(minutes * 60_000).cast("bigint")
