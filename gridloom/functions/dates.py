"""Date expressions.  Timestamps are TIMESTAMP_NTZ; nothing depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _micros(a: Column, b: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", a, b).cast("double")


def decimal_year(ts: Column) -> Column:
    """Year plus the elapsed part; the year ends at 23:59:59 on December 31, so that second
    already reads as the next year."""
    first = F.make_timestamp_ntz(F.year(ts), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    last = F.make_timestamp_ntz(F.year(ts), F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59))
    return F.year(ts) + _micros(first, ts) / _micros(first, last)


def mid_date(one: Column, two: Column) -> Column:
    """Middle of two acquisitions, shifted by the first one's YYMMDD digits in microseconds."""
    half = F.floor(F.timestamp_diff("MICROSECOND", one, two) / 2)
    return F.timestamp_add("MICROSECOND", half + F.date_format(one, "yyMMdd").cast("long"), one)


def date_midpoint(one: Column, two: Column) -> Column:
    return F.date_add(one, F.floor(F.datediff(two, one) / 2).cast("int"))


def repaired_timestamp(text: Column) -> Column:
    """``20190215T205541T00:00:00`` loses its last part; null where nothing parses."""
    parts = F.split(text, "T")
    fixed = F.when(F.size(parts) == 3, F.concat_ws("T", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).otherwise(text)
    compact = F.try_to_timestamp(fixed, F.lit("yyyyMMdd'T'HHmmss"))
    day = F.try_to_timestamp(F.when(F.length(fixed) == 8, fixed), F.lit("yyyyMMdd"))
    return F.coalesce(compact, day, F.when(F.length(fixed) > 8, F.try_to_timestamp(fixed))).cast("timestamp_ntz")


def date_and_gap(centre: Column, days: Column) -> Column:
    """Centre date followed by the gap as a zero-padded number with one decimal."""
    return F.format_string("%s%07.1f", F.date_format(centre, "yyyyMMdd"), days)
