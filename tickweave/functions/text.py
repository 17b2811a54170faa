"""Text layouts used by the readers and the result lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the text formats
DATE_TIME = "MM/dd/yyyy HH:mm:ss"
DATE_COMMA_TIME = "MM/dd/yyyy,HH:mm:ss"


def parse_instant(date: Column, time: Column) -> Column:
    """Strict month-first date and time; null when malformed."""
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(DATE_TIME)).cast("timestamp_ntz")


def format_instant(ts: Column) -> Column:
    return F.date_format(ts, DATE_COMMA_TIME)


def six_decimals(value: Column) -> Column:
    """Up to six decimals, half-even on the decimal text, no trailing zeros."""
    fixed = F.bround(value.cast("decimal(38,18)"), 6).cast("decimal(38,6)").cast("string")
    return F.regexp_replace(fixed, r"\.?0+$", "")


def field(parts: Column, index: int) -> Column:
    """Array element by position, null when absent."""
    return F.get(parts, F.lit(index))
