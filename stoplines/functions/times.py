"""Feed times. All times are zone-less (TIMESTAMP_NTZ): a clock change never shifts them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTURY = 2000
FEED_ORDER = "YYMMDD"


def _two_digits(text: Column, order: str, part: str) -> Column:
    return F.substring(text, order.index(part) + 1, 2).try_cast("int")


def _make_time(text: Column, order: str, hour: Column, minute: Column) -> Column:
    return F.try_make_timestamp_ntz(
        F.lit(CENTURY) + _two_digits(text, order, "YY"),
        _two_digits(text, order, "MM"),
        _two_digits(text, order, "DD"),
        hour,
        minute,
        F.lit(0),
    )


def feed_time(text: Column, order: str = FEED_ORDER) -> Column:
    """Ten digits, a date in the given field order then HHMM, as a time. Anything else is NULL."""
    hour = F.substring(text, 7, 2).try_cast("int")
    minute = F.substring(text, 9, 2).try_cast("int")
    return F.when(F.length(text) == 10, _make_time(text, order, hour, minute))


def feed_text(time: Column, order: str = FEED_ORDER) -> Column:
    """A time as ten digits, the reverse of `feed_time`."""
    # not date_format, which would read a zone-less time in the session's zone; as one number, since texts take many times as long
    fields = {"YY": F.pmod(F.year(time), F.lit(100)), "MM": F.month(time), "DD": F.day(time)}
    scale, number = 10**8, F.hour(time) * 100 + F.minute(time)
    for i in range(0, len(order), 2):
        number = number + fields[order[i : i + 2]].cast("bigint") * scale
        scale //= 100
    return F.lpad(number.cast("string"), 10, "0")


def feed_date(text: Column) -> Column:
    """Six digits YYMMDD as a date. Anything else is NULL."""
    midnight = _make_time(text, FEED_ORDER, F.lit(0), F.lit(0))
    return F.when(F.length(text) == 6, midnight.cast("date"))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, halves rounded away from zero."""
    # Subtraction is zone-less; timestamp_diff would convert to the session's zone first.
    seconds = (end - start).cast("interval second").cast("decimal(20,6)").cast("double")
    return F.round(seconds / 60).cast("int")


def clock_seconds(time: Column) -> Column:
    """Seconds since midnight."""
    return F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
