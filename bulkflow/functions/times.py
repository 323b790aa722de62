"""Wall-clock helpers on TIMESTAMP_NTZ columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS = "yyyy-MM-dd HH:mm:ss"
MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"


def format_seconds(ts: Column) -> Column:
    return F.date_format(ts, SECONDS)


def format_millis(ts: Column) -> Column:
    return F.date_format(ts, MILLIS)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds of a wall-clock time since 1970-01-01, independent of any time zone."""
    return F.timestamp_diff("MICROSECOND", _epoch(), ts)


def from_micros(amount: Column) -> Column:
    return F.timestamp_add("MICROSECOND", amount, _epoch())


def whole_second(ts: Column) -> Column:
    """Cut off the fraction of the second."""
    return from_micros(micros(ts) - F.pmod(micros(ts), F.lit(1_000_000)))


def parse_by(c: Column, fmt: str) -> Column:
    """Wall-clock time by format, NULL when the text does not match.

    The text is read as UTC, so gaps of the session's time zone cannot shift it.
    """
    instant = F.try_to_timestamp(F.concat(c, F.lit(" UTC")), F.lit(f"{fmt} VV"))
    return from_micros(F.unix_micros(instant))


def timestamp_or(c: Column, fallback: Column, fmt: str = SECONDS) -> Column:
    """Parse text by ``fmt``; ``fallback`` when it does not parse."""
    return F.coalesce(parse_by(c, fmt), fallback)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def plus_micros(ts: Column, amount: Column) -> Column:
    return F.timestamp_add("MICROSECOND", amount, ts)


def in_zone(ts: Column, zone: str = "Asia/Bangkok", source: str = "UTC") -> Column:
    """The wall clock of ``zone`` for a wall-clock time of ``source``."""
    return F.convert_timezone(F.lit(source), F.lit(zone), ts)
