"""Second/nanosecond pairs and Spark timestamps.

Spark timestamps end at microseconds, so the pair stays in two BIGINT columns and a TIMESTAMP is
derived only for windows and display.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_ts(sec: Column, ns: Column) -> Column:
    """TIMESTAMP of a pair, cut to microseconds."""
    return F.timestamp_micros(sec * 1_000_000 + F.floor(ns / F.lit(1000)).cast("bigint"))


def epoch_micros(ts: Column, ntz: bool = False) -> Column:
    """Microseconds since the epoch; a TIMESTAMP_NTZ column is read as UTC."""
    if ntz:
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)
    return F.unix_micros(ts)


def split_ts(ts: Column, ntz: bool = False) -> tuple[Column, Column]:
    """(seconds, nanoseconds) of a timestamp column, integer arithmetic only."""
    micros = epoch_micros(ts, ntz)
    ns = F.pmod(micros, F.lit(1_000_000).cast("bigint"))
    # The division is exact: both sides are whole and the quotient fits a double.
    sec = ((micros - ns) / F.lit(1_000_000)).cast("bigint")
    return sec, ns * 1000


def split_seconds(seconds: Column) -> tuple[Column, Column]:
    """(seconds, nanoseconds) of floating seconds: whole part, and the fraction in whole nanoseconds."""
    sec = seconds.cast("bigint")
    return sec, ((seconds - sec) * 1e9).cast("bigint")


def header_seconds(global_timestamp: Column) -> Column:
    """Seconds of a header timestamp, which may be called `sec` or `epoch`."""
    return F.coalesce(global_timestamp["sec"], global_timestamp["epoch"])


def time_since(last_event: Column, now: Column) -> Column:
    """Age of the last event as an interval, NULL when there was none."""
    return now - last_event


def age_seconds(last_event: Column, now: Column) -> Column:
    """Age in whole seconds."""
    return F.timestamp_diff("SECOND", last_event, now)
