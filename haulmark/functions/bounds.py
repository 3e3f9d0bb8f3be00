"""Time bounds written as ``yyyy-MM-dd-kk-mm-ss-SSS`` (``kk``: hours 1-24, 24 being midnight; 0 is accepted too)."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BOUND = r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})-(\d{1,2})-(\d{1,2})-(\d{1,2})-(\d{1,3})\s*$"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def parse_bound(text: Column | str, tz: str = "UTC") -> Column:
    """Epoch milliseconds of a bound read in zone ``tz``; null if it cannot be read."""
    text = F.col(text) if isinstance(text, str) else text
    year, month, day, hour, minute, second, milli = (
        F.regexp_extract(text, _BOUND, i).try_cast("int") for i in range(1, 8)
    )
    local = F.try_make_timestamp_ntz(
        year, month, day, F.when(hour <= 24, hour % 24), minute, second.cast("decimal(8,6)")
    )
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), utc)
    return seconds * 1000 + milli


def bound_millis(text: str, tz: str = "UTC") -> int:
    """The same for a job parameter; an unreadable bound is an error, not "delete nothing"."""
    match = re.match(_BOUND, text)
    if not match:
        raise ValueError(f"not a time bound (yyyy-MM-dd-kk-mm-ss-SSS): {text!r}")
    year, month, day, hour, minute, second, milli = map(int, match.groups())
    if hour > 24:
        raise ValueError(f"hour out of range in {text!r}")
    local = datetime(year, month, day, hour % 24, minute, second, tzinfo=ZoneInfo(tz))
    return (local - _EPOCH) // timedelta(milliseconds=1) + milli


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds of a timestamp column; one without time zone is read as UTC, whatever the session's zone."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(name))
        return F.floor(micros / F.lit(1000).cast("decimal(4,0)")).cast("bigint")
    return F.unix_millis(F.col(name))


def moment(df: DataFrame, name: str, when: datetime) -> Column:
    """``when`` (UTC if it names no zone) as a constant to compare column ``name`` with."""
    aware = when if when.tzinfo else when.replace(tzinfo=timezone.utc)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.lit(aware.astimezone(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(aware)
