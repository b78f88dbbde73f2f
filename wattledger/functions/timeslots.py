"""Epoch-second arithmetic on 5-minute slots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger.schema import SLOT_SECONDS


def epoch_seconds(timestamp: Column) -> Column:
    """Whole seconds of a fractional epoch, truncated toward zero; NULL when out of range."""
    return timestamp.try_cast("bigint")


def slot_floor(ts: Column, freq: int = SLOT_SECONDS) -> Column:
    """Start of the slot. `%` keeps the sign, so negative times truncate toward zero."""
    return ts - ts % F.lit(freq).cast("bigint")


def slot_nearest(ts: Column, freq: int = SLOT_SECONDS) -> Column:
    """Nearest slot boundary; the half-way point goes up."""
    step = F.lit(freq).cast("bigint")
    rest = ts % step
    up = (ts + rest) - (ts + rest) % step
    return F.when(rest < freq // 2, ts - rest).otherwise(up)


def iso_utc(epoch: Column) -> Column:
    """ISO-8601 instant text. Needs the UTC session time zone."""
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_date(epoch: Column) -> Column:
    """Calendar day in UTC, independent of the session time zone."""
    days = (epoch - F.pmod(epoch, F.lit(86400).cast("bigint"))) / F.lit(86400)
    return F.date_from_unix_date(days.cast("int"))
