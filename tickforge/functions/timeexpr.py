"""Time column expressions; naive timestamps are UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_ns(ts: Column) -> Column:
    return epoch_us(ts) * F.lit(1000)


def from_epoch_ns(ns: Column) -> Column:
    """Naive timestamp from epoch nanoseconds, floored to the microsecond."""
    return F.timestamp_micros(F.floor(ns.cast("decimal(20,0)") / F.lit(1000)).cast("long")).cast("timestamp_ntz")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (epoch_us(later) - epoch_us(earlier)) / F.lit(1e6)


def days_between(later: Column, earlier: Column) -> Column:
    return (epoch_us(later) - epoch_us(earlier)) / F.lit(86_400e6)


def naive(ts: Column) -> Column:
    """Drop the zone of a UTC timestamp."""
    return ts.cast("timestamp_ntz")


def compact_utc(ts: Column) -> Column:
    """20260601T100000Z form used in file names and manifests."""
    return F.date_format(ts.cast("timestamp"), "yyyyMMdd'T'HHmmss'Z'")


def week_index(ts: Column, start: Column) -> Column:
    """Whole weeks elapsed since ``start``."""
    return F.floor(F.floor(days_between(ts, start)) / F.lit(7)).cast("long")
