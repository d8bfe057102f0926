"""Time buckets, keys and unit conversions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_millis(ntz: Column) -> Column:
    """Whole milliseconds since the epoch, rounded down (session zone UTC)."""
    return F.unix_millis(ntz.cast("timestamp"))


def epoch_seconds(ntz: Column) -> Column:
    """Whole seconds since the epoch, rounded down (session zone UTC)."""
    return F.unix_seconds(ntz.cast("timestamp"))


def from_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def minute_of(millis: Column) -> Column:
    """Start of the UTC minute an epoch-millisecond value falls in."""
    return F.date_trunc("minute", F.timestamp_millis(millis)).cast("timestamp_ntz")


def minute_key(prefix: str, minute: Column) -> Column:
    """Counter key of a minute, such as ``prefix:20260920T1117``."""
    return F.concat(F.lit(prefix + ":"), F.date_format(minute, "yyyyMMdd'T'HHmm"))


def usd(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def latency_millis(committed_ms: Column, produced_ms: Column) -> Column:
    """End-to-end latency; a producer clock ahead of ours counts as zero."""
    return F.greatest(F.lit(0).cast("long"), committed_ms - produced_ms)


def iso_instant(ntz: Column) -> Column:
    """UTC instant text with no, three or six fraction digits, as needed."""
    micros = F.unix_micros(ntz.cast("timestamp"))
    pattern = "yyyy-MM-dd'T'HH:mm:ss"
    return (
        F.when(micros % 1_000_000 == 0, F.date_format(ntz, pattern + "'Z'"))
        .when(micros % 1_000 == 0, F.date_format(ntz, pattern + ".SSS'Z'"))
        .otherwise(F.date_format(ntz, pattern + ".SSSSSS'Z'"))
    )
