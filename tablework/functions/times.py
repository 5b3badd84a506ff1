"""Naive-timestamp expressions (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def run_time(now: Column | str | None) -> Column:
    """The run's "now": a parameter when given, so that runs can be repeated."""
    if now is None:
        return F.current_timestamp().cast(NTZ)
    return (F.lit(now) if isinstance(now, str) else now).cast(NTZ)


def naive_utc(text: Column) -> Column:
    """Text to a naive UTC timestamp, NULL when unreadable.

    Text with a zone or offset is moved to UTC, text without one is taken as it
    is, whatever the zone of the session.
    """
    zoned = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast(NTZ)
    )
    has_zone = text.rlike(r"[T ].*(Z|[+-]\d{2}:?\d{2})$")
    return F.when(has_zone, zoned).otherwise(text.try_cast(NTZ))


def iso_timestamp(text: Column | str, fallback: Column) -> Column:
    """ISO-8601 text to a naive UTC timestamp; anything unreadable becomes ``fallback``."""
    value = F.col(text) if isinstance(text, str) else text
    dated = F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}"), value)
    return F.coalesce(naive_utc(dated), fallback.cast(NTZ))


def floor_millis(ts: Column | str) -> Column:
    return F.date_trunc("millisecond", ts).cast(NTZ)


def day_key(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")
