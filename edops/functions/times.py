"""UTC time expressions (the session time zone is UTC)."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, functions as F

# Date, optionally with time of day and zone. Bare years and month names are refused.
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:\d{2})?)?$"


def parse_utc(text: Column) -> Column:
    """ISO-8601 text to timestamp: ``Z`` and offsets converted, no zone means UTC."""
    return F.when(text.rlike(_ISO), F.try_to_timestamp(text))


def iso_utc(ts: Column) -> Column:
    """Timestamp to ISO-8601 text with ``Z``; microseconds only when there are any."""
    whole = F.unix_micros(ts) % F.lit(1_000_000) == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )


def minutes_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)).cast("double") / F.lit(6e7)


def from_micros(micros: int | None) -> Column:
    """Timestamp of a driver-side value, whatever time zone the driver runs in."""
    return F.timestamp_micros(F.lit(micros).cast("long"))


def utc_literal(moment: datetime) -> Column:
    """A driver-side time as a timestamp; without a zone it is taken as UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=UTC)
    since = aware - datetime(1970, 1, 1, tzinfo=UTC)
    return from_micros((since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds)
