"""Frozen local days, offset-aware timestamps and stamps."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules

AWARE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:\d{2})$"


def daily_window(display_date: str) -> tuple[dt.datetime, dt.datetime]:
    """The complete local day before ``display_date`` as naive UTC bounds ``[since, until)``."""
    until = dt.datetime.combine(dt.date.fromisoformat(display_date), dt.time(), ZoneInfo(rules.ZONE))
    since = until - dt.timedelta(days=1)
    return tuple(t.astimezone(dt.timezone.utc).replace(tzinfo=None) for t in (since, until))


def in_daily_window(ts: Column, display_date: str) -> Column:
    """Bare comparisons against two constants, so the filter reaches the Parquet scan. ``ts`` is naive UTC."""
    since, until = (F.lit(str(bound)).cast("timestamp_ntz") for bound in daily_window(display_date))
    return (ts >= since) & (ts < until)


def aware(text: Column) -> Column:
    """The instant of an offset-aware ISO timestamp; NULL for naive or malformed text."""
    return F.when(text.rlike(AWARE), F.try_to_timestamp(text))


def display_date(ts: Column) -> Column:
    """Local calendar day of a naive UTC timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(rules.ZONE), ts))


def cycle_id(day: Column) -> Column:
    return F.concat(F.lit("daily-"), F.date_format(day, "yyyy-MM-dd"))


def iso_utc(ts: Column) -> Column:
    """ISO text with offset; the fraction appears only when it is not zero. ``ts`` is a TIMESTAMP, session zone UTC."""
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(fraction == ".000000", "").otherwise(fraction), F.lit("+00:00"))


def stamp(value: Column) -> Column:
    """A VARIANT stamp: epoch number to ISO text, nonblank text kept, anything else NULL."""
    kind = F.schema_of_variant(value)
    seconds = F.try_variant_get(value, "$", "decimal(38,6)")
    text = F.try_variant_get(value, "$", "string")
    return (F.when((kind == "STRING") & (F.length(F.trim(text)) > 0), text)
            .when((kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE") | (kind == "FLOAT"),
                  iso_utc(F.timestamp_micros((seconds * 1_000_000).cast("bigint")))))
