"""Timestamps that arrive as epoch seconds, epoch milliseconds or ISO text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MILLIS_ABOVE = 10_000_000_000
LAST_SECOND = 253_402_300_799  # 9999-12-31T23:59:59Z
ISO_FORM = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


def _stripped(value: Column) -> Column:
    return F.trim(F.coalesce(value.cast("string"), F.lit("")))


def parse_timestamp(value: Column) -> Column:
    """The instant, cut to whole seconds; NULL for text that is no timestamp. Naive text is read
    in the session zone, so sessions run in UTC."""
    text = _stripped(value)
    digits = text.try_cast("bigint")
    seconds = F.when(digits > MILLIS_ABOVE, F.call_function("div", digits, F.lit(1000))).otherwise(digits)
    from_epoch = F.when(seconds <= LAST_SECOND, F.timestamp_seconds(seconds))
    from_iso = F.date_trunc("second", F.replace(text, F.lit("Z"), F.lit("+00:00")).try_cast("timestamp"))
    return F.when(text.rlike(r"^\d+$"), from_epoch).when(text.rlike(ISO_FORM), from_iso)


def iso_utc(instant: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def normalize_timestamp(value: Column) -> Column:
    """`yyyy-MM-ddTHH:mm:ssZ`; missing gives "" and unparseable text comes back unchanged."""
    return F.coalesce(iso_utc(parse_timestamp(value)), _stripped(value))
