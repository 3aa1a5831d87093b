"""Numeric, time, text and digest expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole-second distance; each side is floored to its second before subtracting."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def elapsed_floor_seconds(start: Column, end: Column) -> Column:
    """floor((end - start) in seconds); negative when ``end`` precedes ``start``."""
    return F.floor(F.timestamp_diff("MILLISECOND", start, end) / F.lit(1000)).cast("long")


def ratio9(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as decimal(38,9), HALF_UP, null when the denominator is not positive."""
    exact = F.round(numerator.cast("decimal(28,9)") / denominator.cast("decimal(19,0)"), 9)
    return F.when(denominator > 0, exact.cast("decimal(38,9)"))


def whole9(number: Column) -> Column:
    return number.cast("decimal(38,9)")


def utc_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_wall(timestamp: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session's time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), timestamp.cast("timestamp_ntz"))


def sha256_lines(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts joined by a newline."""
    return F.sha2(F.concat_ws("\n", *[part.cast("string") for part in parts]), 256)


def fixed_decimal_text(number: Column, scale: int) -> Column:
    return number.cast(f"decimal(38,{scale})").cast("string")


def plain_decimal_text(number: Column) -> Column:
    """Decimal text without an exponent, trailing zeros or a dangling point."""
    written = number.cast("string")
    text = F.when(written.rlike("[eE]"), written.cast("decimal(38,18)").cast("string")).otherwise(written)
    trimmed = F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(text.contains("."), trimmed).otherwise(text)


def portable_hash(*columns: Column) -> Column:
    """Signed 60-bit row hash taken from sha256, so that other engines can recompute it.

    Nulls are spelled out, so that null and the empty text differ.
    """
    text = F.concat_ws("\u001f", *[F.coalesce(column.cast("string"), F.lit("\u0000")) for column in columns])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")
