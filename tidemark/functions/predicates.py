"""Row predicates. Every function returns a Column and stays inside generated code."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one accepted text form of an event time, as a Spark pattern and a regex.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
EVENT_TIME_REGEX = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"

MAX_DOUBLE = 1.7976931348623157e308


def any_of(conditions: Iterable[Column]) -> Column:
    return functools.reduce(operator.or_, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return functools.reduce(operator.and_, conditions)


def is_true(condition: Column) -> Column:
    """Three-valued logic folded to two: an unknown outcome counts as false."""
    return F.coalesce(condition, F.lit(False))


def is_finite(name: str) -> Column:
    value = F.col(name)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) <= F.lit(MAX_DOUBLE))


def any_null(names: Iterable[str]) -> Column:
    return any_of(F.col(name).isNull() for name in names)


def any_blank(names: Iterable[str]) -> Column:
    return any_of(F.col(name).isNull() | (F.length(F.trim(F.col(name))) == 0) for name in names)


def positive_within(positive: str, bounded: str, low: float, high: float, require_finite: bool = True) -> Column:
    """Validity rule: ``positive`` > 0 and ``bounded`` in [low, high].

    ``require_finite=False`` gives the exploratory form, in which NaN and infinity pass ``> 0``.
    """
    rule = (F.col(positive) > F.lit(0.0)) & F.col(bounded).between(F.lit(float(low)), F.lit(float(high)))
    if require_finite:
        rule = is_finite(positive) & is_finite(bounded) & rule
    return is_true(rule)


def parse_event_time(text: Column) -> Column:
    """Timestamp of a canonical UTC whole-second text; null for anything unparsable."""
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_PATTERN))


def is_canonical_event_time(text: Column) -> Column:
    """True when the text has the exact form and survives parsing and formatting unchanged."""
    parsed = parse_event_time(text)
    return is_true(text.rlike(EVENT_TIME_REGEX) & (F.date_format(parsed, EVENT_TIME_PATTERN) == text))
