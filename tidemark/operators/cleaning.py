"""Cleaning, per-file normalisation, deduplication and daily roll-up of trip-like rows."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_trips(trips: DataFrame, event_time: str, count: str, date_name: str) -> DataFrame:
    """Rows with an event time and a positive count, plus the calendar date."""
    kept = trips.where(F.col(event_time).isNotNull() & (F.col(count) > 0))
    return kept.withColumn(date_name, F.to_date(event_time))


def union_normalised(frames: Sequence[DataFrame], casts: Mapping[str, str]) -> DataFrame:
    """Cast the drifting columns of every frame first, then union by name."""
    normalised = [
        frame.withColumns({name: F.col(name).cast(sql_type) for name, sql_type in casts.items()}) for frame in frames
    ]
    return functools.reduce(lambda left, right: left.unionByName(right), normalised)


def dedupe(frame: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest in ``prefer`` order, then in the order of all columns.

    An aggregate instead of a ranking window, so copies of one key collapse before the shuffle.
    """
    ordered = list(prefer) + [name for name in frame.columns if name not in prefer]
    winner = F.min(F.struct(*ordered)).alias("winner")
    return frame.groupBy(*keys).agg(winner).select([F.col("winner")[name].alias(name) for name in frame.columns])


def mean(name: str, exact_type: str | None = None) -> Column:
    """Average; with a decimal ``exact_type`` the sum does not depend on row order."""
    if exact_type is None:
        return F.avg(name)
    value = F.col(name).cast(exact_type)
    return F.sum(value).cast("double") / F.count(value)


def daily_totals(
    frame: DataFrame, day: Column, value: str, count_name: str, mean_name: str, exact_type: str | None = None
) -> DataFrame:
    """Row count and mean per day."""
    return frame.groupBy(day).agg(F.count(F.lit(1)).alias(count_name), mean(value, exact_type).alias(mean_name))
