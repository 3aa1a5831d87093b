"""Time-series rules over probe samples, evaluated on a regular grid of steps.

Samples are counted per step before any window is formed, so the windows hold one row per series
and step: their size is the covered time divided by the step, whatever the number of samples.
A step at time t covers (t - step, t]; a trailing range of k steps covers (t - k steps, t].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import trailing
from tidemark.session import shared_folder

MICROS = 1_000_000


def step_number(time: Column, step_seconds: int) -> Column:
    """Number of the step that closes at or just after a time."""
    micros = F.unix_micros(time.cast("timestamp"))
    return F.ceil(micros / F.lit(step_seconds * MICROS)).cast("long")


def step_time(step: Column, step_seconds: int) -> Column:
    return F.timestamp_micros(step * F.lit(step_seconds * MICROS)).cast("timestamp_ntz")


def _range_steps(window_seconds: int, step_seconds: int) -> int:
    if window_seconds % step_seconds:
        raise ValueError("the step must divide the window")
    return window_seconds // step_seconds


def counted_quantile(counts: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Interpolated quantile per group of (keys, _value, _n) rows, each value once per group.

    Null values do not count; a group of nulls alone has no row. The rows are range-partitioned by group
    and value, so a very large group lies on many tasks in order. Each task counts its own rows, the
    counts of the tasks before it (a row for each group and task) give the ranks. The ordered rows are
    stored once in the shared folder, as they are read for the sums and for the ranks.
    """
    spark = counts.sparkSession
    path = shared_folder(spark, "ranks")
    (
        counts.where(F.col("_value").isNotNull())
        .select(*keys, "_value", "_n")
        .repartitionByRange(*keys, "_value")
        .sortWithinPartitions(*keys, "_value")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33))
        .write.parquet(path)
    )
    ordered = spark.read.parquet(path)
    parts = ordered.groupBy(*keys, "_part").agg(F.sum("_n").alias("_in_part"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *keys,
        "_part",
        F.coalesce(F.sum("_in_part").over(earlier), F.lit(0)).alias("_before_part"),
        F.sum("_in_part").over(group).alias("samples"),
    )
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_part").orderBy("_place"))
    joined = ordered.withColumn("_upto", upto).alias("o").join(
        parts.alias("p"), [F.col(f"o.{name}").eqNullSafe(F.col(f"p.{name}")) for name in (*keys, "_part")]
    )
    end = F.col("_before_part") + F.col("_upto")
    position = F.lit(q) * (F.col("samples") - 1)

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((rank >= end - F.col("_n")) & (rank < end), F.col("_value").cast("double")))

    found = joined.groupBy(*[F.col(f"o.{name}").alias(name) for name in keys], "samples").agg(
        at_rank(F.floor(position)).alias("_lower"), at_rank(F.ceil(position)).alias("_upper")
    )
    between = (F.ceil(position) - position) * F.col("_lower") + (position - F.floor(position)) * F.col("_upper")
    whole = (F.col("_lower") == F.col("_upper")) | (position == F.floor(position))
    return found.select(*keys, F.when(whole, F.col("_lower")).otherwise(between).alias("quantile"), "samples")


def trailing_quantile(
    samples: DataFrame,
    series: str,
    time: str,
    value: str,
    q: float,
    window_seconds: int,
    step_seconds: int,
) -> DataFrame:
    """Interpolated quantile of the samples in the trailing window, at every step that has any.

    Equal values of one step are counted once, before anything is shuffled whole. A window is a rank search over
    these counts (``trailing.trailing_ranks``): no sample is copied into the windows that hold it, so a month at
    steps of a minute costs what a day does, but for its points. Null values do not count.
    """
    steps = _range_steps(window_seconds, step_seconds)
    known = samples.where(F.col(value).isNotNull())
    counted = known.groupBy(
        F.col(series).alias("_series"),
        step_number(F.col(time), step_seconds).alias("_step"),
        F.col(value).cast("double").alias("_value"),
    ).agg(F.count(F.lit(1)).alias("_n"))
    found = trailing.trailing_ranks(counted, steps, q)
    return found.select(
        F.col("_series").alias(series), step_time(F.col("_at"), step_seconds).alias("eval_time"), F.col("_quantile").alias("quantile"), "samples"
    )


def trailing_availability(
    scrapes: DataFrame, successes: DataFrame, series: str, time: str, window_seconds: int, step_seconds: int
) -> DataFrame:
    """Successful share of the scrapes in the trailing window, in percent, at every scraped step.

    A scrape without a success sample counts as failed, and a series without any sample as 0.
    The trailing sums are differences of running sums, linear in the number of steps.
    """
    steps = _range_steps(window_seconds, step_seconds)
    step = step_number(F.col(time), step_seconds).alias("_step")
    stacked = scrapes.select(series, step, F.lit(1).alias("scrape"), F.lit(0).alias("ok")).unionByName(
        successes.select(series, step, F.lit(0).alias("scrape"), F.lit(1).alias("ok"))
    )
    grid = stacked.groupBy(series, "_step").agg(F.sum("scrape").alias("scrape"), F.sum("ok").alias("ok"))

    ordered = Window.partitionBy(series).orderBy("_step")
    until_now = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = ordered.rangeBetween(Window.unboundedPreceding, -steps)
    running = grid.select(
        series, "_step", "scrape", F.sum("scrape").over(until_now).alias("_scrapes"), F.sum("ok").over(until_now).alias("_oks")
    )
    trailing = running.select(
        series,
        "_step",
        "scrape",
        (F.col("_scrapes") - F.coalesce(F.max("_scrapes").over(before), F.lit(0))).alias("scrapes"),
        (F.col("_oks") - F.coalesce(F.max("_oks").over(before), F.lit(0))).alias("successes"),
    )
    return trailing.where(F.col("scrape") > 0).select(
        series,
        step_time(F.col("_step"), step_seconds).alias("eval_time"),
        "successes",
        "scrapes",
        (F.col("successes") / F.col("scrapes") * 100).alias("availability"),
    )


def alert_runs(
    evaluations: DataFrame, series: str, time: str, condition: Column, hold_seconds: int, step_seconds: int
) -> DataFrame:
    """Alerts with a hold time: runs of consecutive steps where the condition holds.

    ``evaluations`` has at most one row per series and step; a missing step ends a run. A run is
    pending from its first step and fires once it has lasted ``hold_seconds``. Only runs that fire
    are returned.
    """
    true_steps = evaluations.where(condition).select(series, step_number(F.col(time), step_seconds).alias("_step"))
    rank = F.row_number().over(Window.partitionBy(series).orderBy("_step"))
    islands = true_steps.withColumn("_island", F.col("_step") - rank)
    runs = islands.groupBy(series, "_island").agg(
        F.min("_step").alias("_from"), F.max("_step").alias("_to"), F.count(F.lit(1)).alias("steps")
    )
    held = runs.where((F.col("_to") - F.col("_from")) * step_seconds >= hold_seconds)
    hold_steps = -(-hold_seconds // step_seconds)
    return held.select(
        series,
        step_time(F.col("_from"), step_seconds).alias("pending_from"),
        step_time(F.col("_from") + hold_steps, step_seconds).alias("firing_from"),
        step_time(F.col("_to"), step_seconds).alias("last_true"),
        "steps",
    )
