"""Nested event flattening and gap sessionisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.predicates import parse_event_time
from tidemark.session import shared_folder

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("actor_login", T.StringType(), False),
        T.StructField("repo_name", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

SESSION_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields
    + [
        T.StructField("previous_created_at", T.TimestampType(), True),
        T.StructField("new_session", T.IntegerType(), False),
        T.StructField("session_id", T.LongType(), False),
    ]
)

SESSION_GAP_SECONDS = 1800
SECONDS_PER_DAY = 86400
COPIES_PER_TASK = 100_000


def flatten_columns(frame: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Project nested fields: ``{"actor_login": "actor.login"}``."""
    return frame.select([F.col(path).alias(name) for name, path in paths.items()])


def flatten_events(source: DataFrame) -> DataFrame:
    """Flat events from nested ones; an illegal time becomes null and is caught by the checks."""
    flat = flatten_columns(
        source,
        {
            "id": "id",
            "type": "type",
            "actor_login": "actor.login",
            "repo_name": "repo.name",
            "created_at": "created_at",
        },
    )
    return flat.withColumn("created_at", parse_event_time(F.col("created_at")))


def type_histogram(events: DataFrame, column: str = "type") -> DataFrame:
    return events.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))


def expand_copies(
    frame: DataFrame, count: str, number: str | None = None, per_task: int = COPIES_PER_TASK
) -> DataFrame:
    """Repeat every row ``count`` times, spreading a huge count over many tasks.

    ``number`` names a column for the copy's number, from 1.
    """
    names = [name for name in frame.columns if name != count]
    blocks = frame.where(F.col(count) > 0).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / per_task)))
    )
    spread = blocks.repartition(*names, "_block")
    first = F.col("_block") * per_task + 1
    last = F.least(first + (per_task - 1), F.col(count))
    copies = spread.withColumn(number or "_copy", F.explode(F.sequence(first, last)))
    return copies.select(*names, *([number] if number else []))


def _session_moments(events: DataFrame, user: str, time: str, order: str, gap_seconds: int) -> DataFrame:
    """One row per (user, timestamp): its first event, previous timestamp, new-session flag, session.

    Rows of one second never start a session among themselves, so sessions are decided on seconds.
    The order is carried in three levels, each with a bounded window: timestamps inside a second,
    seconds inside a day, days of a user. No window holds a user's whole history.
    """
    copies = events.groupBy(user, time, order).agg(F.count(F.lit(1)).alias("copies"))
    moments = (
        copies.groupBy(user, time)
        .agg(F.min(F.struct(order, "copies")).alias("first"))
        .select(
            user,
            time,
            F.col("first")[order].alias("first_order"),
            F.col("first")["copies"].alias("first_copies"),
            F.unix_timestamp(time).alias("second"),
        )
        .withColumn("day", F.floor(F.col("second") / SECONDS_PER_DAY))
    )

    inside_second = Window.partitionBy(user, "day", "second").orderBy(time)
    moments = moments.withColumn("prev_inside", F.lag(time).over(inside_second))

    seconds = moments.groupBy(user, "day", "second").agg(F.max(time).alias("last_time"))
    inside_day = Window.partitionBy(user, "day").orderBy("second")
    prev_second = F.lag("second").over(inside_day)
    seconds = (
        seconds.withColumn("prev_time_in_day", F.lag("last_time").over(inside_day))
        .withColumn("starts_in_day", (F.col("second") - prev_second > gap_seconds).cast("int"))
        .withColumn("rank_in_day", F.sum("starts_in_day").over(inside_day.rowsBetween(Window.unboundedPreceding, 0)))
    )

    days = seconds.groupBy(user, "day").agg(
        F.min("second").alias("first_second"),
        F.max("second").alias("last_second"),
        F.max("last_time").alias("day_last_time"),
        F.coalesce(F.sum("starts_in_day"), F.lit(0)).alias("starts_inside"),
    )
    over_days = Window.partitionBy(user).orderBy("day")
    days = (
        days.withColumn("prev_day_time", F.lag("day_last_time").over(over_days))
        .withColumn(
            "day_starts",
            F.coalesce((F.col("first_second") - F.lag("last_second").over(over_days) > gap_seconds).cast("int"), F.lit(1)),
        )
        .withColumn("inclusive", F.sum(F.col("day_starts") + F.col("starts_inside")).over(over_days))
        .select(user, "day", "prev_day_time", "day_starts", (F.col("inclusive") - F.col("starts_inside")).alias("base"))
    )

    seconds = seconds.join(days, [user, "day"]).select(
        user,
        "day",
        "second",
        F.coalesce("prev_time_in_day", "prev_day_time").alias("prev_before"),
        F.coalesce("starts_in_day", "day_starts").alias("second_starts"),
        (F.col("base") + F.coalesce("rank_in_day", F.lit(0))).alias("session_id"),
    )
    return moments.join(seconds, [user, "day", "second"]).select(
        F.col(user).alias("_user"),
        F.col(time).alias("_time"),
        "first_order",
        "first_copies",
        F.coalesce("prev_inside", "prev_before").alias("_previous"),
        F.when(F.col("prev_inside").isNull(), F.col("second_starts")).otherwise(F.lit(0)).cast("int").alias("_starts"),
        F.col("session_id").cast("long").alias("session_id"),
    )


def sessionize(
    events: DataFrame,
    user: str = "actor_login",
    time: str = "created_at",
    order: str = "id",
    gap_seconds: int = SESSION_GAP_SECONDS,
    previous_name: str = "previous_created_at",
) -> DataFrame:
    """Add the previous event time, a new-session flag and a running session number per user.

    Order is (time, order). A session starts at a user's first event and after a gap of more than
    ``gap_seconds`` whole seconds. Exact copies are kept: one of them carries the flag. ``order``
    identifies an event, so rows sharing it are copies of one another. A null user, time or order
    breaks the event contract and fails the job.

    The moments, a narrow table, are computed once and written to the shared folder. They join back
    on (user, time): by broadcast where their files are small, else through a plain shuffle of both
    sides, a shape adaptive execution can split when one moment holds very many events.
    """
    spark = events.sparkSession
    for name in (user, time, order):
        message = F.raise_error(F.lit(f"{name} must not be null"))
        events = events.withColumn(name, F.when(F.col(name).isNull(), message).otherwise(F.col(name)))
    path = shared_folder(spark, "moments")
    _session_moments(events, user, time, order, gap_seconds).write.parquet(path)
    moments = spark.read.parquet(path)

    at_moment = [F.col(user) == F.col("_user"), F.col(time) == F.col("_time")]
    is_first = F.col(order) == F.col("first_order")
    columns = list(events.columns)

    def annotated(frame: DataFrame, leads: Column) -> DataFrame:
        return frame.select(
            *columns,
            F.when(leads, F.col("_previous")).otherwise(F.col(time)).alias(previous_name),
            F.when(leads, F.col("_starts")).otherwise(F.lit(0)).alias("new_session"),
            "session_id",
        )

    joined = events.join(moments, at_moment)
    copied = F.col("first_copies") > 1
    if moments.where(copied).isEmpty():
        return annotated(joined, is_first)

    # Exactly one copy of a repeated first event carries its flag.
    stacked = (
        events.join(moments.where(copied), [*at_moment, is_first])
        .groupBy(*columns, "_previous", "_starts", "session_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    numbered = expand_copies(stacked, "_n", number="_copy")
    single = joined.where(~(is_first & copied))
    return annotated(single, is_first).unionByName(annotated(numbered, F.col("_copy") == 1))


def sessions_per_user(sessions: DataFrame, user: str = "actor_login") -> DataFrame:
    return (
        sessions.groupBy(user)
        .agg(F.countDistinct("session_id").alias("sessions"))
        .orderBy(F.desc("sessions"), F.asc(user))
    )
