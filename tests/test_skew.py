"""Plans at scale: one key holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, checks, cleaning, events, multiset
from tidemark.session import session_settings

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": -1,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": -1,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": 1.5,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": 8,
}


def executed(frame) -> str:
    """Plan after adaptive execution; collecting runs it on the same object."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark, tmp_path):
    """30,000 rows in several files; a third has key 0."""
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"), F.lit("x" * 20).alias("pad")
    )
    frame.repartition(8).write.parquet(f"{tmp_path}/hot")
    return spark.read.parquet(f"{tmp_path}/hot")


def test_hot_target_key_is_split_in_a_merge(spark, hot):
    source = spark.range(500).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"), F.lit("y").alias("pad"))
    with session_settings(spark, SKEW):
        merged = changes.merge_upsert(hot, source, ["k"], ["v"])
        assert "skew=true" in executed(merged)
        assert merged.where("v = -1").count() == hot.where("k < 500").count() + source.join(hot, "k", "left_anti").count()


def test_hot_moment_is_split_in_sessions(spark, tmp_path):
    when = F.lit("2026-01-01").cast("timestamp_ntz")
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("u"),
        when.alias("t"),
        F.col("id").alias("i"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    frame.repartition(8).write.parquet(f"{tmp_path}/events")
    with session_settings(spark, SKEW):
        sessions = events.sessionize(spark.read.parquet(f"{tmp_path}/events"), "u", "t", "i")
        assert "skew=true" in executed(sessions)
        assert sessions.count() == 30_000 and sessions.where("new_session = 1").count() == 20_001


@pytest.mark.parametrize(
    "name, build",
    [
        ("dedupe", lambda f: cleaning.dedupe(f, ["k"])),
        ("keys", lambda f: checks.key_checks(f, ["k"], "k")),
        ("conflicts", lambda f: checks.conflicting_ids(f, ["k"])),
        ("multiset", lambda f: multiset.multiset_difference(f, f)),
        ("latest", lambda f: changes.latest_per_key(f, ["k"], ["v"])),
        ("fingerprint", multiset.fingerprint),
    ],
)
def test_groups_shrink_before_the_shuffle(hot, name, build):
    plan = build(hot)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_" not in plan
    for part in plan.split("Exchange hashpartitioning")[1:]:
        assert "partial_" in part or "Aggregate" in part.split("\n")[1], part.split("\n")[1]


def test_no_window_spans_a_whole_user(hot):
    frame = hot.select(F.col("k").alias("u"), F.timestamp_seconds("v").cast("timestamp_ntz").alias("t"), F.col("v").alias("i"))
    plan = events._session_moments(frame, "u", "t", "i", 1800)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows
    for line in windows:
        partition, order = line.rsplit("], [", 2)[1:]
        assert "day" in partition or order.startswith("day"), line
