import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import checks, events
from tidemark.plans import applications
from tidemark.sources import tables

T0 = datetime.datetime(2026, 1, 1)


def at(seconds, micros=0):
    return T0 + datetime.timedelta(seconds=seconds, microseconds=micros)


def flat(spark, rows):
    return spark.createDataFrame(
        [(i, "PushEvent", actor, "r", when) for i, actor, when in rows],
        "id string, type string, actor_login string, repo_name string, created_at timestamp_ntz",
    )


def by_plain_window(frame, user="actor_login", time="created_at", order="id", gap=1800):
    """The definition: windows over whole users."""
    ordered = Window.partitionBy(user).orderBy(time, order)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = F.col("previous_created_at")
    return (
        frame.withColumn("previous_created_at", F.lag(time).over(ordered))
        .withColumn("new_session", (previous.isNull() | (F.unix_timestamp(time) - F.unix_timestamp(previous) > gap)).cast("int"))
        .withColumn("session_id", F.sum("new_session").over(running))
    )


BOUNDARY = [("b", "alice", at(0)), ("a", "alice", at(0)), ("c", "alice", at(1800)), ("d", "alice", at(3601)), ("e", "bob", at(14400))]


@pytest.mark.parametrize("order", [1, -1])
def test_session_boundaries(spark, rows, order):
    sessions = events.sessionize(flat(spark, BOUNDARY[::order]))
    assert rows(sessions, "id", "new_session", "session_id") == [
        ("a", 1, 1), ("b", 0, 1), ("c", 0, 1), ("d", 1, 2), ("e", 1, 1),
    ]
    assert sessions.columns[-3:] == ["previous_created_at", "new_session", "session_id"]


def test_identical_copies_are_kept_with_one_flag(spark, rows):
    sessions = events.sessionize(flat(spark, [("a", "x", at(5))] * 4 + [("b", "x", at(5))]))
    found = rows(sessions, "id", "previous_created_at", "new_session", "session_id")
    assert found == [("a", None, 1, 1), ("a", at(5), 0, 1), ("a", at(5), 0, 1), ("a", at(5), 0, 1), ("b", at(5), 0, 1)]


@pytest.mark.parametrize("seed", range(4))
def test_sessions_equal_the_plain_window_on_skewed_rows(spark, rows, seed):
    """A third of the rows sits on one user and one moment; copies, ties, fractions and long gaps occur."""
    rng = random.Random(seed)
    sample = []
    for number in range(300):
        user = "hot" if rng.random() < 0.5 else rng.choice("abc")
        when = at(86395) if rng.random() < 0.3 else at(rng.choice([0, 1, 1799, 1800, 1801, 3601, 86399, 86400, 90000, 260000]) + rng.randrange(3), rng.choice([0, 0, 5, 999999]))
        sample.append((f"{number:03d}", user, when))
    sample += rng.choices(sample, k=60)
    frame = flat(spark, sample)
    sessions = events.sessionize(frame)
    assert rows(sessions) == rows(by_plain_window(frame))


def test_expand_copies_splits_large_counts(spark, rows):
    frame = spark.createDataFrame([("a", 25), ("b", 1), ("c", 0)], "k string, n long")
    expanded = events.expand_copies(frame, "n", per_task=10)
    assert rows(expanded.groupBy("k").count()) == [("a", 25), ("b", 1)]
    numbered = events.expand_copies(frame, "n", number="c", per_task=10)
    assert rows(numbered.groupBy("k").agg(F.min("c"), F.max("c"), F.countDistinct("c"))) == [("a", 1, 25, 25), ("b", 1, 1, 1)]


def test_session_checks_accept_and_reject(spark, violations):
    frame = flat(spark, BOUNDARY * 2)
    sessions = events.sessionize(frame).cache()
    args = ("actor_login", "created_at", "previous_created_at", 1800)
    assert set(violations(checks.session_checks(sessions, frame, *args)).values()) == {0}
    shifted = sessions.withColumn("session_id", F.col("session_id") + 1)
    assert violations(checks.session_checks(shifted, frame, *args))["session_number_gap"] > 0
    merged = sessions.withColumn("new_session", F.lit(0))
    assert violations(checks.session_checks(merged, frame, *args))["flag_disagrees_with_gap"] > 0
    unlinked = sessions.withColumn("previous_created_at", F.lit(T0).cast("timestamp_ntz"))
    assert violations(checks.session_checks(unlinked, frame, *args))["previous_chain_broken"] > 0
    assert violations(checks.session_checks(shifted, frame, *args))["sessions_differ"] > 0
    lost = sessions.where("id <> 'e'")
    assert violations(checks.session_checks(lost, frame, *args))["event_rows_changed"] == 2


def test_session_checks_reject_what_only_another_derivation_finds(spark, violations):
    """A time that names itself as its previous one, and a flag on the wrong one of two tied events."""
    frame = flat(spark, [("1", "u", at(0)), ("2", "u", at(10)), ("3", "u", at(20)), ("4", "v", at(0)), ("5", "v", at(0))])
    sessions = events.sessionize(frame)
    args = (frame, "actor_login", "created_at", "previous_created_at", 1800)
    assert violations(checks.session_checks(sessions, *args))["sessions_differ"] == 0
    later = F.col("created_at")
    itself = F.when(F.col("id") == "2", later).when(F.col("id") == "3", F.lit(at(0)).cast("timestamp_ntz"))
    wrong = sessions.withColumn("previous_created_at", F.coalesce(itself, F.col("previous_created_at")))
    assert violations(checks.session_checks(wrong, *args))["sessions_differ"] > 0
    swapped = sessions.withColumn("id", F.translate("id", "45", "54"))
    assert violations(checks.session_checks(swapped, *args))["sessions_differ"] > 0


def test_sessionize_refuses_rows_without_a_key(spark):
    for missing in ((None, "u", at(0)), ("1", None, at(0)), ("1", "u", None)):
        with pytest.raises(Exception, match="must not be null"):
            events.sessionize(flat(spark, [("0", "u", at(5)), missing])).collect()


def nested(spark, records):
    return spark.createDataFrame(
        records, "id string, type string, actor struct<login:string>, repo struct<name:string>, created_at string"
    )


def record(i="1", kind="PushEvent", login="octocat", repo="r", when="2026-01-01T00:00:00Z"):
    return (i, kind, (login,), (repo,), when)


def test_flatten_and_contract(spark, violations, rows):
    flat_events = events.flatten_events(nested(spark, [record(), record()]))
    assert rows(flat_events, "actor_login", "repo_name") == [("octocat", "r")] * 2
    assert set(violations(checks.event_checks(flat_events)).values()) == {0}
    exact = checks.impose_schema(flat_events, events.EVENT_SCHEMA)
    checks.require_exact_schema(exact, events.EVENT_SCHEMA)


@pytest.mark.parametrize("text", ["2026-01-01T00:00:00", "2026-01-01 00:00:00Z", "2026-02-30T00:00:00Z", "2026-01-01T00:00:00.5Z", None])
def test_bad_times_are_caught(spark, violations, text):
    flat_events = events.flatten_events(nested(spark, [record(when=text)]))
    assert violations(checks.event_checks(flat_events))["time_null"] == 1
    with pytest.raises(Exception, match="null in required column created_at"):
        checks.impose_schema(flat_events, events.EVENT_SCHEMA).collect()


def test_conflicting_and_blank_ids(spark, violations):
    frame = events.flatten_events(nested(spark, [record(), record(kind="WatchEvent"), record(i="2", login="  ")]))
    found = violations(checks.event_checks(frame))
    assert found["conflicting_ids"] == 1 and found["text_blank"] == 1


def test_nested_contract(spark):
    source = nested(spark, [record()])
    checks.require_nested_strings(source, ["actor.login", "created_at"])
    for path in ("actor.name", "actor", "missing"):
        with pytest.raises(checks.ContractError):
            checks.require_nested_strings(source, [path])


def test_event_applications(spark, tmp_path):
    tables.ensure_namespaces(spark, ["event_app"], str(tmp_path))
    provenance = {"dataset": "gh_archive", "dataset.plan_id": "p"}
    source = nested(spark, [record(), record(i="2", when="2026-01-01T01:00:00Z"), record()])
    applications.build_events(source, "event_app.events", provenance)
    sessions = applications.build_sessions(spark, "event_app.events", "event_app.sessions", provenance)
    assert sessions.where("new_session = 1").count() == 2 and sessions.count() == 3
    with pytest.raises(checks.ContractError, match="another generation"):
        applications.build_sessions(spark, "event_app.events", "event_app.sessions", {"dataset": "other"})
    with pytest.raises(checks.ContractError, match="conflicting_ids"):
        applications.build_events(source.unionAll(nested(spark, [record(kind="x")])), "event_app.events", provenance)


def test_histogram_order(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "type string")
    assert [tuple(row) for row in events.type_histogram(frame).collect()] == [("c", 2), ("a", 1), ("b", 1)]
