import datetime
import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from tidemark.operators import monitoring, retention, trailing

T0 = datetime.datetime(2026, 1, 1)


def at(seconds):
    return T0 + datetime.timedelta(seconds=seconds)


def test_quantile_of_nulls_infinities_and_copies(spark):
    sample = {
        "a": [float(value) for value in range(10)] + [None] * 5,
        "inf": [1.0, float("inf"), float("-inf"), 3.0],
        "tail": [1.0] * 50 + [1e300],
        "one": [7.0],
        "none": [None],
    }
    frame = spark.createDataFrame([(k, v) for k, own in sample.items() for v in own], "k string, _value double")
    counts = frame.groupBy("k", "_value").agg(F.count(F.lit(1)).alias("_n"))
    for q in (0.0, 0.5, 0.95, 1.0):
        found = {row["k"]: (row["quantile"], row["samples"]) for row in monitoring.counted_quantile(counts, ["k"], q).collect()}
        builtin = frame.where("_value IS NOT NULL").groupBy("k").agg(F.percentile("_value", F.lit(q)).alias("p"), F.count("_value").alias("n"))
        assert found == {row["k"]: (row["p"], row["n"]) for row in builtin.collect()}


def test_quantile_of_a_null_group(spark):
    frame = spark.createDataFrame([(None, 1.0, 1), (None, 3.0, 3), ("x", 2.0, 1)], "k string, _value double, _n long")
    assert {row["k"]: row["quantile"] for row in monitoring.counted_quantile(frame, ["k"], 0.5).collect()} == {None: 3.0, "x": 2.0}


def test_trailing_quantile_equals_numpy(spark):
    rng = random.Random(5)
    sample = [("hot" if rng.random() < 0.6 else "cold", at(rng.randrange(0, 4000)), round(rng.expovariate(1), 1)) for _ in range(400)]
    frame = spark.createDataFrame(sample, "s string, t timestamp_ntz, v double")
    found = {
        (row["s"], row["eval_time"]): (row["quantile"], row["samples"])
        for row in monitoring.trailing_quantile(frame, "s", "t", "v", 0.95, 600, 60).collect()
    }
    expected = {}
    for step in range(0, 80):
        now = at(step * 60)
        for series in ("hot", "cold"):
            inside = [v for s, t, v in sample if s == series and now - datetime.timedelta(seconds=600) < t <= now]
            if inside:
                expected[(series, now)] = (pytest.approx(float(np.quantile(inside, 0.95))), len(inside))
    assert found == expected


@pytest.mark.parametrize("limits", [(2_000_000, 64), (40, 4), (7, 2)])
def test_trailing_ranks_of_divided_groups(spark, limits):
    """Groups too large for one task are divided by value, again and again, with the same result."""
    rng = random.Random(11)
    rows = [(s, rng.randrange(60), rng.choice([0.0, 1.5, 1.5, -3.0, rng.randrange(40) / 4])) for s in ["hot"] * 500 + ["cold"] * 30 + [None] * 9]
    rows += [("one", 3, 7.0)] * 30 + [("flat", step, 2.0) for step in range(50)]
    counted = Counter(rows)
    frame = spark.createDataFrame([(*key, n) for key, n in counted.items()], "_series string, _step long, _value double, _n long")
    found = trailing.trailing_ranks(frame, 10, 0.7, *limits)
    got = {(row["_series"], row["_at"]): (row["_quantile"], row["samples"]) for row in found.collect()}
    expected = {}
    for series in {row[0] for row in rows}:
        for at_step in range(80):
            inside = [v for s, step, v in rows if s == series and at_step - 10 < step <= at_step]
            if inside:
                expected[series, at_step] = (pytest.approx(float(np.quantile(inside, 0.7))), len(inside))
    assert got == expected


def test_trailing_ranks_copy_no_row_into_windows(spark):
    frame = spark.createDataFrame([("a", T0, 1.0)], "s string, t timestamp_ntz, v double")
    plan = plan_of(monitoring.trailing_quantile(frame, "s", "t", "v", 0.5, 30 * 86400, 60))
    assert "Generate" not in plan and "explode" not in plan


def test_step_must_divide_window(spark):
    frame = spark.createDataFrame([("a", T0, 1.0)], "s string, t timestamp_ntz, v double")
    with pytest.raises(ValueError):
        monitoring.trailing_quantile(frame, "s", "t", "v", 0.5, 100, 60)


def test_availability_counts_absent_samples_as_failures(spark, rows):
    scrapes = spark.createDataFrame([("a", at(60 * i)) for i in range(1, 7)] + [("b", at(60))], "s string, t timestamp_ntz")
    good = spark.createDataFrame([("a", at(60 * i)) for i in (1, 2, 6)], "s string, t timestamp_ntz")
    found = monitoring.trailing_availability(scrapes, good, "s", "t", 180, 60)
    assert rows(found, "s", "eval_time", "successes", "scrapes") == [
        ("a", at(60), 1, 1), ("a", at(120), 2, 2), ("a", at(180), 2, 3), ("a", at(240), 1, 3), ("a", at(300), 0, 3),
        ("a", at(360), 1, 3), ("b", at(60), 0, 1),
    ]


def test_alerts_need_the_hold_time(spark, rows):
    truths = {0: 1, 1: 1, 2: 1, 3: 0, 4: 1, 5: 1, 7: 1, 8: 1, 9: 1, 10: 1}
    frame = spark.createDataFrame([("a", at(60 * i), bool(v)) for i, v in truths.items()], "s string, t timestamp_ntz, c boolean")
    found = monitoring.alert_runs(frame, "s", "t", F.col("c"), 120, 60)
    assert rows(found) == [("a", at(0), at(120), at(120), 3), ("a", at(420), at(540), at(600), 4)]


PUBLICATION, MANIFEST = "0" * 32, "f" * 64
GENERATION = f"gh_events_file/tiny/{PUBLICATION}/{MANIFEST}/"
IDENTITY = f"scale=tiny;publication_id={PUBLICATION};manifest_sha256={MANIFEST}"
RUN = "12345678-1234-1234-1234-123456789abc"


def test_prefixes_match_their_templates(spark):
    prefixes = [
        "events/", "event_windows/", GENERATION, GENERATION.replace("tiny", "huge"), f"streaming_test/{RUN}/", "events/x", "other/",
    ]
    frame = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    found = [tuple(row) for row in retention.match_prefix(frame, "prefix").select("checkpoint_id", "generation").collect()]
    assert found == [
        ("streaming-events-v1", ""), ("streaming-event-windows-v1", ""), ("streaming-gh-archive-file-v1", IDENTITY),
        (None, None), ("go-live-streaming-test-v1", f"run_uuid={RUN}"), (None, None), (None, None),
    ]


EVALUATED = datetime.datetime(2026, 3, 1)
OCCURRED = datetime.datetime(2026, 1, 10)
BASE = {
    "prefix": GENERATION,
    "evaluated_at": EVALUATED,
    "has_lease": True,
    "lease_checkpoint_id": "streaming-gh-archive-file-v1",
    "lease_prefix": GENERATION,
    "lease_state": "completed",
    "acquired_at": OCCURRED - datetime.timedelta(hours=2),
    "heartbeat_at": OCCURRED - datetime.timedelta(minutes=5),
    "expires_at": OCCURRED + datetime.timedelta(minutes=5),
    "etag": "e",
    "lease_conflicting": False,
    "lease_malformed": False,
    "object_count": 3,
    "total_bytes": 30,
    "newest_last_modified": OCCURRED - datetime.timedelta(minutes=1),
    "inventory_sha256": "0" * 64,
    "changed_since_plan": False,
    "partial_retry_confined": True,
    "has_terminal": True,
    "terminal_state": "completed",
    "occurred_at": OCCURRED,
    "recovery_approved": True,
    "source_available": True,
    "sink_disposition_approved": True,
    "terminal_review": None,
    "terminal_generation": IDENTITY,
    "exclusive_run": True,
    "successful": True,
}
KINDS = {
    datetime.datetime: "timestamp_ntz", bool: "boolean", int: "long", str: "string", type(None): "string",
}
SCHEMA = ", ".join(f"{name} {KINDS[type(value)]}" for name, value in BASE.items())
EVENTS_LEASE = {"prefix": "events/", "lease_prefix": "events/", "lease_checkpoint_id": "streaming-events-v1"}
STOPPED = {"lease_state": "stopped", "terminal_state": "stopped"}

CASES = [
    ({}, []),
    ({"prefix": "other/"}, ["unknown_prefix"]),
    ({"evaluated_at": OCCURRED + datetime.timedelta(days=13)}, ["retention_quarantine"]),
    ({"has_lease": False}, ["lease_missing"]),
    ({"lease_malformed": True, "lease_conflicting": True}, ["lease_malformed", "lease_conflicting"]),
    ({"lease_prefix": "x/"}, ["lease_identity_mismatch"]),
    ({"etag": "e" * 129}, ["lease_etag_invalid"]),
    ({"expires_at": OCCURRED}, ["lease_clock_invalid"]),
    ({"lease_state": "active"}, ["lease_expired_active_uncertain", "invalid_lease_terminal_state"]),
    ({"lease_state": "weird"}, ["lease_state_invalid", "invalid_lease_terminal_state"]),
    ({"object_count": 0}, ["inventory_invalid"]),
    ({"object_count": 100_001}, ["inventory_invalid"]),
    ({"inventory_sha256": "xyz"}, ["inventory_invalid"]),
    ({"changed_since_plan": True, "partial_retry_confined": False}, ["inventory_changed", "partial_retry_broadened"]),
    ({"newest_last_modified": EVALUATED + datetime.timedelta(seconds=301)}, ["future_clock", "object_after_terminal", "retention_quarantine"]),
    ({"has_terminal": False}, ["invalid_lease_terminal_state", "terminal_missing"]),
    ({"terminal_state": "retired"}, ["invalid_lease_terminal_state", "invalid_terminal_state"]),
    ({"recovery_approved": False, "source_available": False, "sink_disposition_approved": False}, ["recovery_not_approved", "source_unavailable", "sink_disposition_not_approved"]),
    ({"terminal_generation": "scale=small"}, ["generation_identity_mismatch"]),
    ({"occurred_at": None}, ["invalid_utc_timestamp"]),
    (EVENTS_LEASE | STOPPED, ["registry_active_durable"]),
    (
        {"prefix": f"streaming_test/{RUN}/", "lease_prefix": f"streaming_test/{RUN}/", "lease_checkpoint_id": "go-live-streaming-test-v1",
         "terminal_generation": f"run_uuid={RUN}", "exclusive_run": False, "successful": False} | STOPPED,
        ["exclusive_run_required", "successful_run_required"],
    ),
]


def test_retention_codes_in_order(spark):
    frame = spark.createDataFrame([tuple((BASE | change).values()) for change, _ in CASES], SCHEMA).coalesce(1)
    found = [row["refusal_codes"] for row in retention.retention_decision(frame).collect()]
    assert found == [codes for _, codes in CASES]


def test_eligible_decision_has_its_anchor(spark):
    frame = spark.createDataFrame([tuple(BASE.values())], SCHEMA)
    row = retention.retention_decision(frame).first()
    assert row["eligible"] and row["retention_anchor"] == OCCURRED
    assert row["eligible_after"] == OCCURRED + datetime.timedelta(days=14)


def test_decision_plan_is_canonical(spark):
    frame = spark.createDataFrame([tuple((BASE | {"has_lease": False}).values())], SCHEMA)
    kept = ["evaluated_at", "newest_last_modified", "object_count", "total_bytes", "inventory_sha256"]
    row = retention.decision_plans(retention.retention_decision(frame, keep=kept), "p" * 64).first()
    payload = json.loads(row["plan_json"])
    assert row["plan_json"] == json.dumps(payload, sort_keys=True, separators=(",", ":"))
    assert payload["decision"] == "refused" and payload["refusal_codes"] == ["lease_missing"]
    assert payload["inventory"]["newest_last_modified"] == "2026-01-09T23:59:00Z"
    assert row["plan_sha256"] == hashlib.sha256(row["plan_json"].encode()).hexdigest()


RETIRED = retention.CheckpointRule(
    "streaming-events-v1", "events/", "durable_stream", ("stopped", "retired"), 2592000, "retired", "2026-01-11 00:00:00", "review/1"
)


def test_retired_streams_need_a_matching_review(spark):
    facts = BASE | EVENTS_LEASE | STOPPED
    cases = [({"terminal_review": "review/1"}, []), ({"terminal_review": "other"}, ["retirement_review_mismatch"]), ({}, ["retirement_review_missing", "retirement_review_mismatch"])]
    frame = spark.createDataFrame([tuple((facts | change).values()) for change, _ in cases], SCHEMA).coalesce(1)
    decided = retention.retention_decision(frame, rules=[RETIRED]).collect()
    assert [row["refusal_codes"] for row in decided] == [codes for _, codes in cases]
    assert decided[0]["retention_anchor"] == datetime.datetime(2026, 1, 11)


def test_inventory_rollup(spark, rows):
    objects = [("p/", "a", 1, T0), ("p/", "b", 2, at(5)), ("p/", "b", 2, at(5)), ("q/", "c", 9, T0)]
    ddl = "prefix string, key string, size long, modified timestamp_ntz"
    found = retention.inventory_rollup(spark.createDataFrame(objects, ddl), "prefix", "key", "size", "modified")
    assert rows(found.drop("inventory_sha256")) == [("p/", 3, 5, at(5), 1), ("q/", 1, 9, T0, 0)]
    again = retention.inventory_rollup(spark.createDataFrame(objects[::-1], ddl).repartition(3), "prefix", "key", "size", "modified")
    assert rows(found) == rows(again)
