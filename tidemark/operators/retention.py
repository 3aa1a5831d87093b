"""Checkpoint inventories and the decision whether a checkpoint prefix may be removed."""

from __future__ import annotations

import functools
import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.predicates import EVENT_TIME_PATTERN, is_true
from tidemark.operators.digests import keyed_digest

# Bounds and clocks of the retention policy.
FUTURE_TOLERANCE_SECONDS = 300
LEASE_TTL_SECONDS = 600
MAX_OBJECTS = 100_000
MAX_BYTES = 10_737_418_240
MAX_ETAG = 128
REVIEW_REGEX = r"^[A-Za-z0-9][A-Za-z0-9._/-]{0,127}$"

# The text forms a template field may take.
TEMPLATE_FIELDS = {
    "scale": "(?:tiny|small|medium)",
    "publication_id": "[0-9a-f]{32}",
    "manifest_sha256": "[0-9a-f]{64}",
    "run_uuid": "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
}

# Lease and terminal states each durability class accepts at its end.
END_STATES = {
    "durable_stream": ["stopped", "retired"],
    "generation_reproducibility": ["completed", "stopped"],
    "disposable_acceptance": ["stopped"],
}


@dataclasses.dataclass(frozen=True)
class CheckpointRule:
    """Retention rule of one checkpoint prefix; ``template`` may contain ``{field}`` parts."""

    checkpoint_id: str
    template: str
    durability: str
    terminal_states: tuple[str, ...]
    retention_seconds: int
    lifecycle: str = "active"
    retired_at: str | None = None
    retirement_review: str | None = None

    def fields(self) -> list[str]:
        return [part.split("}")[0] for part in self.template.split("{")[1:]]

    def regex(self) -> str:
        pattern = self.template.replace(".", r"\.")
        for field in self.fields():
            pattern = pattern.replace("{" + field + "}", f"({TEMPLATE_FIELDS[field]})")
        return f"^{pattern}$"


# Id, prefix template, durability, terminal states, retention in seconds.
CHECKPOINT_RULES = [
    CheckpointRule("streaming-events-v1", "events/", "durable_stream", ("stopped", "retired"), 2592000),
    CheckpointRule("streaming-event-windows-v1", "event_windows/", "durable_stream", ("stopped", "retired"), 2592000),
    CheckpointRule("streaming-online-retail-cdc-v1", "online_retail_cdc/", "durable_stream", ("stopped", "retired"), 2592000),
    CheckpointRule("streaming-gh-archive-file-v1", "gh_events_file/{scale}/{publication_id}/{manifest_sha256}/", "generation_reproducibility", ("completed", "stopped"), 1209600),
    CheckpointRule("go-live-streaming-test-v1", "streaming_test/{run_uuid}/", "disposable_acceptance", ("successful", "stopped"), 86400),
]


def inventory_rollup(objects: DataFrame, prefix: str, key: str, size: str, modified: str) -> DataFrame:
    """Per prefix: objects, bytes, newest time, duplicated keys and an order-independent digest."""
    keys = objects.groupBy(prefix, key).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(size).alias("_bytes"), F.max(modified).alias("_newest")
    )
    totals = keys.groupBy(prefix).agg(
        F.sum("_rows").alias("object_count"),
        F.sum("_bytes").alias("total_bytes"),
        F.max("_newest").alias("newest_last_modified"),
        F.count_if(F.col("_rows") > 1).alias("duplicate_keys"),
    )
    line = F.concat_ws("\t", F.col(key).cast("string"), F.col(size).cast("string"), F.col(modified).cast("string"))
    return totals.join(keyed_digest(objects, [prefix], line, "inventory_sha256"), prefix)


def match_prefix(frame: DataFrame, prefix: str, rules: Sequence[CheckpointRule] = CHECKPOINT_RULES) -> DataFrame:
    """Add the checkpoint id and the generation text (template fields) of each concrete prefix.

    A prefix no rule covers gets a null id.
    """
    path = F.col(prefix)
    checkpoint = F.lit(None).cast("string")
    generation = F.lit(None).cast("string")
    for rule in reversed(rules):
        hit = path.rlike(rule.regex())
        parts = [
            F.concat(F.lit(f"{field}="), F.regexp_extract(path, rule.regex(), position))
            for position, field in enumerate(rule.fields(), start=1)
        ]
        checkpoint = F.when(hit, F.lit(rule.checkpoint_id)).otherwise(checkpoint)
        generation = F.when(hit, F.concat_ws(";", *parts) if parts else F.lit("")).otherwise(generation)
    return frame.withColumns({"checkpoint_id": checkpoint, "generation": generation})


def rules_frame(spark: SparkSession, rules: Sequence[CheckpointRule] = CHECKPOINT_RULES) -> DataFrame:
    rows = [
        (
            rule.checkpoint_id,
            rule.durability,
            rule.lifecycle,
            list(rule.terminal_states),
            rule.retention_seconds,
            rule.retired_at,
            rule.retirement_review,
            list(END_STATES[rule.durability]),
        )
        for rule in rules
    ]
    raw = spark.createDataFrame(
        rows,
        "checkpoint_id string, durability string, lifecycle string, terminal_states array<string>, "
        "retention_seconds long, retired_at string, registry_review string, end_states array<string>",
    )
    return raw.withColumn("retired_at", F.col("retired_at").cast("timestamp_ntz"))


def _coded(rules: Sequence[tuple[str, Column]]) -> list[Column]:
    return [F.when(is_true(condition), F.lit(code)) for code, condition in rules]


def retention_decision(
    facts: DataFrame,
    evaluated_at: str = "evaluated_at",
    rules: Sequence[CheckpointRule] = CHECKPOINT_RULES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One decision per fact row: refusal codes in evaluation order, retention anchor, eligibility.

    ``facts`` has one row per prefix, with ``has_lease`` and ``has_terminal`` flags, lease columns
    (lease_checkpoint_id, lease_prefix, lease_state, acquired_at, heartbeat_at, expires_at, etag,
    lease_conflicting, lease_malformed), inventory columns (object_count, total_bytes,
    newest_last_modified, inventory_sha256, changed_since_plan, partial_retry_confined) and
    terminal columns (terminal_state, occurred_at, recovery_approved, source_available,
    sink_disposition_approved, terminal_review, terminal_generation, exclusive_run, successful).
    Prefixes without a rule are refused as ``unknown_prefix``. ``keep`` names fact columns to retain.
    """
    spark = facts.sparkSession
    matched = match_prefix(facts, "prefix", rules).join(F.broadcast(rules_frame(spark, rules)), "checkpoint_id", "left")
    now = F.col(evaluated_at)
    known = F.col("durability").isNotNull()
    lease = known & F.col("has_lease")
    terminal = known & F.col("has_terminal")
    latest_clock = now + F.make_dt_interval(secs=F.lit(FUTURE_TOLERANCE_SECONDS))

    def not_true(name: str) -> Column:
        return ~is_true(F.col(name))

    def missing_clock(name: str) -> Column:
        return F.col(name).isNull()

    def ahead(name: str) -> Column:
        return F.col(name) > latest_clock

    def no_flag(*names: str) -> Column:
        return functools.reduce(lambda a, b: a | b, [F.col(name).isNull() for name in names])

    lease_clocks = ["acquired_at", "heartbeat_at", "expires_at"]
    terminal_flags = ["recovery_approved", "source_available", "sink_disposition_approved", "exclusive_run", "successful"]
    ordered_lease = (
        (F.col("acquired_at") <= F.col("heartbeat_at"))
        & (F.col("heartbeat_at") <= F.col("expires_at"))
        & (F.col("expires_at") == F.col("heartbeat_at") + F.make_dt_interval(secs=F.lit(LEASE_TTL_SECONDS)))
    )
    state, end_state = F.col("lease_state"), F.col("terminal_state")
    ends = F.col("end_states")
    states_agree = (
        F.array_contains(ends, state) & terminal & F.array_contains(ends, end_state) & (state == end_state)
    )
    active = state == "active"

    codes: list[tuple[str, Column]] = [
        ("unknown_prefix", ~known),
        ("invalid_utc_timestamp", known & now.isNull()),
        ("lease_missing", known & ~F.col("has_lease")),
        ("invalid_fact_type", lease & no_flag("lease_malformed", "lease_conflicting")),
        ("lease_malformed", lease & F.col("lease_malformed")),
        ("lease_conflicting", lease & F.col("lease_conflicting")),
        (
            "lease_identity_mismatch",
            lease
            & ~(
                F.col("lease_checkpoint_id").eqNullSafe(F.col("checkpoint_id"))
                & F.col("lease_prefix").eqNullSafe(F.col("prefix"))
            ),
        ),
        ("lease_etag_invalid", lease & ~is_true(F.length("etag").between(1, MAX_ETAG))),
    ]
    for name in lease_clocks:
        codes.append(("invalid_utc_timestamp", lease & missing_clock(name)))
        codes.append(("future_clock", lease & ahead(name)))
    codes += [
        ("lease_clock_invalid", lease & ~ordered_lease),
        ("invalid_fact_type", lease & state.isNull()),
        ("lease_active", lease & active & (now.isNull() | F.col("expires_at").isNull() | (F.col("expires_at") >= now))),
        ("lease_expired_active_uncertain", lease & active & (F.col("expires_at") < now)),
        ("lease_state_invalid", lease & ~is_true(state.isin("active", "stopped", "completed", "retired"))),
        ("invalid_lease_terminal_state", lease & ~is_true(states_agree)),
        ("lease_terminal_clock_conflict", lease & terminal & (F.col("heartbeat_at") > F.col("occurred_at"))),
        (
            "inventory_invalid",
            known
            & ~is_true(
                F.col("object_count").between(1, MAX_OBJECTS)
                & F.col("total_bytes").between(1, MAX_BYTES)
                & F.col("inventory_sha256").rlike("^[0-9a-f]{64}$")
            ),
        ),
        ("invalid_utc_timestamp", known & missing_clock("newest_last_modified")),
        ("future_clock", known & ahead("newest_last_modified")),
        ("invalid_fact_type", known & no_flag("changed_since_plan", "partial_retry_confined")),
        ("inventory_changed", known & F.col("changed_since_plan")),
        ("partial_retry_broadened", known & not_true("partial_retry_confined")),
        ("terminal_missing", known & ~F.col("has_terminal")),
        ("invalid_utc_timestamp", terminal & missing_clock("occurred_at")),
        ("future_clock", terminal & ahead("occurred_at")),
        ("invalid_fact_type", terminal & end_state.isNull()),
        ("invalid_terminal_state", terminal & ~is_true(F.array_contains("terminal_states", end_state))),
        ("invalid_fact_type", terminal & no_flag(*terminal_flags)),
        ("recovery_not_approved", terminal & not_true("recovery_approved")),
        ("source_unavailable", terminal & not_true("source_available")),
        ("sink_disposition_not_approved", terminal & not_true("sink_disposition_approved")),
    ]
    durability = F.col("durability")
    retired = (durability == "durable_stream") & (F.col("lifecycle") == "retired")
    reviewed = is_true(F.length("registry_review") > 0)
    legal_review = is_true(F.col("registry_review").rlike(REVIEW_REGEX))
    disposable = durability == "disposable_acceptance"
    codes += [
        ("retirement_review_missing", terminal & retired & ~is_true(F.length("terminal_review") > 0)),
        ("retirement_clock_missing", terminal & retired & missing_clock("retired_at")),
        ("future_clock", terminal & retired & ahead("retired_at")),
        ("registry_retirement_review_missing", terminal & retired & ~reviewed),
        ("registry_retirement_review_invalid", terminal & retired & reviewed & ~legal_review),
        (
            "retirement_review_mismatch",
            terminal & retired & legal_review & ~F.col("terminal_review").eqNullSafe(F.col("registry_review")),
        ),
        (
            "generation_identity_mismatch",
            terminal
            & durability.isin("generation_reproducibility", "disposable_acceptance")
            & ~F.col("terminal_generation").eqNullSafe(F.col("generation")),
        ),
        ("exclusive_run_required", terminal & disposable & not_true("exclusive_run")),
        ("successful_run_required", terminal & disposable & not_true("successful")),
        ("object_after_terminal", terminal & (F.col("newest_last_modified") > F.col("occurred_at"))),
    ]

    clocks = [
        (known, "newest_last_modified"),
        (lease, "heartbeat_at"),
        (terminal, "occurred_at"),
        (known & retired, "retired_at"),
    ]
    unusable = F.lit(False)
    for needed, name in clocks:
        unusable = unusable | is_true(needed & missing_clock(name))
    newest = F.greatest(*[F.when(is_true(needed), F.col(name)) for needed, name in clocks])
    anchor = F.when(known & ~unusable, newest)
    after = anchor + F.make_dt_interval(secs=F.col("retention_seconds"))
    active_durable = (durability == "durable_stream") & (F.col("lifecycle") == "active")
    codes += [
        ("registry_active_durable", active_durable),
        ("retention_quarantine", known & ~is_true(active_durable) & (now < after)),
    ]
    decided = matched.select(
        *keep,
        "prefix",
        "checkpoint_id",
        F.array_distinct(F.array_compact(F.array(*_coded(codes)))).alias("refusal_codes"),
        anchor.alias("retention_anchor"),
        after.alias("eligible_after"),
    )
    return decided.withColumn("eligible", F.size("refusal_codes") == 0)


def decision_plans(decisions: DataFrame, policy_sha256: str) -> DataFrame:
    """Add the canonical JSON of each decision and its sha256.

    Members are in name order and times are canonical UTC text. ``decisions`` must keep evaluated_at
    and the inventory columns.
    """

    def text(name: str) -> Column:
        return F.date_format(name, EVENT_TIME_PATTERN).alias(name)

    inventory = F.struct(
        text("newest_last_modified"), "object_count", F.col("inventory_sha256").alias("sha256"), "total_bytes"
    )
    plan = F.struct(
        "checkpoint_id",
        F.when(F.col("eligible"), "eligible").otherwise("refused").alias("decision"),
        text("eligible_after"),
        text("evaluated_at"),
        inventory.alias("inventory"),
        F.lit(policy_sha256).alias("policy_sha256"),
        "prefix",
        "refusal_codes",
        text("retention_anchor"),
    )
    planned = decisions.withColumn("plan_json", F.to_json(plan, {"ignoreNullFields": "false"}))
    return planned.withColumn("plan_sha256", F.sha2("plan_json", 256))
