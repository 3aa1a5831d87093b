"""Contract checks.

Schema contracts compare metadata on the driver and raise. Row contracts return a frame of
(check, violations, status); all per-row conditions of one table are counted in a single pass.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.predicates import any_blank, any_null, is_finite, is_true
from tidemark.operators.multiset import check_rows, multiset_difference
from tidemark.session import shared_folder


class ContractError(ValueError):
    """A table does not meet its contract."""


# --- schema contracts ---------------------------------------------------------------------------


def _described(schema: T.StructType, nullability: bool) -> list[tuple]:
    return [
        (field.name, field.dataType, field.nullable) if nullability else (field.name, field.dataType)
        for field in schema.fields
    ]


def require_exact_schema(frame: DataFrame, expected: T.StructType) -> DataFrame:
    """Same names (case included), order, types and nullability."""
    if _described(frame.schema, True) != _described(expected, True):
        raise ContractError(f"schema is {frame.schema.simpleString()}, expected {expected.simpleString()}")
    return frame


def require_names_and_types(frame: DataFrame, expected: T.StructType) -> DataFrame:
    if _described(frame.schema, False) != _described(expected, False):
        raise ContractError(f"schema is {frame.schema.simpleString()}, expected {expected.simpleString()}")
    return frame


def require_columns(frame: DataFrame, expected: Mapping[str, T.DataType]) -> DataFrame:
    present = {field.name: field.dataType for field in frame.schema.fields}
    wrong = [name for name, kind in expected.items() if present.get(name) != kind]
    if wrong:
        raise ContractError(f"missing or wrongly typed columns: {wrong}")
    return frame


def require_nested_strings(frame: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Every dotted path exists and ends in a string."""
    for path in paths:
        kind: T.DataType = frame.schema
        for part in path.split("."):
            if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
                raise ContractError(f"missing field: {path}")
            kind = kind[part].dataType
        if not isinstance(kind, T.StringType):
            raise ContractError(f"field is not a string: {path}")
    return frame


def _some_value(kind: T.DataType) -> Column:
    """Any non-null literal of a type; lets Catalyst see that a checked column cannot be null."""
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, T.DateType):
        return F.lit(datetime.date(1970, 1, 1))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_seconds(F.lit(0)).cast(kind)
    return F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)


def impose_schema(frame: DataFrame, expected: T.StructType) -> DataFrame:
    """Exact schema with its nullability; a null in a required column fails the job."""
    columns = []
    for field in expected.fields:
        value = F.col(field.name)
        if not field.nullable:
            failure = F.raise_error(F.lit(f"null in required column {field.name}")).cast(field.dataType)
            value = F.coalesce(value, failure, _some_value(field.dataType))
        columns.append(value.alias(field.name))
    return frame.select(columns).to(expected)


def canonical_schema_json(schema: T.StructType) -> str:
    fields = [
        {"name": field.name, "nullable": field.nullable, "type": field.dataType.typeName()}
        if not isinstance(field.dataType, T.DecimalType)
        else {"name": field.name, "nullable": field.nullable, "type": field.dataType.simpleString()}
        for field in schema.fields
    ]
    return json.dumps(fields, separators=(",", ":"), sort_keys=True)


def schema_sha256(schema: T.StructType) -> str:
    return hashlib.sha256(canonical_schema_json(schema).encode()).hexdigest()


# --- row contracts ------------------------------------------------------------------------------


def count_violations(frame: DataFrame, violations: Mapping[str, Column], empty: str | None = None) -> DataFrame:
    """One pass over the frame; each condition marks a violating row.

    ``empty`` names a further check that fails when the frame has no rows.
    """
    counts = [F.count_if(is_true(rule)).alias(name) for name, rule in violations.items()]
    if empty is not None:
        counts.insert(0, (F.count(F.lit(1)) == 0).cast("long").alias(empty))
    return check_rows(frame.agg(*counts))


def _row_count(frame: DataFrame, name: str) -> DataFrame:
    return check_rows(frame.agg(F.count(F.lit(1)).alias(name)))


def key_checks(frame: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Null keys (rows) and duplicated keys (groups), from one grouped pass."""
    groups = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    missing = any_null(keys)
    return check_rows(
        groups.agg(
            F.sum(F.when(missing, F.col("_rows")).otherwise(F.lit(0))).alias(f"{label}_null_key"),
            F.count_if(~missing & (F.col("_rows") > 1)).alias(f"{label}_duplicate_key"),
        )
    )


def reference_check(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, label: str) -> DataFrame:
    """Child rows whose key has no parent. Child keys are counted first, so a hot key is one row."""
    keys = child.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    dangling = keys.join(parent.select(F.col(parent_key).alias("_key")), "_key", "left_anti")
    return check_rows(dangling.agg(F.sum("_rows").alias(label)))


def union_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(lambda left, right: left.unionByName(right), checks)


def star_source_checks(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Non-null unique keys of the three sources and both foreign keys."""
    return union_checks(
        [
            key_checks(customer, ["c_custkey"], "customer"),
            key_checks(orders, ["o_orderkey"], "orders"),
            key_checks(lineitem, ["l_orderkey", "l_linenumber"], "lineitem"),
            reference_check(orders, "o_custkey", customer, "c_custkey", "orders_without_customer"),
            reference_check(lineitem, "l_orderkey", orders, "o_orderkey", "lineitem_without_order"),
        ]
    )


def ratings_checks(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    return count_violations(
        ratings,
        {"ratings_null": any_null(ratings.columns), "ratings_not_finite": ~is_finite(rating)},
        empty="ratings_empty",
    )


def feature_checks(features: DataFrame, key: str, mean: str, count: str, ratings: DataFrame) -> DataFrame:
    """One row per key, finite means, positive counts, and counts adding up to the rating rows."""
    weights = features.select(F.col(count).cast("long").alias("_n")).unionAll(ratings.select(F.lit(-1).cast("long")))
    balance = weights.agg(F.abs(F.coalesce(F.sum("_n"), F.lit(0))).alias("counts_differ_from_source"))
    return union_checks(
        [
            key_checks(features, [key], key),
            count_violations(features, {"mean_not_finite": ~is_finite(mean), "count_not_positive": F.col(count) <= 0}),
            check_rows(balance),
        ]
    )


def conflicting_ids(frame: DataFrame, key: Sequence[str], value: Sequence[str] | None = None) -> DataFrame:
    """Keys seen with more than one version of the remaining columns; identical copies are allowed."""
    names = list(value) if value is not None else [name for name in frame.columns if name not in key]
    versions = frame.groupBy(*key, *names).agg(F.lit(1).alias("_one"))
    return (
        versions.groupBy(*key).agg(F.count(F.lit(1)).alias("versions")).where(F.col("versions") > 1)
    )


def event_checks(
    events: DataFrame, key: str = "id", text: Sequence[str] = ("id", "type", "actor_login", "repo_name"),
    time: str = "created_at",
) -> DataFrame:
    return union_checks(
        [
            count_violations(
                events, {"text_blank": any_blank(text), "time_null": F.col(time).isNull()}, empty="events_empty"
            ),
            _row_count(conflicting_ids(events, [key]), "conflicting_ids"),
        ]
    )


def _derived_sessions(events: DataFrame, user: str, time: str, order: str, gap_seconds: int) -> DataFrame:
    """(user, time, order, previous, new_session, session_id) by another route than ``events.sessionize``.

    Rows are sorted by (user, time, order) over ranges, so a user of any size lies on many tasks. A
    window holds the rows of one user in one range; what crosses a range is a row per user and range.
    """
    spark = events.sparkSession
    path = shared_folder(spark, "derived-sessions")
    (
        events.select(F.col(user).alias("_user"), F.col(time).alias("_time"), F.col(order).alias("_order"))
        .repartitionByRange("_user", "_time", "_order")
        .sortWithinPartitions("_user", "_time", "_order")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33))
        .write.parquet(path)
    )
    ordered = spark.read.parquet(path)
    in_part = Window.partitionBy("_user", "_part").orderBy("_place")
    over_parts = Window.partitionBy("_user").orderBy("_part")
    lasts = ordered.groupBy("_user", "_part").agg(F.max("_time").alias("_last"))
    lasts = lasts.select("_user", "_part", F.lag("_last").over(over_parts).alias("_carried"))
    rows = (
        ordered.withColumn("_inside", F.lag("_time").over(in_part))
        .join(lasts, ["_user", "_part"])
        .withColumn("_previous", F.coalesce("_inside", "_carried"))
    )
    gap = F.unix_timestamp("_time") - F.unix_timestamp("_previous")
    rows = rows.withColumn("_new", F.coalesce((gap > gap_seconds).cast("int"), F.lit(1)))
    sums = rows.groupBy("_user", "_part").agg(F.sum("_new").alias("_in_part"))
    earlier = over_parts.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_user", "_part", F.coalesce(F.sum("_in_part").over(earlier), F.lit(0)).alias("_base"))
    return rows.withColumn("_upto", F.sum("_new").over(in_part)).join(sums, ["_user", "_part"]).select(
        "_user", "_time", "_order", "_previous", F.col("_new").alias("new_session"), (F.col("_base") + F.col("_upto")).alias("session_id")
    )


def session_checks(
    sessions: DataFrame, events: DataFrame, user: str, time: str, previous: str, gap_seconds: int, order: str = "id"
) -> DataFrame:
    """The session annotation compared, copy by copy, with one derived from the events by another route.

    ``sessions_differ`` counts the rows that differ; it alone decides. The other checks say what is
    wrong: flags must agree with the gap to the previous time; every timestamp must serve as a previous
    time once per event except the user's last; sessions must be numbered 1..n in time order, hold one
    flag each and lie more than the gap apart.
    """
    derived = _derived_sessions(events, user, time, order, gap_seconds)
    annotated = sessions.select(
        F.col(user).alias("_user"), F.col(time).alias("_time"), F.col(order).alias("_order"), F.col(previous).alias("_previous"),
        F.col("new_session").cast("int").alias("new_session"), F.col("session_id").cast("long").alias("session_id"),
    )
    compared = check_rows(
        multiset_difference(derived, annotated).agg(F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).alias("sessions_differ"))
    )
    start, prev = F.col(time), F.col(previous)
    starts = prev.isNull() | (F.unix_timestamp(start) - F.unix_timestamp(prev) > gap_seconds)
    local = count_violations(
        sessions,
        {
            "annotation_null": any_null([time, "new_session", "session_id"]),
            "flag_not_binary": ~F.col("new_session").isin(0, 1),
            "session_id_below_one": F.col("session_id") < 1,
            "flag_disagrees_with_gap": (F.col("new_session") == 1) != starts,
            "previous_after_event": prev > start,
        },
    )
    conserved = check_rows(
        multiset_difference(events, sessions.select(*events.columns)).agg(
            F.sum(F.abs("surplus")).alias("event_rows_changed")
        )
    )

    uses = sessions.select(user, F.col(time).alias("_t"), F.lit(1).alias("_w")).unionByName(
        sessions.where(prev.isNotNull()).select(user, F.col(previous).alias("_t"), F.lit(-1).alias("_w"))
    )
    balance = uses.groupBy(user, "_t").agg(F.sum("_w").alias("_left"))
    chain = balance.groupBy(user).agg(
        F.max(F.struct("_t", "_left")).alias("_last"), F.sum(F.abs("_left")).alias("_unbalanced")
    )
    chained = check_rows(
        chain.agg(F.count_if((F.col("_last._left") != 1) | (F.col("_unbalanced") != 1)).alias("previous_chain_broken"))
    )

    spans = sessions.groupBy(user, "session_id").agg(
        F.min(F.unix_timestamp(time)).alias("_from"),
        F.max(F.unix_timestamp(time)).alias("_to"),
        F.sum("new_session").alias("_flags"),
    )
    by_number = Window.partitionBy(user).orderBy("session_id")
    numbered = spans.select(
        "_flags",
        "session_id",
        F.row_number().over(by_number).alias("_expected"),
        (F.col("_from") - F.lag("_to").over(by_number)).alias("_apart"),
    )
    spaced = count_violations(
        numbered,
        {
            "session_without_single_flag": F.col("_flags") != 1,
            "session_number_gap": F.col("session_id") != F.col("_expected"),
            "sessions_too_close": F.col("_apart") <= gap_seconds,
        },
    )
    return union_checks([local, conserved, chained, spaced, compared])


def multiplicity_comparison(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer comparison of copies per key: rows (keys, expected_rows, actual_rows) that differ."""
    left = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected_rows"))
    right = actual.groupBy(*keys).agg(F.count(F.lit(1)).alias("actual_rows"))
    joined = left.alias("e").join(
        right.alias("a"),
        functools.reduce(lambda a, b: a & b, [F.col(f"e.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]),
        "full",
    )
    return joined.select(
        *[F.coalesce(F.col(f"e.{k}"), F.col(f"a.{k}")).alias(k) for k in keys],
        F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
        F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"),
    ).where(F.col("expected_rows") != F.col("actual_rows"))


def provenance_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Property rows (key, value) that are absent or different on either side."""
    joined = left.alias("l").join(right.alias("r"), "key", "full")
    return joined.where(~F.col("l.value").eqNullSafe(F.col("r.value"))).select(
        "key", F.col("l.value").alias("left_value"), F.col("r.value").alias("right_value")
    )


def require_passed(checks: DataFrame) -> None:
    """Raise when any check reports violations; the frame has one row per check."""
    failed = checks.where(F.col("violations") > 0).select("check", "violations").collect()
    if failed:
        raise ContractError("; ".join(f"{row['check']}: {row['violations']}" for row in failed))
