"""Governed data-quality runs: rules, statuses and the 23-column facts they produce."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.predicates import EVENT_TIME_PATTERN, positive_within
from tidemark.functions.values import elapsed_floor_seconds, ratio9, sha256_lines, whole9

# Identity of the governed source and its rule version.
DATASET_ID = "nyc_taxi"
RULE_VERSION = "nyc_taxi_quality_v1"
BINDING_TYPE = "iceberg_snapshot"
UPSTREAM_JOB = "nyc_taxi_etl"
SOURCE_TABLE = "lakehouse.bronze.nyc_taxi_trips"

# Thresholds.
FRESH_SECONDS = 21600
WARN_RATIO = "0.010000000"
FAIL_RATIO = "0.050000000"
READBACK_CHECKS = 8
MAX_BATCH_FACTS = 8

# Rule id, layer, owner, metric, warn threshold, fail threshold.
RULES = [
    ("bronze.source_available.v1", "Bronze", "Data Engineering", "source_row_count", None, "rows=0"),
    ("bronze.schema.v1", "Bronze", "Data Engineering", "schema_match_ratio", None, "ratio<1.000000000"),
    ("bronze.snapshot_freshness.v1", "Bronze", "Data Engineering", "snapshot_age_seconds", None, "seconds>21600"),
    ("bronze.invalid_ratio.v1", "Bronze", "Data Quality Engineering", "invalid_row_ratio", "ratio>0.010000000", "ratio>0.050000000"),
    ("silver.partition_conservation.v1", "Silver", "Data Quality Engineering", "partition_row_ratio", None, "ratio!=1.000000000"),
    ("silver.clean_nonempty.v1", "Silver", "Data Quality Engineering", "clean_row_count", None, "rows=0"),
    ("silver.quarantine_ratio.v1", "Silver", "Data Quality Engineering", "quarantine_row_ratio", "ratio>0.010000000", "ratio>0.050000000"),
    ("silver.output_readback.v1", "Silver", "Data Platform Engineering", "readback_check_ratio", None, "ratio<1.000000000"),
]

# Statuses from best to worst, and the severity of each.
STATUS_ORDER = ["pass", "warn", "fail", "stale", "missing"]
SEVERITY = {"pass": "info", "warn": "warning", "fail": "error", "stale": "error", "missing": "error"}

# Every legal (rule, status, diagnostic code).
GOVERNED_OUTCOMES = [
    ("bronze.source_available.v1", "pass", "ok"),
    ("bronze.source_available.v1", "missing", "source_missing"),
    ("bronze.source_available.v1", "fail", "threshold_fail"),
    ("bronze.source_available.v1", "fail", "readback_mismatch"),
    ("bronze.schema.v1", "pass", "ok"),
    ("bronze.schema.v1", "fail", "schema_mismatch"),
    ("bronze.snapshot_freshness.v1", "pass", "ok"),
    ("bronze.snapshot_freshness.v1", "stale", "source_stale"),
    ("bronze.invalid_ratio.v1", "pass", "ok"),
    ("bronze.invalid_ratio.v1", "warn", "threshold_warn"),
    ("bronze.invalid_ratio.v1", "fail", "threshold_fail"),
    ("bronze.invalid_ratio.v1", "fail", "readback_mismatch"),
    ("silver.partition_conservation.v1", "pass", "ok"),
    ("silver.partition_conservation.v1", "fail", "partition_mismatch"),
    ("silver.clean_nonempty.v1", "pass", "ok"),
    ("silver.clean_nonempty.v1", "fail", "output_empty"),
    ("silver.quarantine_ratio.v1", "pass", "ok"),
    ("silver.quarantine_ratio.v1", "warn", "threshold_warn"),
    ("silver.quarantine_ratio.v1", "fail", "threshold_fail"),
    ("silver.output_readback.v1", "pass", "ok"),
    ("silver.output_readback.v1", "fail", "readback_mismatch"),
]

# The 20-column trip contract.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
        T.StructField("trip_date", T.DateType()),
    ]
)

# Fixed value: sha256 of the canonical JSON of TRIP_SCHEMA.
TRIP_SCHEMA_SHA256 = "5a8d2916cc5967c0eeb8318136c1262156cd616105dad67a713f1cb1cc872fc5"

# The 23 fact columns, type, and whether null is allowed.
FACT_COLUMNS = [
    ("quality_run_id", "string", False),
    ("logical_date", "timestamp", False),
    ("data_interval_end", "timestamp", False),
    ("dataset_id", "string", False),
    ("binding_type", "string", False),
    ("upstream_dag_id", "string", False),
    ("source_table", "string", False),
    ("source_snapshot_id", "long", True),
    ("source_snapshot_committed_at", "timestamp", True),
    ("source_schema_sha256", "string", True),
    ("layer", "string", False),
    ("rule_id", "string", False),
    ("rule_version", "string", False),
    ("owner", "string", False),
    ("metric_name", "string", False),
    ("metric_numerator", "long", True),
    ("metric_denominator", "long", True),
    ("metric_value", "decimal(38,9)", True),
    ("warn_threshold", "string", True),
    ("fail_threshold", "string", False),
    ("severity", "string", False),
    ("status", "string", False),
    ("diagnostic_code", "string", False),
]
FACT_NAMES = [name for name, _, _ in FACT_COLUMNS]
_FACT_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "long": T.LongType(),
    "decimal(38,9)": T.DecimalType(38, 9),
}
FACT_SCHEMA = T.StructType([T.StructField(name, _FACT_TYPES[kind], nullable) for name, kind, nullable in FACT_COLUMNS])

OBSERVATION_COLUMNS = [
    "logical_date",
    "data_interval_end",
    "source_snapshot_id",
    "source_snapshot_committed_at",
    "source_schema_sha256",
    "schema_matches",
    "source_rows",
    "invalid_rows",
    "clean_rows",
    "quarantine_rows",
]


def trip_rule(require_finite: bool = True) -> Column:
    """Valid trip: positive fare and one to six passengers; null-safe."""
    return positive_within("fare_amount", "passenger_count", 1, 6, require_finite)


def split(frame: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    return frame.where(valid), frame.where(~valid)


def split_counts(frame: DataFrame, valid: Column) -> DataFrame:
    """Source, invalid, clean and quarantine counts from one pass."""
    return frame.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(~valid).alias("invalid_rows"),
        F.count_if(valid).alias("clean_rows"),
        F.count_if(~valid).alias("quarantine_rows"),
    )


def ratio_status(numerator: Column, denominator: Column) -> Column:
    """pass up to and including 1 %, warn up to and including 5 %, else fail.

    A part of nothing, a negative part, one above the whole or an unknown one is an error, not a status.
    """
    possible = F.coalesce((numerator >= 0) & (denominator > 0) & (numerator <= denominator), F.lit(False))
    return F.when(possible, status_of_ratio(ratio9(numerator, denominator))).otherwise(
        F.raise_error(F.lit("impossible ratio"))
    )


def status_of_ratio(value: Column) -> Column:
    return (
        F.when(value > F.lit(FAIL_RATIO).cast("decimal(38,9)"), "fail")
        .when(value > F.lit(WARN_RATIO).cast("decimal(38,9)"), "warn")
        .otherwise("pass")
    )


def ratio_diagnostic(status: Column) -> Column:
    return F.when(status == "pass", "ok").otherwise(F.concat(F.lit("threshold_"), status))


def snapshot_age(committed_at: Column, interval_end: Column) -> Column:
    return elapsed_floor_seconds(committed_at, interval_end)


def freshness_status(age: Column) -> Column:
    return F.when(age > FRESH_SECONDS, "stale").otherwise("pass")


def severity(status: Column) -> Column:
    mapping = F.create_map(*[F.lit(part) for pair in SEVERITY.items() for part in pair])
    return mapping[status]


def status_rank(status: Column) -> Column:
    return F.array_position(F.array(*[F.lit(name) for name in STATUS_ORDER]), status)


def run_id(logical_date: Column, snapshot_id: Column) -> Column:
    """Deterministic id of a run: dataset, date, snapshot and rule version."""
    identity = F.coalesce(snapshot_id.cast("string"), F.lit("missing"))
    return sha256_lines(F.lit(DATASET_ID), F.date_format(logical_date, EVENT_TIME_PATTERN), identity, F.lit(RULE_VERSION))


def rules_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        RULES,
        "rule_id string, layer string, owner string, metric_name string, warn_threshold string, fail_threshold string",
    )


def _fact(
    rule: str, numerator: Column | int | None, denominator: Column | int | None, value: Column | None,
    status: Column | str, diagnostic: Column | str,
) -> Column:
    def column(part, kind: str) -> Column:
        return (part if isinstance(part, Column) else F.lit(part)).cast(kind)

    return F.struct(
        F.lit(rule).alias("rule_id"),
        column(numerator, "long").alias("metric_numerator"),
        column(denominator, "long").alias("metric_denominator"),
        column(value, "decimal(38,9)").alias("metric_value"),
        column(status, "string").alias("status"),
        column(diagnostic, "string").alias("diagnostic_code"),
    )


def run_facts(observations: DataFrame) -> DataFrame:
    """Facts of any number of runs, one observation row each.

    The gates apply in order: source missing, stale, wrong schema, empty, too many invalid rows,
    partition not conserved. A run stopped at a gate yields only the facts known by then; a
    completed run yields all eight.
    """
    one = F.lit("1.000000000")
    rows, invalid = F.col("source_rows"), F.col("invalid_rows")
    clean, quarantine = F.col("clean_rows"), F.col("quarantine_rows")
    # Measures are projected once; the facts below refer to them by name.
    measured = observations.withColumns(
        {
            "age": snapshot_age(F.col("source_snapshot_committed_at"), F.col("data_interval_end")),
            "invalid_ratio": ratio9(invalid, rows),
            "quarantine_ratio": ratio9(quarantine, rows),
        }
    ).withColumns(
        {
            "invalid_status": status_of_ratio(F.col("invalid_ratio")),
            "quarantine_status": status_of_ratio(F.col("quarantine_ratio")),
        }
    )
    age, width = F.col("age"), len(TRIP_SCHEMA.fields)
    invalid_ratio, invalid_status = F.col("invalid_ratio"), F.col("invalid_status")
    quarantine_ratio, quarantine_status = F.col("quarantine_ratio"), F.col("quarantine_status")

    bronze = [
        _fact("bronze.source_available.v1", rows, None, whole9(rows), "pass", "ok"),
        _fact("bronze.schema.v1", width, width, one, "pass", "ok"),
        _fact("bronze.snapshot_freshness.v1", age, FRESH_SECONDS, whole9(age), "pass", "ok"),
        _fact("bronze.invalid_ratio.v1", invalid, rows, invalid_ratio, invalid_status, ratio_diagnostic(invalid_status)),
    ]
    silver = [
        _fact("silver.partition_conservation.v1", clean + quarantine, rows, one, "pass", "ok"),
        _fact(
            "silver.clean_nonempty.v1", clean, rows, whole9(clean),
            F.when(clean > 0, "pass").otherwise("fail"), F.when(clean > 0, "ok").otherwise("output_empty"),
        ),
        _fact("silver.quarantine_ratio.v1", quarantine, rows, quarantine_ratio, quarantine_status, ratio_diagnostic(quarantine_status)),
        _fact("silver.output_readback.v1", READBACK_CHECKS, READBACK_CHECKS, one, "pass", "ok"),
    ]
    zero = F.lit("0.000000000")
    missing = [_fact("bronze.source_available.v1", None, None, None, "missing", "source_missing")]
    stale = [_fact("bronze.snapshot_freshness.v1", age, FRESH_SECONDS, whole9(age), "stale", "source_stale")]
    drifted = [_fact("bronze.schema.v1", 0, width, zero, "fail", "schema_mismatch")]
    empty = [_fact("bronze.source_available.v1", 0, None, zero, "fail", "threshold_fail")]
    broken = [_fact("silver.partition_conservation.v1", None, rows, None, "fail", "partition_mismatch")]

    outcome = (
        F.when(F.col("source_snapshot_id").isNull(), F.array(*missing))
        .when(age > FRESH_SECONDS, F.array(*stale))
        .when(~F.col("schema_matches"), F.array(*drifted))
        .when(rows <= 0, F.array(*empty))
        .when(invalid_status == "fail", F.array(*bronze))
        .when(clean + quarantine != rows, F.array(*broken))
        .otherwise(F.array(*bronze, *silver))
    )
    facts = measured.select(
        run_id(F.col("logical_date"), F.col("source_snapshot_id")).alias("quality_run_id"),
        *OBSERVATION_COLUMNS[:5],
        F.inline(outcome),
    )
    described = facts.join(F.broadcast(rules_frame(observations.sparkSession)), "rule_id").withColumns(
        {
            "dataset_id": F.lit(DATASET_ID),
            "binding_type": F.lit(BINDING_TYPE),
            "upstream_dag_id": F.lit(UPSTREAM_JOB),
            "source_table": F.lit(SOURCE_TABLE),
            "rule_version": F.lit(RULE_VERSION),
            "severity": severity(F.col("status")),
        }
    )
    return described.select(*FACT_NAMES)


def overall_status(facts: DataFrame) -> DataFrame:
    """Worst status per run."""
    worst = F.max(F.struct(status_rank(F.col("status")).alias("rank"), "status"))
    return facts.groupBy("quality_run_id").agg(worst["status"].alias("overall_status"))


def outcome_violations(facts: DataFrame) -> DataFrame:
    """Facts whose rule, status and diagnostic code are not a governed combination."""
    governed = F.broadcast(
        facts.sparkSession.createDataFrame(GOVERNED_OUTCOMES, "rule_id string, status string, diagnostic_code string")
    )
    return facts.join(governed, ["rule_id", "status", "diagnostic_code"], "left_anti")
