"""Reports over quality facts: latest accepted run, trend of accepted runs, operator attention.

A run is accepted when every named invariant holds. The invariants are plain counts, minima and
maxima, so one hash aggregate over the facts decides all runs, and a rejected run says why.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import all_of, is_true
from tidemark.functions.values import ratio9, utc_text, whole9
from tidemark.operators.quality import (
    BINDING_TYPE,
    DATASET_ID,
    FRESH_SECONDS,
    GOVERNED_OUTCOMES,
    READBACK_CHECKS,
    RULE_VERSION,
    RULES,
    SEVERITY,
    SOURCE_TABLE,
    TRIP_SCHEMA,
    TRIP_SCHEMA_SHA256,
    UPSTREAM_JOB,
    WARN_RATIO,
    FAIL_RATIO,
    rules_frame,
    run_id,
    snapshot_age,
    status_rank,
)

TREND_RUNS = 90
ATTENTION_ROWS = 100


def _with_rule(facts: DataFrame, how: str) -> DataFrame:
    """Match each fact to the rule registry on all descriptive columns, one of them nullable."""
    rules = F.broadcast(rules_frame(facts.sparkSession).withColumn("rule_version", F.lit(RULE_VERSION)).alias("e"))
    same = [
        F.col(f"f.{name}") == F.col(f"e.{name}")
        for name in ("rule_id", "rule_version", "layer", "owner", "metric_name", "fail_threshold")
    ]
    same.append(F.col("f.warn_threshold").eqNullSafe(F.col("e.warn_threshold")))
    return facts.alias("f").join(rules, all_of(same), how)


def _passes(rule: str, *conditions: Column) -> Column:
    verdict = (F.col("status") == "pass") & (F.col("severity") == "info") & (F.col("diagnostic_code") == "ok")
    return all_of([F.col("rule_id") == rule, verdict, *conditions])


def _ratio_fact(rule: str) -> Column:
    numerator, denominator, value = F.col("metric_numerator"), F.col("metric_denominator"), F.col("metric_value")
    warn, fail = F.lit(WARN_RATIO).cast("decimal(38,9)"), F.lit(FAIL_RATIO).cast("decimal(38,9)")
    passing = _passes(rule, value <= warn)
    warning = all_of(
        [
            F.col("rule_id") == rule,
            value > warn,
            value <= fail,
            F.col("status") == "warn",
            F.col("severity") == "warning",
            F.col("diagnostic_code") == "threshold_warn",
        ]
    )
    counts = numerator.between(0, denominator) & (denominator > 0) & (value == ratio9(numerator, denominator))
    return counts & (passing | warning)


def run_invariants(facts: DataFrame) -> DataFrame:
    """One row per run: its key measures and one boolean column per acceptance invariant."""
    size = len(RULES)
    numerator, denominator, value = F.col("metric_numerator"), F.col("metric_denominator"), F.col("metric_value")
    width = len(TRIP_SCHEMA.fields)
    age = snapshot_age(F.col("source_snapshot_committed_at"), F.col("data_interval_end"))
    exact = value == whole9(numerator)
    unit = value == F.lit(1).cast("decimal(38,9)")

    shapes: Mapping[str, Column] = {
        "bronze.source_available.v1": _passes("bronze.source_available.v1", numerator > 0, denominator.isNull(), exact),
        "bronze.schema.v1": _passes("bronze.schema.v1", numerator == width, denominator == width, unit),
        "bronze.snapshot_freshness.v1": _passes(
            "bronze.snapshot_freshness.v1",
            numerator <= FRESH_SECONDS,
            denominator == FRESH_SECONDS,
            numerator == age,
            exact,
        ),
        "bronze.invalid_ratio.v1": _ratio_fact("bronze.invalid_ratio.v1"),
        "silver.partition_conservation.v1": _passes(
            "silver.partition_conservation.v1", numerator > 0, numerator == denominator, unit
        ),
        "silver.clean_nonempty.v1": _passes("silver.clean_nonempty.v1", numerator > 0, denominator > 0, exact),
        "silver.quarantine_ratio.v1": _ratio_fact("silver.quarantine_ratio.v1"),
        "silver.output_readback.v1": _passes(
            "silver.output_readback.v1", numerator == READBACK_CHECKS, denominator == READBACK_CHECKS, unit
        ),
    }
    constants = {
        "dataset_id": DATASET_ID,
        "binding_type": BINDING_TYPE,
        "upstream_dag_id": UPSTREAM_JOB,
        "source_table": SOURCE_TABLE,
        "source_schema_sha256": TRIP_SCHEMA_SHA256,
    }
    shared = ["source_snapshot_id", "source_snapshot_committed_at", "logical_date", "data_interval_end"]

    def of_rule(rule: str, part: str) -> Column:
        return F.max(F.when(F.col("f.rule_id") == rule, F.col(part)))

    matched = _with_rule(facts, "left").select("f.*", F.col("e.rule_id").alias("known_rule"))
    totals = matched.alias("f").groupBy("quality_run_id").agg(
        F.count(F.lit(1)).alias("n_facts"),
        F.count("known_rule").alias("n_known"),
        *[F.count_if(F.col(name) == text).alias(f"n_{name}") for name, text in constants.items()],
        *[F.count(name).alias(f"n_{name}") for name in shared],
        *[F.min(name).alias(f"min_{name}") for name in shared],
        *[F.max(name).alias(f"max_{name}") for name in shared],
        *[F.count_if(is_true(shape)).alias(f"n_{rule}") for rule, shape in shapes.items()],
        F.count_if(F.col("status") == "warn").alias("n_warn"),
        of_rule("bronze.source_available.v1", "metric_numerator").alias("source_row_count"),
        of_rule("bronze.invalid_ratio.v1", "metric_numerator").alias("invalid_row_count"),
        of_rule("bronze.invalid_ratio.v1", "metric_denominator").alias("invalid_base"),
        of_rule("bronze.invalid_ratio.v1", "metric_value").alias("invalid_ratio"),
        of_rule("silver.partition_conservation.v1", "metric_numerator").alias("partition_rows"),
        of_rule("silver.clean_nonempty.v1", "metric_numerator").alias("clean_row_count"),
        of_rule("silver.clean_nonempty.v1", "metric_denominator").alias("clean_base"),
        of_rule("silver.quarantine_ratio.v1", "metric_numerator").alias("quarantine_row_count"),
        of_rule("silver.quarantine_ratio.v1", "metric_denominator").alias("quarantine_base"),
        of_rule("silver.quarantine_ratio.v1", "metric_value").alias("quarantine_ratio"),
    )
    source = F.col("source_row_count")
    invariants = {
        "has_eight_facts": F.col("n_facts") == size,
        "rules_known": F.col("n_known") == size,
        **{f"{name}_expected": F.col(f"n_{name}") == size for name in constants},
        **{
            f"{name}_shared": (F.col(f"n_{name}") == size) & (F.col(f"min_{name}") == F.col(f"max_{name}"))
            for name in shared
        },
        "snapshot_positive": F.col("min_source_snapshot_id") > 0,
        "run_id_bound": F.col("quality_run_id") == run_id(F.col("max_logical_date"), F.col("max_source_snapshot_id")),
        **{f"{rule.replace('.', '_')}_valid": F.col(f"`n_{rule}`") == 1 for rule in shapes},
        "invalid_base_is_source": F.col("invalid_base") == source,
        "partition_is_source": F.col("partition_rows") == source,
        "clean_base_is_source": F.col("clean_base") == source,
        "quarantine_base_is_source": F.col("quarantine_base") == source,
        "quarantine_is_invalid": F.col("quarantine_row_count") == F.col("invalid_row_count"),
        "parts_add_up": F.col("clean_row_count") + F.col("quarantine_row_count") == source,
    }
    return totals.select(
        "quality_run_id",
        F.col("max_logical_date").alias("logical_date"),
        F.col("max_source_snapshot_id").alias("source_snapshot_id"),
        "source_row_count",
        "invalid_row_count",
        F.col("invalid_ratio").cast("decimal(38,9)").alias("invalid_ratio"),
        "clean_row_count",
        "quarantine_row_count",
        F.col("quarantine_ratio").cast("decimal(38,9)").alias("quarantine_ratio"),
        F.when(F.col("n_warn") > 0, "warn").otherwise("pass").alias("overall_status"),
        F.struct(*[is_true(rule).alias(name) for name, rule in invariants.items()]).alias("invariants"),
    )


def accepted_runs(facts: DataFrame) -> DataFrame:
    runs = run_invariants(facts)
    names = runs.schema["invariants"].dataType.fieldNames()
    return runs.where(all_of(F.col(f"invariants.{name}") for name in names)).drop("invariants")


def rejected_runs(facts: DataFrame) -> DataFrame:
    """Runs that are not accepted, with the names of the invariants they break."""
    runs = run_invariants(facts)
    names = runs.schema["invariants"].dataType.fieldNames()
    broken = F.array_compact(F.array(*[F.when(~F.col(f"invariants.{name}"), F.lit(name)) for name in names]))
    return runs.select("quality_run_id", broken.alias("broken")).where(F.size("broken") > 0)


def _newest(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("logical_date"), F.desc("source_snapshot_id"), F.desc("quality_run_id"))


def latest_accepted(facts: DataFrame) -> DataFrame:
    """The eight facts of the newest accepted run."""
    newest = _newest(accepted_runs(facts)).limit(1).select("quality_run_id")
    chosen = facts.join(newest, "quality_run_id", "left_semi")
    return (
        chosen.select(
            "quality_run_id",
            utc_text(F.col("logical_date")).alias("logical_date_utc"),
            "source_snapshot_id",
            "layer",
            "rule_id",
            "owner",
            "metric_name",
            "metric_numerator",
            "metric_denominator",
            F.col("metric_value").cast("decimal(38,9)").alias("metric_value"),
            "warn_threshold",
            "fail_threshold",
            "severity",
            "status",
            "diagnostic_code",
        )
        .orderBy("layer", "rule_id")
        .limit(len(RULES))
    )


def trend(facts: DataFrame, runs: int = TREND_RUNS) -> DataFrame:
    """The newest accepted runs, one row each."""
    return (
        _newest(accepted_runs(facts))
        .limit(runs)
        .select(
            "quality_run_id",
            utc_text(F.col("logical_date")).alias("logical_date_utc"),
            "source_snapshot_id",
            "source_row_count",
            "invalid_row_count",
            "invalid_ratio",
            "clean_row_count",
            "quarantine_row_count",
            "quarantine_ratio",
            "overall_status",
        )
    )


def attention(facts: DataFrame, rows: int = ATTENTION_ROWS) -> DataFrame:
    """Facts that need an operator: governed non-passing outcomes of known rules, newest and worst first."""
    spark = facts.sparkSession
    governed = spark.createDataFrame(
        [(rule, status, SEVERITY[status], code) for rule, status, code in GOVERNED_OUTCOMES if status != "pass"],
        "rule_id string, status string, severity string, diagnostic_code string",
    )
    known = _with_rule(facts, "inner").select("f.*").where(
        (F.col("dataset_id") == DATASET_ID)
        & (F.col("binding_type") == BINDING_TYPE)
        & (F.col("upstream_dag_id") == UPSTREAM_JOB)
        & (F.col("source_table") == SOURCE_TABLE)
    )
    flagged = known.join(F.broadcast(governed), ["rule_id", "status", "severity", "diagnostic_code"], "left_semi")
    return (
        flagged.orderBy(F.desc("logical_date"), status_rank(F.col("status")).desc(), "layer", "rule_id", "quality_run_id")
        .limit(rows)
        .select(
            "quality_run_id",
            utc_text(F.col("logical_date")).alias("logical_date_utc"),
            "source_snapshot_id",
            "layer",
            "rule_id",
            "status",
            "severity",
            "diagnostic_code",
            "owner",
            "metric_name",
            "metric_numerator",
            "metric_denominator",
            F.col("metric_value").cast("decimal(38,9)").alias("metric_value"),
            "warn_threshold",
            "fail_threshold",
        )
    )
