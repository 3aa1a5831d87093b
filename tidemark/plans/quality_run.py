"""A whole data-quality run: capture, gates, split, write, readback proof, facts.

Every gate is decided before anything is written to the outputs. The source is read twice: once
for all counts and fingerprints, once for the single write that splits it into valid and invalid
rows. The readback is proved by fingerprints, without a shuffle, or row by row when asked.
"""

from __future__ import annotations

import dataclasses
import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.changes import merge_checks, merge_upsert
from tidemark.operators.checks import ContractError, require_exact_schema, require_passed
from tidemark.operators.multiset import (
    FINGERPRINT_NAMES,
    check_rows,
    fingerprint_columns,
    partition_report,
    same_rows,
)

DIAGNOSTIC_CODES = sorted({code for _, _, code in quality.GOVERNED_OUTCOMES})
REFUSING = ("fail", "stale", "missing")


@dataclasses.dataclass(frozen=True)
class Head:
    """Version of the source a run works on; times are canonical UTC text."""

    snapshot_id: int
    committed_at: str
    schema_sha256: str


@dataclasses.dataclass(frozen=True)
class RunRequest:
    logical_date: str
    data_interval_end: str
    output: str
    facts: str
    exact_proof: bool = True


class QualityFailure(RuntimeError):
    """A gate refused the run; its facts have been stored."""

    def __init__(self, status: str, diagnostic: str):
        super().__init__(f"quality run stopped: {status} ({diagnostic})")
        self.status = status
        self.diagnostic = diagnostic


def _observation(spark: SparkSession, request: RunRequest, head: Head | None, matches: bool, counts: dict) -> DataFrame:
    kinds = "logical_date string, data_interval_end string, source_snapshot_id long, committed string, " \
        "source_schema_sha256 string, schema_matches boolean, source_rows long, invalid_rows long, " \
        "clean_rows long, quarantine_rows long"
    row = (
        request.logical_date,
        request.data_interval_end,
        head.snapshot_id if head else None,
        head.committed_at if head else None,
        head.schema_sha256 if head else None,
        matches,
        *[counts.get(name, 0) for name in ("source_rows", "invalid_rows", "clean_rows", "quarantine_rows")],
    )
    return (
        spark.createDataFrame([row], kinds)
        .withColumnsRenamed({"committed": "source_snapshot_committed_at"})
        .withColumns(
            {
                name: F.col(name).cast("timestamp")
                for name in ("logical_date", "data_interval_end", "source_snapshot_committed_at")
            }
        )
        .select(*quality.OBSERVATION_COLUMNS)
    )


def store_facts(facts: DataFrame, run: str, path: str) -> DataFrame:
    """Merge one run's facts into the fact table on (run, rule) and return the stored run.

    The table is partitioned by run, so the merge reads and replaces that run's few rows only.
    """
    spark = facts.sparkSession
    allowed = {"status": quality.STATUS_ORDER, "diagnostic_code": DIAGNOSTIC_CODES}
    ungoverned = quality.outcome_violations(facts).agg(F.count(F.lit(1)).alias("outcome_not_governed"))
    require_passed(
        merge_checks(facts, ["quality_run_id", "rule_id"], "quality_run_id", quality.MAX_BATCH_FACTS, allowed).unionByName(
            check_rows(ungoverned)
        )
    )
    merged = merge_upsert(read_facts(spark, path, run), facts, ["quality_run_id", "rule_id"])
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("quality_run_id")
        .parquet(path)
    )
    return read_facts(spark, path, run)


def ensure_facts(spark: SparkSession, path: str) -> None:
    """An empty fact table when there is none."""
    empty = spark.createDataFrame([], quality.FACT_SCHEMA)
    empty.write.mode("ignore").partitionBy("quality_run_id").parquet(path)


def read_facts(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    facts = spark.read.schema(quality.FACT_SCHEMA).parquet(path).select(*quality.FACT_NAMES)
    return facts.where(F.col("quality_run_id") == run) if run is not None else facts


def _prints(frame: DataFrame, *flags: str) -> dict:
    """Fingerprint of the trip columns per combination of the flag columns."""
    aggregates = fingerprint_columns(quality.TRIP_SCHEMA.fieldNames())
    found = frame.groupBy(*flags).agg(*aggregates).collect()
    return {tuple(row[flag] for flag in flags): tuple(row[name] for name in FINGERPRINT_NAMES) for row in found}


def _counts(prints: dict) -> dict:
    clean, bad = (prints.get((side,), (0,))[0] for side in (True, False))
    return {"source_rows": clean + bad, "invalid_rows": bad, "clean_rows": clean, "quarantine_rows": bad}


def _age_seconds(head: Head, request: RunRequest) -> int:
    """Whole seconds from the commit to the end of the interval, rounded down."""
    end, commit = (datetime.datetime.fromisoformat(text) for text in (request.data_interval_end, head.committed_at))
    return (end - commit) // datetime.timedelta(seconds=1)


def run_quality(
    spark: SparkSession,
    request: RunRequest,
    capture: Callable[[], Head | None],
    read: Callable[[], DataFrame],
) -> DataFrame:
    """Run all gates; returns the run's stored facts or raises ``QualityFailure``.

    A failure after the gates, such as a source that changed meanwhile, is stored as one failed fact.
    """
    ensure_facts(spark, request.facts)

    def decide(observation: DataFrame) -> list:
        """The facts of this run, eight at most, with the gates' verdict in their status."""
        return quality.run_facts(observation).collect()

    def finish(rows: list) -> DataFrame:
        facts = spark.createDataFrame(rows, quality.FACT_SCHEMA)
        stored = store_facts(facts, rows[0]["quality_run_id"], request.facts)
        if not same_rows(facts, stored):
            raise ContractError("stored facts differ from the intended ones")
        for row in rows:
            if row["status"] in REFUSING:
                raise QualityFailure(row["status"], row["diagnostic_code"])
        return stored

    def diagnose(rows: list, rule: str, diagnostic: str) -> None:
        """Store one failed fact without a metric, then stop."""
        known = next(row.asDict() for row in rows if row["rule_id"] == rule)
        measures = dict.fromkeys(["metric_numerator", "metric_denominator", "metric_value"])
        failed = {"status": "fail", "severity": quality.SEVERITY["fail"], "diagnostic_code": diagnostic}
        finish([Row(**(known | measures | failed))])

    def refuse(observation: DataFrame) -> None:
        finish(decide(observation))
        raise AssertionError("a refused run cannot finish")

    head = capture()
    if head is None:
        refuse(_observation(spark, request, None, False, {}))
    if _age_seconds(head, request) > quality.FRESH_SECONDS:
        refuse(_observation(spark, request, head, True, {}))

    bronze = read()
    try:
        require_exact_schema(bronze, quality.TRIP_SCHEMA)
    except ContractError:
        refuse(_observation(spark, request, head, False, {}))
    valid = quality.trip_rule()
    prints = _prints(bronze.withColumn("valid", valid), "valid")
    rows = decide(_observation(spark, request, head, True, _counts(prints)))
    if any(row["status"] in REFUSING for row in rows):
        finish(rows)

    parts = f"{request.output}/snapshot={head.snapshot_id}"
    bronze.withColumn("valid", valid).write.mode("overwrite").partitionBy("valid").parquet(parts)
    stored = _prints(read_parts(spark, parts).withColumn("judged", valid), "valid", "judged")
    if stored != {(side, side): found for (side,), found in prints.items()}:
        diagnose(rows, "silver.output_readback.v1", "readback_mismatch")
    if request.exact_proof:
        clean, quarantine = (read_part(spark, parts, side) for side in (True, False))
        if not partition_report(bronze, clean, quarantine, valid).where("violations > 0").isEmpty():
            diagnose(rows, "silver.output_readback.v1", "readback_mismatch")
    if capture() != head:
        diagnose(rows, "silver.output_readback.v1", "readback_mismatch")
    return finish(rows)


def read_parts(spark: SparkSession, parts: str) -> DataFrame:
    """Both parts of a run; ``valid`` tells them apart."""
    return spark.read.schema(f"{quality.TRIP_SCHEMA.toDDL()}, valid BOOLEAN").parquet(parts)


def read_part(spark: SparkSession, parts: str, valid: bool) -> DataFrame:
    """The clean or the quarantined rows of a run, with the contract's columns."""
    return read_parts(spark, parts).where(F.col("valid") == valid).select(*quality.TRIP_SCHEMA.fieldNames())
