import datetime
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import predicates, values
from tidemark.operators import checks, multiset, quality
from tidemark.plans import dashboards
from tidemark.plans.quality_run import Head, QualityFailure, RunRequest, read_facts, read_part, run_quality

D = decimal.Decimal
NAN, INF = float("nan"), float("inf")
EDGE = [(10, 1), (10, 6), (10, 0), (10, 7), (0, 2), (-1, 2), (None, 2), (10, None), (NAN, 2), (INF, 2), (10, NAN), (10, -INF), (10, 2), (10, 2)]


def trips(spark, pairs):
    rows = [tuple(float(v) if v is not None else None for v in pair) for pair in pairs]
    frame = spark.createDataFrame(rows, "fare_amount double, passenger_count double")
    return frame.select(
        [
            (F.col(field.name) if field.name in frame.columns else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in quality.TRIP_SCHEMA.fields
        ]
    )


def test_split_is_null_safe_and_finite(spark, violations):
    source = trips(spark, EDGE)
    clean, quarantine = quality.split(source, quality.trip_rule())
    assert (clean.count(), quarantine.count()) == (4, 10)
    assert set(violations(multiset.partition_report(source, clean, quarantine, quality.trip_rule())).values()) == {0}
    faulty = multiset.partition_report(source, clean.unionAll(quarantine.limit(1)), quarantine, quality.trip_rule())
    found = violations(faulty)
    assert found["clean_holds_invalid"] == 1 and found["rows_added"] == 1 and found["rows_omitted"] == 0


def test_exploratory_rule_lets_nan_fares_pass(spark):
    source = trips(spark, EDGE)
    assert source.where(quality.trip_rule(require_finite=False)).count() == 6


def test_schema_digest_is_the_fixed_one():
    assert checks.schema_sha256(quality.TRIP_SCHEMA) == quality.TRIP_SCHEMA_SHA256


def _drifted():
    fields = quality.TRIP_SCHEMA.fields
    yield T.StructType(fields[::-1])
    yield T.StructType([T.StructField("VendorID", T.IntegerType()), *fields[1:]])
    yield T.StructType([T.StructField("vendorid", T.LongType()), *fields[1:]])
    yield T.StructType([T.StructField("VendorID", T.LongType(), False), *fields[1:]])
    yield T.StructType(fields[1:])
    yield T.StructType([*fields, T.StructField("extra_column", T.LongType())])
    yield T.StructType([fields[0], T.StructField("tpep_pickup_datetime", T.TimestampType()), *fields[2:]])


def test_schema_drift_is_rejected(spark):
    checks.require_exact_schema(spark.createDataFrame([], quality.TRIP_SCHEMA), quality.TRIP_SCHEMA)
    for schema in _drifted():
        with pytest.raises(checks.ContractError):
            checks.require_exact_schema(spark.createDataFrame([], schema), quality.TRIP_SCHEMA)


def test_fingerprint_ignores_order_and_sees_copies(spark):
    frame = spark.range(100).selectExpr("id", "cast(id as string) s")
    one = multiset.fingerprint(frame.repartition(3)).first()
    assert one == multiset.fingerprint(frame.orderBy(F.desc("id")).coalesce(1)).first()
    assert one != multiset.fingerprint(frame.unionAll(frame.limit(1))).first()
    empty = multiset.fingerprint(frame.limit(0)).first()
    assert tuple(empty) == (0, 0, 0, 0, 0)


def test_multiset_report(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, NAN)], "a int, b double")
    right = spark.createDataFrame([(1, None), (2, NAN), (3, 0.0)], "a int, b double")
    assert tuple(multiset.multiset_report(left, right).first()) == (1, 1, False)
    assert multiset.same_rows(left, left.repartition(3)) and not multiset.same_rows(left, right)


@pytest.mark.parametrize(
    "numerator, denominator, status",
    [(1, 100, "pass"), (10000001, 10**9, "warn"), (5, 100, "warn"), (50000001, 10**9, "fail"), (0, 7, "pass")],
)
def test_ratio_edges(spark, numerator, denominator, status):
    frame = spark.createDataFrame([(numerator, denominator)], "n long, d long")
    assert frame.select(quality.ratio_status(F.col("n"), F.col("d"))).first()[0] == status


@pytest.mark.parametrize("numerator, denominator", [(0, 0), (-1, 100), (None, 100), (1, None), (101, 100)])
def test_impossible_ratios_are_errors(spark, numerator, denominator):
    frame = spark.createDataFrame([(numerator, denominator)], "n long, d long")
    with pytest.raises(Exception, match="impossible ratio"):
        frame.select(quality.ratio_status(F.col("n"), F.col("d"))).collect()


def test_ratio_is_half_up_at_nine_digits(spark):
    frame = spark.createDataFrame([(2, 3), (1, 3), (1, 0)], "n long, d long")
    found = [row[0] for row in frame.select(values.ratio9(F.col("n"), F.col("d"))).collect()]
    assert found == [D("0.666666667"), D("0.333333333"), None]


@pytest.mark.parametrize(
    "committed, age, status",
    [
        ("2026-08-13 18:00:00", 21600, "pass"),
        ("2026-08-13 17:59:59", 21601, "stale"),
        ("2026-08-14 00:00:01", -1, "pass"),
        ("2026-08-14 00:00:21.731", -22, "pass"),
    ],
)
def test_freshness(spark, committed, age, status):
    frame = spark.createDataFrame([(committed, "2026-08-14 00:00:00")], "c string, e string").selectExpr(
        "cast(c as timestamp) c", "cast(e as timestamp) e"
    )
    found = frame.select(quality.snapshot_age(F.col("c"), F.col("e")).alias("a")).select("a", quality.freshness_status(F.col("a")))
    assert tuple(found.first()) == (age, status)


def test_finite_and_blank_predicates(spark):
    frame = spark.createDataFrame([(1.0, "a", None), (NAN, " ", "x"), (-INF, None, "y")], "v double, s string, t string")
    assert frame.where(predicates.is_finite("v")).count() == 1
    assert frame.where(predicates.any_blank(["s"])).count() == 2
    assert frame.where(predicates.any_null(["s", "t"])).count() == 2


# --- dashboards on accepted facts ---------------------------------------------------------------


def observation(spark, **changes):
    values = {
        "logical_date": "2026-08-14 00:00:00",
        "data_interval_end": "2026-08-14 10:00:00",
        "source_snapshot_id": 42,
        "source_snapshot_committed_at": "2026-08-14 10:00:21.731",
        "source_schema_sha256": quality.TRIP_SCHEMA_SHA256,
        "schema_matches": True,
        "source_rows": 100,
        "invalid_rows": 1,
        "clean_rows": 99,
        "quarantine_rows": 1,
    } | changes
    kinds = "string, string, long, string, string, boolean, long, long, long, long".split(", ")
    ddl = ", ".join(f"{name} {kind}" for name, kind in zip(values, kinds, strict=True))
    frame = spark.createDataFrame([tuple(values.values())], ddl)
    times = ["logical_date", "data_interval_end", "source_snapshot_committed_at"]
    return frame.withColumns({name: F.col(name).cast("timestamp") for name in times})


METRICS = [(100, None, D(100)), (20, 20, D(1)), (-22, 21600, D(-22)), (1, 100, D("0.01")), (100, 100, D(1)), (99, 100, D(99)), (1, 100, D("0.01")), (8, 8, D(1))]


def test_accepted_run_has_the_expected_facts(spark):
    facts = {row["rule_id"]: row for row in quality.run_facts(observation(spark)).collect()}
    found = [tuple(facts[rule[0]][n] for n in ("metric_numerator", "metric_denominator", "metric_value")) for rule in quality.RULES]
    assert found == METRICS
    assert {row["status"] for row in facts.values()} == {"pass"}


def test_accepted_run_is_reported(spark):
    facts = quality.run_facts(observation(spark)).cache()
    latest = dashboards.latest_accepted(facts).collect()
    assert [row["rule_id"] for row in latest] == sorted(rule[0] for rule in quality.RULES)
    assert latest[0]["logical_date_utc"] == "2026-08-14T00:00:00Z"
    trend = dashboards.trend(facts).collect()
    assert len(trend) == 1 and trend[0]["overall_status"] == "pass" and trend[0]["quarantine_ratio"] == D("0.010000000")
    assert dashboards.rejected_runs(facts).isEmpty() and dashboards.attention(facts).isEmpty()


MUTATIONS = {
    "lineage": (None, "upstream_dag_id", "'other_etl'"),
    "null lineage": ("bronze.schema.v1", "source_schema_sha256", "cast(null as string)"),
    "snapshot": ("bronze.schema.v1", "source_snapshot_id", "43L"),
    "metric": ("silver.clean_nonempty.v1", "metric_numerator", "98L"),
    "value": ("bronze.invalid_ratio.v1", "metric_value", "cast(0.02 as decimal(38,9))"),
    "status": ("bronze.schema.v1", "status", "'warn'"),
    "severity": ("bronze.schema.v1", "severity", "'error'"),
    "code": ("bronze.schema.v1", "diagnostic_code", "'threshold_warn'"),
    "threshold": ("bronze.invalid_ratio.v1", "warn_threshold", "cast(null as string)"),
    "run id": (None, "quality_run_id", "'0'"),
    "owner": ("bronze.schema.v1", "owner", "'Nobody'"),
}


def test_mutated_runs_are_rejected(spark):
    base = quality.run_facts(observation(spark)).cache()
    for name, (rule, column, value) in MUTATIONS.items():
        hit = F.lit(True) if rule is None else F.col("rule_id") == rule
        mutated = base.withColumn(column, F.when(hit, F.expr(value)).otherwise(F.col(column)))
        assert dashboards.accepted_runs(mutated).isEmpty(), name
    assert dashboards.accepted_runs(base.where("rule_id <> 'bronze.schema.v1'")).isEmpty()
    assert dashboards.accepted_runs(base.unionAll(base.limit(1))).isEmpty()


def _kinds(spark, **changes):
    rows = quality.run_facts(observation(spark, **changes)).collect()
    return sorted((row["rule_id"], row["status"], row["diagnostic_code"]) for row in rows if row["status"] != "pass"), len(rows)


def test_gates_in_order(spark):
    late = "2026-08-14 03:00:00"
    assert _kinds(spark, source_snapshot_id=None) == ([("bronze.source_available.v1", "missing", "source_missing")], 1)
    assert _kinds(spark, source_snapshot_committed_at=late, schema_matches=False)[0][0][1] == "stale"
    assert _kinds(spark, schema_matches=False, source_rows=0) == ([("bronze.schema.v1", "fail", "schema_mismatch")], 1)
    assert _kinds(spark, source_rows=0, invalid_rows=0) == ([("bronze.source_available.v1", "fail", "threshold_fail")], 1)
    assert _kinds(spark, invalid_rows=6) == ([("bronze.invalid_ratio.v1", "fail", "threshold_fail")], 4)
    assert _kinds(spark, clean_rows=98) == ([("silver.partition_conservation.v1", "fail", "partition_mismatch")], 1)
    warned, size = _kinds(spark, invalid_rows=5, quarantine_rows=5, clean_rows=95)
    assert [rule for rule, _, _ in warned] == ["bronze.invalid_ratio.v1", "silver.quarantine_ratio.v1"] and size == 8


def test_overall_status_takes_the_worst(spark):
    facts = spark.createDataFrame([("a", "pass"), ("a", "stale"), ("a", "fail"), ("b", "warn")], "quality_run_id string, status string")
    assert {tuple(row) for row in quality.overall_status(facts).collect()} == {("a", "stale"), ("b", "warn")}


def test_ungoverned_outcomes_are_found(spark):
    facts = quality.run_facts(observation(spark))
    assert quality.outcome_violations(facts).isEmpty()
    assert quality.outcome_violations(facts.withColumn("status", F.lit("stale"))).count() == 8


# --- the whole run ------------------------------------------------------------------------------

HEAD = Head(42, "2026-08-14 09:00:00", quality.TRIP_SCHEMA_SHA256)


def request(tmp_path, **changes):
    return RunRequest("2026-08-14 00:00:00", "2026-08-14 10:00:00", f"{tmp_path}/silver", f"{tmp_path}/facts", **changes)


def test_run_writes_parts_and_facts_and_can_be_repeated(spark, tmp_path):
    source = trips(spark, [(10, 2)] * 97 + [(0, 2)] * 3)
    for _ in range(2):
        facts = run_quality(spark, request(tmp_path), lambda: HEAD, lambda: source)
        assert facts.count() == 8
    parts = f"{tmp_path}/silver/snapshot=42"
    assert read_part(spark, parts, True).count() == 97 and read_part(spark, parts, False).count() == 3
    assert dashboards.trend(read_facts(spark, f"{tmp_path}/facts")).first()["overall_status"] == "warn"


def test_refused_runs_store_facts_and_write_nothing(spark, tmp_path):
    cases = {
        "missing": (None, trips(spark, [(1, 1)])),
        "stale": (Head(1, "2026-08-14 01:00:00", "x"), trips(spark, [(1, 1)])),
        "fail": (Head(2, "2026-08-14 09:00:00", "x"), trips(spark, [(1, 1), (0, 1)])),
    }
    for status, (head, source) in cases.items():
        with pytest.raises(QualityFailure) as failure:
            run_quality(spark, request(tmp_path), lambda head=head: head, lambda source=source: source)
        assert failure.value.status == status
    with pytest.raises(QualityFailure, match="schema_mismatch"):
        run_quality(spark, request(tmp_path), lambda: Head(3, "2026-08-14 09:00:00", "x"), lambda: trips(spark, [(1, 1)]).drop("extra"))
    assert not (tmp_path / "silver").exists()
    stored = read_facts(spark, f"{tmp_path}/facts")
    assert {row[0] for row in stored.select("status").collect()} == {"missing", "stale", "fail", "pass"}


def test_changed_source_stops_the_run(spark, tmp_path):
    heads = iter([HEAD, Head(43, "2026-08-14 09:30:00", "x")])
    with pytest.raises(QualityFailure, match="readback_mismatch"):
        run_quality(spark, request(tmp_path), lambda: next(heads), lambda: trips(spark, [(10, 2)]))
    (fact,) = read_facts(spark, f"{tmp_path}/facts").collect()
    assert (fact["rule_id"], fact["status"], fact["metric_value"]) == ("silver.output_readback.v1", "fail", None)


def test_canonical_text_forms(spark):
    frame = spark.createDataFrame([(D("10.50"),), (D("0.00"),), (D("100.00"),)], "d decimal(10,2)")
    plain = [row[0] for row in frame.select(values.plain_decimal_text(F.col("d"))).collect()]
    assert plain == ["10.5", "0", "100"]
    assert [row[0] for row in frame.select(values.fixed_decimal_text(F.col("d"), 3)).collect()] == ["10.500", "0.000", "100.000"]


def test_times_survive_only_in_canonical_form(spark):
    texts = ["2026-01-01T00:00:00Z", "2026-13-01T00:00:00Z", "2026-01-01T24:00:00Z", "2026-01-01T00:00:00+00:00"]
    frame = spark.createDataFrame([(text,) for text in texts], "t string")
    assert [row[0] for row in frame.select(predicates.is_canonical_event_time(F.col("t"))).collect()] == [True, False, False, False]


def test_interval_end_is_a_parameter(spark):
    assert isinstance(observation(spark).first()["data_interval_end"], datetime.datetime)
