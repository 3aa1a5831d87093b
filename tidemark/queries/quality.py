"""Governed quality runs and their reports. Orders by month stand for the runs of a source."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.predicates import positive_within
from tidemark.operators import quality
from tidemark.operators.multiset import partition_report
from tidemark.plans import dashboards
from tidemark.plans.quality_run import Head, RunRequest, run_quality
from tidemark.queries.registry import query, table
from tidemark.session import shared_folder

VALID_SQL = "coalesce(isfinite(l_extendedprice) AND isfinite(l_quantity) AND l_extendedprice > 0 AND l_quantity BETWEEN 1 AND 45, false)"


def _valid_line():
    return positive_within("l_extendedprice", "l_quantity", 1, 45)


@query("quality_split", f"SELECT *, CASE WHEN {VALID_SQL} THEN 'clean' ELSE 'quarantine' END AS part FROM lineitem")
def quality_split(spark, folder):
    clean, quarantine = quality.split(table(spark, folder, "lineitem"), _valid_line())
    return clean.withColumn("part", F.lit("clean")).unionByName(quarantine.withColumn("part", F.lit("quarantine")))


@query(
    "quality_counts",
    f"""
    SELECT count(*) AS source_rows, count(*) FILTER (WHERE NOT {VALID_SQL}) AS invalid_rows,
           count(*) FILTER (WHERE {VALID_SQL}) AS clean_rows, count(*) FILTER (WHERE NOT {VALID_SQL}) AS quarantine_rows
    FROM lineitem
    """,
)
def quality_counts(spark, folder):
    return quality.split_counts(table(spark, folder, "lineitem"), _valid_line())


@query(
    "partition_proof",
    f"""
    WITH source AS (SELECT *, {VALID_SQL} AS ok FROM lineitem),
    clean AS (SELECT * FROM source WHERE l_quantity <= 45), bad AS (SELECT * FROM source WHERE l_quantity > 44),
    found AS (
        SELECT 'clean_holds_invalid' AS "check", (SELECT count(*) FROM clean WHERE NOT ok) AS violations
        UNION ALL SELECT 'quarantine_holds_valid', (SELECT count(*) FROM bad WHERE ok)
        UNION ALL SELECT 'rows_omitted', (SELECT count(*) FROM (
            SELECT * FROM source EXCEPT ALL SELECT * FROM (SELECT * FROM clean UNION ALL SELECT * FROM bad)))
        UNION ALL SELECT 'rows_added', (SELECT count(*) FROM (
            SELECT * FROM (SELECT * FROM clean UNION ALL SELECT * FROM bad) EXCEPT ALL SELECT * FROM source)))
    SELECT "check", violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def partition_proof(spark, folder):
    """A faulty split on purpose: rows with quantity 45 land on both sides."""
    lines = table(spark, folder, "lineitem")
    clean, bad = lines.where(F.col("l_quantity") <= 45), lines.where(F.col("l_quantity") > 44)
    return partition_report(lines, clean, bad, _valid_line())


# --- monthly runs -------------------------------------------------------------------------------

OBSERVED_SQL = f"""
    SELECT month AS logical_date, month + INTERVAL 1 MONTH AS data_interval_end,
           cast(year(month) * 100 + month(month) AS bigint) AS snapshot,
           month + INTERVAL 1 MONTH - to_milliseconds(cast(month(month) * 1900000 + 731 AS bigint)) AS committed,
           n, bad, n - bad AS good
    FROM (
        SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n,
               count(*) FILTER (WHERE o_totalprice <= CASE WHEN month(o_orderdate) % 3 = 0 THEN 26000 ELSE 6000 END) AS bad
        FROM orders GROUP BY 1)
"""

FACTS_SQL = f"""
    WITH o AS ({OBSERVED_SQL}),
    m AS (
        SELECT *, cast(floor(date_diff('millisecond', committed, data_interval_end) / 1000.0) AS bigint) AS age,
               cast(round(cast(bad AS double) / n, 9) AS decimal(38,9)) AS ratio,
               sha256('nyc_taxi' || chr(10) || strftime(logical_date, '%Y-%m-%dT%H:%M:%SZ') || chr(10) || snapshot ||
                      chr(10) || 'nyc_taxi_quality_v1') AS run
        FROM o),
    g AS (SELECT *, CASE WHEN ratio > 0.05 THEN 'fail' WHEN ratio > 0.01 THEN 'warn' ELSE 'pass' END AS mark FROM m),
    d AS (SELECT *, CASE WHEN age > 21600 THEN 'stale' WHEN mark = 'fail' THEN 'refused' ELSE 'full' END AS outcome,
                 CASE mark WHEN 'pass' THEN 'ok' ELSE 'threshold_' || mark END AS code FROM g),
    x AS (
        SELECT run, 'bronze.snapshot_freshness.v1' AS rule_id, age AS num, 21600 AS den, cast(age AS decimal(38,9)) AS val,
               'stale' AS status, 'source_stale' AS code, d.* EXCLUDE (run, code) FROM d WHERE outcome = 'stale'
        UNION ALL SELECT run, 'bronze.source_available.v1', n, NULL, n, 'pass', 'ok', d.* EXCLUDE (run, code) FROM d WHERE outcome <> 'stale'
        UNION ALL SELECT run, 'bronze.schema.v1', 20, 20, 1, 'pass', 'ok', d.* EXCLUDE (run, code) FROM d WHERE outcome <> 'stale'
        UNION ALL SELECT run, 'bronze.snapshot_freshness.v1', age, 21600, age, 'pass', 'ok', d.* EXCLUDE (run, code) FROM d WHERE outcome <> 'stale'
        UNION ALL SELECT run, 'bronze.invalid_ratio.v1', bad, n, ratio, mark, code, d.* EXCLUDE (run, code) FROM d WHERE outcome <> 'stale'
        UNION ALL SELECT run, 'silver.partition_conservation.v1', n, n, 1, 'pass', 'ok', d.* EXCLUDE (run, code) FROM d WHERE outcome = 'full'
        UNION ALL SELECT run, 'silver.clean_nonempty.v1', good, n, good, 'pass', 'ok', d.* EXCLUDE (run, code) FROM d WHERE outcome = 'full'
        UNION ALL SELECT run, 'silver.quarantine_ratio.v1', bad, n, ratio, mark, code, d.* EXCLUDE (run, code) FROM d WHERE outcome = 'full'
        UNION ALL SELECT run, 'silver.output_readback.v1', 8, 8, 1, 'pass', 'ok', d.* EXCLUDE (run, code) FROM d WHERE outcome = 'full'),
    rules(rule_id, layer, owner, metric_name, warn_threshold, fail_threshold) AS (VALUES
        ('bronze.source_available.v1', 'Bronze', 'Data Engineering', 'source_row_count', NULL, 'rows=0'),
        ('bronze.schema.v1', 'Bronze', 'Data Engineering', 'schema_match_ratio', NULL, 'ratio<1.000000000'),
        ('bronze.snapshot_freshness.v1', 'Bronze', 'Data Engineering', 'snapshot_age_seconds', NULL, 'seconds>21600'),
        ('bronze.invalid_ratio.v1', 'Bronze', 'Data Quality Engineering', 'invalid_row_ratio', 'ratio>0.010000000', 'ratio>0.050000000'),
        ('silver.partition_conservation.v1', 'Silver', 'Data Quality Engineering', 'partition_row_ratio', NULL, 'ratio!=1.000000000'),
        ('silver.clean_nonempty.v1', 'Silver', 'Data Quality Engineering', 'clean_row_count', NULL, 'rows=0'),
        ('silver.quarantine_ratio.v1', 'Silver', 'Data Quality Engineering', 'quarantine_row_ratio', 'ratio>0.010000000', 'ratio>0.050000000'),
        ('silver.output_readback.v1', 'Silver', 'Data Platform Engineering', 'readback_check_ratio', NULL, 'ratio<1.000000000'))
    SELECT run AS quality_run_id, logical_date, data_interval_end, 'nyc_taxi' AS dataset_id,
           'iceberg_snapshot' AS binding_type, 'nyc_taxi_etl' AS upstream_dag_id,
           'lakehouse.bronze.nyc_taxi_trips' AS source_table, snapshot AS source_snapshot_id,
           committed AS source_snapshot_committed_at, '{quality.TRIP_SCHEMA_SHA256}' AS source_schema_sha256, layer,
           rule_id, 'nyc_taxi_quality_v1' AS rule_version, owner, metric_name, cast(num AS bigint) AS metric_numerator,
           cast(den AS bigint) AS metric_denominator, cast(val AS decimal(38,9)) AS metric_value, warn_threshold,
           fail_threshold, CASE status WHEN 'pass' THEN 'info' WHEN 'warn' THEN 'warning' ELSE 'error' END AS severity,
           status, code AS diagnostic_code
    FROM x JOIN rules USING (rule_id)
"""


def monthly_observations(spark, folder):
    """One run per order month; the threshold, and with it the outcome, differs by month."""
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    cutoff = F.when(F.month("o_orderdate") % 3 == 0, 26000).otherwise(6000)
    per_month = (
        table(spark, folder, "orders")
        .groupBy(month.alias("logical_date"))
        .agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(F.col("o_totalprice") <= cutoff).alias("invalid_rows"))
    )
    end = F.col("logical_date") + F.expr("INTERVAL 1 MONTH")
    lag = F.make_dt_interval(secs=F.month("logical_date") * 1900 + F.lit("0.731").cast("decimal(18,6)"))
    return per_month.select(
        "logical_date",
        end.alias("data_interval_end"),
        (F.year("logical_date") * 100 + F.month("logical_date")).cast("long").alias("source_snapshot_id"),
        (end - lag).alias("source_snapshot_committed_at"),
        F.lit(quality.TRIP_SCHEMA_SHA256).alias("source_schema_sha256"),
        F.lit(True).alias("schema_matches"),
        "source_rows",
        "invalid_rows",
        (F.col("source_rows") - F.col("invalid_rows")).alias("clean_rows"),
        F.col("invalid_rows").alias("quarantine_rows"),
    )


def monthly_facts(spark, folder):
    return quality.run_facts(monthly_observations(spark, folder))


@query("quality_facts", FACTS_SQL)
def quality_facts(spark, folder):
    return monthly_facts(spark, folder)


@query(
    "quality_overall",
    f"""
    SELECT quality_run_id, arg_max(status, CASE status WHEN 'pass' THEN 1 WHEN 'warn' THEN 2 WHEN 'fail' THEN 3
           WHEN 'stale' THEN 4 ELSE 5 END) AS overall_status
    FROM ({FACTS_SQL}) GROUP BY quality_run_id
    """,
)
def quality_overall(spark, folder):
    return quality.overall_status(monthly_facts(spark, folder))


def _tampered(facts):
    """Facts with defects that make otherwise complete runs unacceptable."""
    february = (F.month("logical_date") == 2) & (F.col("rule_id") == "silver.output_readback.v1")
    may = (F.month("logical_date") == 5) & (F.col("rule_id") == "bronze.schema.v1")
    july = F.month("logical_date") == 7
    return facts.withColumns(
        {
            "metric_numerator": F.when(february, F.lit(7).cast("long")).otherwise(F.col("metric_numerator")),
            "warn_threshold": F.when(may, "ratio>0.5").otherwise(F.col("warn_threshold")),
            "dataset_id": F.when(july, "other").otherwise(F.col("dataset_id")),
        }
    )


TAMPERED_SQL = f"""
    SELECT * REPLACE (
        CASE WHEN month(logical_date) = 2 AND rule_id = 'silver.output_readback.v1' THEN 7 ELSE metric_numerator END AS metric_numerator,
        CASE WHEN month(logical_date) = 5 AND rule_id = 'bronze.schema.v1' THEN 'ratio>0.5' ELSE warn_threshold END AS warn_threshold,
        CASE WHEN month(logical_date) = 7 THEN 'other' ELSE dataset_id END AS dataset_id)
    FROM ({FACTS_SQL})
"""

# Acceptance in SQL: per-fact verdicts first, then one condition per run.
ACCEPTED_SQL = f"""
    WITH facts AS ({TAMPERED_SQL}),
    expected(rule_id, layer, owner, metric_name, warn_threshold, fail_threshold) AS (VALUES
        ('bronze.source_available.v1', 'Bronze', 'Data Engineering', 'source_row_count', NULL, 'rows=0'),
        ('bronze.schema.v1', 'Bronze', 'Data Engineering', 'schema_match_ratio', NULL, 'ratio<1.000000000'),
        ('bronze.snapshot_freshness.v1', 'Bronze', 'Data Engineering', 'snapshot_age_seconds', NULL, 'seconds>21600'),
        ('bronze.invalid_ratio.v1', 'Bronze', 'Data Quality Engineering', 'invalid_row_ratio', 'ratio>0.010000000', 'ratio>0.050000000'),
        ('silver.partition_conservation.v1', 'Silver', 'Data Quality Engineering', 'partition_row_ratio', NULL, 'ratio!=1.000000000'),
        ('silver.clean_nonempty.v1', 'Silver', 'Data Quality Engineering', 'clean_row_count', NULL, 'rows=0'),
        ('silver.quarantine_ratio.v1', 'Silver', 'Data Quality Engineering', 'quarantine_row_ratio', 'ratio>0.010000000', 'ratio>0.050000000'),
        ('silver.output_readback.v1', 'Silver', 'Data Platform Engineering', 'readback_check_ratio', NULL, 'ratio<1.000000000')),
    judged AS (
        SELECT f.*, e.rule_id IS NOT NULL AS known,
            CASE f.rule_id
                WHEN 'bronze.source_available.v1' THEN metric_numerator > 0 AND metric_denominator IS NULL AND metric_value = metric_numerator
                WHEN 'bronze.schema.v1' THEN metric_numerator = 20 AND metric_denominator = 20 AND metric_value = 1
                WHEN 'bronze.snapshot_freshness.v1' THEN metric_numerator <= 21600 AND metric_denominator = 21600
                    AND metric_numerator = floor(date_diff('millisecond', source_snapshot_committed_at, data_interval_end) / 1000.0)
                    AND metric_value = metric_numerator
                WHEN 'silver.partition_conservation.v1' THEN metric_numerator > 0 AND metric_numerator = metric_denominator AND metric_value = 1
                WHEN 'silver.clean_nonempty.v1' THEN metric_numerator > 0 AND metric_denominator > 0 AND metric_value = metric_numerator
                WHEN 'silver.output_readback.v1' THEN metric_numerator = 8 AND metric_denominator = 8 AND metric_value = 1
                ELSE metric_numerator BETWEEN 0 AND metric_denominator AND metric_denominator > 0
                    AND metric_value = cast(round(cast(metric_numerator AS double) / metric_denominator, 9) AS decimal(38,9))
            END AS shaped,
            CASE WHEN f.rule_id IN ('bronze.invalid_ratio.v1', 'silver.quarantine_ratio.v1') AND metric_value > 0.01
                THEN metric_value <= 0.05 AND status = 'warn' AND severity = 'warning' AND diagnostic_code = 'threshold_warn'
                ELSE status = 'pass' AND severity = 'info' AND diagnostic_code = 'ok' END AS verdict
        FROM facts f LEFT JOIN expected e ON f.rule_id = e.rule_id AND f.rule_version = 'nyc_taxi_quality_v1'
            AND f.layer = e.layer AND f.owner = e.owner AND f.metric_name = e.metric_name
            AND f.warn_threshold IS NOT DISTINCT FROM e.warn_threshold AND f.fail_threshold = e.fail_threshold),
    runs AS (
        SELECT quality_run_id, max(logical_date) AS logical_date, max(source_snapshot_id) AS source_snapshot_id,
            map_from_entries(list({{'k': rule_id, 'v': metric_numerator}})) AS num,
            map_from_entries(list({{'k': rule_id, 'v': metric_denominator}})) AS den,
            map_from_entries(list({{'k': rule_id, 'v': metric_value}})) AS val,
            bool_or(status = 'warn') AS warned
        FROM judged GROUP BY quality_run_id
        HAVING count(*) = 8 AND count(DISTINCT rule_id) = 8 AND bool_and(known) AND bool_and(coalesce(shaped, false))
            AND bool_and(coalesce(verdict, false))
            AND count(*) FILTER (WHERE dataset_id = 'nyc_taxi' AND binding_type = 'iceberg_snapshot'
                AND upstream_dag_id = 'nyc_taxi_etl' AND source_table = 'lakehouse.bronze.nyc_taxi_trips'
                AND source_schema_sha256 = '{quality.TRIP_SCHEMA_SHA256}' AND source_snapshot_id > 0) = 8
            AND count(source_snapshot_committed_at) = 8 AND count(DISTINCT source_snapshot_committed_at) = 1
            AND count(DISTINCT source_snapshot_id) = 1 AND count(DISTINCT logical_date) = 1
            AND count(data_interval_end) = 8 AND count(DISTINCT data_interval_end) = 1
            AND quality_run_id = sha256('nyc_taxi' || chr(10) || strftime(max(logical_date), '%Y-%m-%dT%H:%M:%SZ') ||
                chr(10) || max(source_snapshot_id) || chr(10) || 'nyc_taxi_quality_v1')),
    accepted AS (
        SELECT *, num['bronze.source_available.v1'] AS total FROM runs
        WHERE den['bronze.invalid_ratio.v1'] = num['bronze.source_available.v1']
            AND num['silver.partition_conservation.v1'] = num['bronze.source_available.v1']
            AND den['silver.clean_nonempty.v1'] = num['bronze.source_available.v1']
            AND den['silver.quarantine_ratio.v1'] = num['bronze.source_available.v1']
            AND num['bronze.invalid_ratio.v1'] = num['silver.quarantine_ratio.v1']
            AND num['silver.clean_nonempty.v1'] + num['silver.quarantine_ratio.v1'] = num['bronze.source_available.v1'])
"""


@query(
    "dq_latest",
    ACCEPTED_SQL
    + """
    SELECT quality_run_id, strftime(logical_date, '%Y-%m-%dT%H:%M:%SZ') AS logical_date_utc, source_snapshot_id, layer,
           rule_id, owner, metric_name, metric_numerator, metric_denominator, metric_value, warn_threshold,
           fail_threshold, severity, status, diagnostic_code
    FROM facts WHERE quality_run_id = (
        SELECT quality_run_id FROM accepted ORDER BY logical_date DESC, source_snapshot_id DESC, quality_run_id DESC LIMIT 1)
    """,
)
def dq_latest(spark, folder):
    return dashboards.latest_accepted(_tampered(monthly_facts(spark, folder)))


@query(
    "dq_trend",
    ACCEPTED_SQL
    + """
    SELECT quality_run_id, strftime(logical_date, '%Y-%m-%dT%H:%M:%SZ') AS logical_date_utc, source_snapshot_id,
           total AS source_row_count, num['bronze.invalid_ratio.v1'] AS invalid_row_count,
           cast(val['bronze.invalid_ratio.v1'] AS decimal(38,9)) AS invalid_ratio,
           num['silver.clean_nonempty.v1'] AS clean_row_count, num['silver.quarantine_ratio.v1'] AS quarantine_row_count,
           cast(val['silver.quarantine_ratio.v1'] AS decimal(38,9)) AS quarantine_ratio,
           CASE WHEN warned THEN 'warn' ELSE 'pass' END AS overall_status
    FROM accepted ORDER BY logical_date DESC, source_snapshot_id DESC, quality_run_id DESC LIMIT 90
    """,
)
def dq_trend(spark, folder):
    return dashboards.trend(_tampered(monthly_facts(spark, folder)))


@query(
    "dq_attention",
    f"""
    SELECT quality_run_id, strftime(logical_date, '%Y-%m-%dT%H:%M:%SZ') AS logical_date_utc, source_snapshot_id, layer,
           rule_id, status, severity, diagnostic_code, owner, metric_name, metric_numerator, metric_denominator,
           metric_value, warn_threshold, fail_threshold
    FROM ({TAMPERED_SQL})
    WHERE dataset_id = 'nyc_taxi' AND status <> 'pass'
    ORDER BY logical_date DESC, CASE status WHEN 'stale' THEN 3 WHEN 'fail' THEN 2 ELSE 1 END DESC, layer, rule_id
    LIMIT 100
    """,
)
def dq_attention(spark, folder):
    return dashboards.attention(_tampered(monthly_facts(spark, folder)))


@query(
    "dq_rejected",
    f"""
    WITH f AS ({TAMPERED_SQL}) SELECT quality_run_id, CASE
        WHEN count(*) <> 8 THEN 'incomplete' WHEN month(max(logical_date)) = 2 THEN 'silver_output_readback_v1_valid'
        WHEN month(max(logical_date)) = 5 THEN 'rules_known' ELSE 'dataset_id_expected' END AS broken
    FROM f GROUP BY quality_run_id HAVING count(*) <> 8 OR month(max(logical_date)) IN (2, 5, 7)
    """,
)
def dq_rejected(spark, folder):
    """Runs that are not accepted, with the invariant they break."""
    rejected = dashboards.rejected_runs(_tampered(monthly_facts(spark, folder)))
    incomplete = F.array_contains("broken", "has_eight_facts")
    return rejected.select(
        "quality_run_id", F.when(incomplete, "incomplete").otherwise(F.array_join("broken", ",")).alias("broken")
    )


TRIPS_SQL = """
    SELECT l_extendedprice - 1400 AS fare, least(l_linenumber, 6) AS passengers FROM lineitem
"""


def trips_from_lines(lines):
    """Trip rows with the full 20-column contract, derived from order lines."""
    values = {
        "VendorID": F.col("l_suppkey"),
        "tpep_pickup_datetime": F.col("l_shipdate"),
        "tpep_dropoff_datetime": F.col("l_shipdate") + F.make_dt_interval(mins=F.col("l_linenumber")),
        "passenger_count": F.least(F.col("l_linenumber"), F.lit(6)),
        "trip_distance": F.col("l_quantity"),
        "fare_amount": F.col("l_extendedprice") - 1400,
        "PULocationID": F.col("l_partkey"),
        "DOLocationID": F.col("l_orderkey"),
        "store_and_fwd_flag": F.col("l_returnflag"),
        "tip_amount": F.col("l_discount"),
        "mta_tax": F.col("l_tax"),
        "trip_date": F.to_date("l_shipdate"),
    }
    return lines.select(
        [
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in quality.TRIP_SCHEMA.fields
        ]
    )


@query(
    "quality_run",
    f"""
    WITH t AS ({TRIPS_SQL}),
    c AS (SELECT count(*) AS n, count(*) FILTER (WHERE NOT (fare > 0 AND passengers BETWEEN 1 AND 6)) AS bad FROM t),
    r AS (SELECT n, bad, n - bad AS good, cast(round(cast(bad AS double) / n, 9) AS decimal(38,9)) AS ratio FROM c),
    m AS (SELECT *, CASE WHEN ratio > 0.01 THEN 'warn' ELSE 'pass' END AS mark FROM r)
    SELECT 'bronze.source_available.v1' AS rule_id, cast(n AS bigint) AS metric_numerator, cast(NULL AS bigint) AS metric_denominator,
           cast(n AS decimal(38,9)) AS metric_value, 'pass' AS status FROM m
    UNION ALL SELECT 'bronze.schema.v1', 20, 20, 1, 'pass' FROM m
    UNION ALL SELECT 'bronze.snapshot_freshness.v1', 600, 21600, 600, 'pass' FROM m
    UNION ALL SELECT 'bronze.invalid_ratio.v1', bad, n, ratio, mark FROM m
    UNION ALL SELECT 'silver.partition_conservation.v1', n, n, 1, 'pass' FROM m
    UNION ALL SELECT 'silver.clean_nonempty.v1', good, n, good, 'pass' FROM m
    UNION ALL SELECT 'silver.quarantine_ratio.v1', bad, n, ratio, mark FROM m
    UNION ALL SELECT 'silver.output_readback.v1', 8, 8, 1, 'pass' FROM m
    """,
)
def quality_run(spark, folder):
    """The whole run: gates, split write, readback proof, facts merge and readback."""
    base = shared_folder(spark, "quality")
    head = Head(42, "2026-08-14 09:50:00", quality.TRIP_SCHEMA_SHA256)
    request = RunRequest("2026-08-14 00:00:00", "2026-08-14 10:00:00", f"{base}/silver", f"{base}/facts")
    trips_from_lines(table(spark, folder, "lineitem")).write.parquet(f"{base}/bronze")
    facts = run_quality(spark, request, lambda: head, lambda: spark.read.parquet(f"{base}/bronze"))
    return facts.select("rule_id", "metric_numerator", "metric_denominator", "metric_value", "status")
