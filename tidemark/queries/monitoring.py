"""Probe series, alerts, inventories and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import monitoring, retention
from tidemark.queries.registry import query, table


def _quantile_sql(window: int, step: int) -> str:
    return f"""
        WITH e AS (
            SELECT event_type, value, cast(ceil(epoch_us(ts) / {step * 1_000_000}.0) AS bigint) AS first_step FROM events),
        g AS (SELECT event_type, value, unnest(range(first_step, first_step + {window // step})) AS step FROM e)
        SELECT event_type, make_timestamp(step * {step * 1_000_000}) AS eval_time,
               quantile_cont(value, 0.95) AS quantile, count(*) AS samples
        FROM g GROUP BY event_type, step
    """


@query("rolling_p95", f"SELECT event_type, eval_time, round(quantile, 6) AS quantile, samples FROM ({_quantile_sql(600, 60)})")
def rolling_p95(spark, folder):
    """p95 over the last ten minutes, evaluated every minute."""
    points = monitoring.trailing_quantile(table(spark, folder, "events"), "event_type", "ts", "value", 0.95, 600, 60)
    return points.withColumn("quantile", F.round("quantile", 6))


@query(
    "monthly_p95",
    """
    WITH e AS (SELECT event_type, value, cast(ceil(epoch_us(ts) / 60000000.0) AS bigint) AS step FROM events),
    changes AS (SELECT event_type, step AS a FROM e UNION SELECT event_type, step + 43200 FROM e),
    spans AS (SELECT event_type, a, lead(a) OVER (PARTITION BY event_type ORDER BY a) AS b FROM changes),
    found AS (
        SELECT s.event_type, a, b, quantile_cont(value, 0.95) AS quantile, count(*) AS samples
        FROM spans s JOIN e ON e.event_type = s.event_type AND e.step > a - 43200 AND e.step <= a GROUP BY 1, 2, 3)
    SELECT event_type, make_timestamp(unnest(range(a, b)) * 60000000) AS eval_time, round(quantile, 6) AS quantile, samples
    FROM found
    """,
)
def monthly_p95(spark, folder):
    """p95 over the last thirty days, evaluated every minute."""
    points = monitoring.trailing_quantile(table(spark, folder, "events"), "event_type", "ts", "value", 0.95, 30 * 86400, 60)
    return points.withColumn("quantile", F.round("quantile", 6))


@query(
    "quantile_of_nulls",
    """
    SELECT event_type, round(quantile_cont(CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END, 0.9), 6) AS quantile,
           count(*) FILTER (WHERE event_id % 3 <> 0) AS samples FROM events GROUP BY 1
    """,
)
def quantile_of_nulls(spark, folder):
    """p90 of each kind of event, where a third of the values is unknown."""
    value = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    counts = table(spark, folder, "events").groupBy("event_type", value.alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    found = monitoring.counted_quantile(counts, ["event_type"], 0.9)
    return found.select("event_type", F.round("quantile", 6).alias("quantile"), "samples")


@query(
    "availability",
    """
    WITH e AS (
        SELECT user_id, cast(ceil(epoch_us(ts) / 3600000000.0) AS bigint) AS step, event_type <> 'error' AS ok FROM events),
    g AS (SELECT user_id, step, count(*) AS n, count(*) FILTER (WHERE ok) AS ok FROM e GROUP BY 1, 2)
    SELECT a.user_id, make_timestamp(a.step * 3600000000) AS eval_time, cast(sum(b.ok) AS bigint) AS successes,
           cast(sum(b.n) AS bigint) AS scrapes, round(sum(b.ok) / sum(b.n) * 100, 6) AS availability
    FROM g a JOIN g b ON a.user_id = b.user_id AND b.step > a.step - 168 AND b.step <= a.step
    GROUP BY 1, a.step
    """,
)
def availability(spark, folder):
    """Weekly availability per user, hourly; error events are scrapes without a success."""
    scrapes = table(spark, folder, "events").select("user_id", "ts", "event_type")
    successes = scrapes.where(F.col("event_type") != "error")
    points = monitoring.trailing_availability(scrapes, successes, "user_id", "ts", 7 * 86400, 3600)
    return points.withColumn("availability", F.round("availability", 6))


@query(
    "alert_runs",
    f"""
    WITH q AS (SELECT event_type, cast(epoch_us(eval_time) // 600000000 AS bigint) AS step, quantile
               FROM ({_quantile_sql(3600, 600)})),
    t AS (SELECT event_type, step, step - row_number() OVER (PARTITION BY event_type ORDER BY step) AS island
          FROM q WHERE quantile > 100),
    r AS (SELECT event_type, min(step) AS a, max(step) AS b, count(*) AS steps FROM t GROUP BY event_type, island)
    SELECT event_type, make_timestamp(a * 600000000) AS pending_from, make_timestamp((a + 3) * 600000000) AS firing_from,
           make_timestamp(b * 600000000) AS last_true, steps
    FROM r WHERE (b - a) * 600 >= 1800
    """,
)
def alert_runs(spark, folder):
    """Hourly p95 above 100 at every ten-minute step for at least half an hour."""
    points = monitoring.trailing_quantile(table(spark, folder, "events"), "event_type", "ts", "value", 0.95, 3600, 600)
    return monitoring.alert_runs(points, "event_type", "eval_time", F.col("quantile") > 100, 1800, 600)


def _digest_sql(lines: str, group: str) -> str:
    """Two-level digest of (group, line): entries, buckets by four hex digits, group."""
    return f"""
        SELECT {group}, sha256(string_agg(bucket || ':' || digest, ',' ORDER BY bucket || ':' || digest)) AS digest FROM (
            SELECT {group}, bucket, sha256(string_agg(entry, ',' ORDER BY entry)) AS digest FROM (
                SELECT {group}, entry, left(entry, 4) AS bucket FROM (
                    SELECT {group}, sha256(line || chr(10) || count(*)) AS entry FROM ({lines}) GROUP BY {group}, line))
            GROUP BY {group}, bucket)
        GROUP BY {group}
    """


INVENTORY_LINES = (
    "SELECT source, doc_id || chr(9) || n_chars || chr(9) || sha256(text) AS line FROM documents"
)


@query(
    "inventory_rollup",
    f"""
    WITH k AS (SELECT source, doc_id, count(*) AS n, sum(n_chars) AS bytes, max(sha256(text)) AS newest FROM documents GROUP BY 1, 2),
    t AS (SELECT source, cast(sum(n) AS bigint) AS object_count, cast(sum(bytes) AS bigint) AS total_bytes,
                 max(newest) AS newest_last_modified, count(*) FILTER (WHERE n > 1) AS duplicate_keys FROM k GROUP BY 1)
    SELECT t.*, d.digest AS inventory_sha256 FROM t JOIN ({_digest_sql(INVENTORY_LINES, 'source')}) d USING (source)
    """,
)
def inventory_rollup(spark, folder):
    """Documents as objects of their source; the text digest stands for the change stamp."""
    objects = table(spark, folder, "documents").select("source", "doc_id", "n_chars", F.sha2("text", 256).alias("stamp"))
    return retention.inventory_rollup(objects, "source", "doc_id", "n_chars", "stamp")


# One checkpoint prefix per user. Facts follow from the user's events, so every kind of outcome occurs.
RETENTION_FACTS_SQL = """
    SELECT user_id,
           CASE WHEN user_id < 20 THEN 'events/' WHEN user_id < 40 THEN 'elsewhere/' || user_id || '/'
                ELSE 'gh_events_file/tiny/' || md5(cast(user_id AS varchar)) || '/' || sha256(cast(user_id AS varchar)) || '/' END AS prefix,
           count(*) AS n, cast(sum(value * 100) AS bigint) AS bytes, max(ts) AS newest,
           max(ts) FILTER (WHERE event_type = 'click') AS clicked, max(ts) FILTER (WHERE event_type = 'view') AS viewed,
           max(ts) FILTER (WHERE event_type = 'signup') AS signed, count(*) FILTER (WHERE event_type = 'error') AS errors
    FROM events GROUP BY 1
"""


@query(
    "retention_eligibility",
    f"""
    WITH f AS ({RETENTION_FACTS_SQL}),
    x AS (
        SELECT *, TIMESTAMP '2024-02-12 12:00:00' AS now, starts_with(prefix, 'gh_') AS gen, prefix = 'events/' AS durable,
               starts_with(prefix, 'gh_') OR prefix = 'events/' AS known, clicked IS NOT NULL AS has_lease,
               signed IS NOT NULL AS has_terminal, newest + INTERVAL 2 MINUTE AS occurred FROM f),
    c AS (
        SELECT *, list_filter([
            CASE WHEN NOT known THEN 'unknown_prefix' END,
            CASE WHEN known AND NOT has_lease THEN 'lease_missing' END,
            CASE WHEN known AND has_lease AND errors = 14 THEN 'invalid_fact_type' END,
            CASE WHEN known AND has_lease AND errors > 16 THEN 'lease_conflicting' END,
            CASE WHEN known AND has_lease AND durable THEN 'lease_identity_mismatch' END,
            CASE WHEN known AND has_lease AND viewed IS NULL THEN 'invalid_utc_timestamp' END,
            CASE WHEN known AND has_lease AND (viewed IS NULL OR viewed > clicked) THEN 'lease_clock_invalid' END,
            CASE WHEN known AND has_lease AND errors < 9 THEN 'lease_expired_active_uncertain' END,
            CASE WHEN known AND has_lease AND NOT coalesce(
                has_terminal AND errors >= 9 AND (durable OR errors < 18), false) THEN 'invalid_lease_terminal_state' END,
            CASE WHEN known AND n > 100000 THEN 'inventory_invalid' END,
            CASE WHEN known AND NOT has_terminal THEN 'terminal_missing' END,
            CASE WHEN known AND has_terminal AND errors >= 18 AND NOT durable THEN 'invalid_terminal_state' END,
            CASE WHEN known AND has_terminal AND errors = 12 THEN 'recovery_not_approved' END,
            CASE WHEN known AND has_terminal AND gen AND errors = 13 THEN 'generation_identity_mismatch' END,
            CASE WHEN durable THEN 'registry_active_durable' END,
            CASE WHEN gen AND now < greatest(newest, clicked, CASE WHEN has_terminal THEN occurred END) + INTERVAL 1209600 SECOND
                THEN 'retention_quarantine' END
            ], lambda code: code IS NOT NULL) AS codes,
            CASE WHEN known THEN greatest(newest, clicked, CASE WHEN has_terminal THEN occurred END) END AS anchor FROM x)
    SELECT user_id, array_to_string(codes, ',') AS refusal_codes, anchor AS retention_anchor, len(codes) = 0 AS eligible FROM c
    """,
)
def retention_eligibility(spark, folder):
    kind = F.col("event_type")

    def newest(of: str):
        return F.max(F.when(kind == of, F.col("ts")))

    user = F.col("user_id")
    text = user.cast("string")
    generation = F.concat(F.lit("gh_events_file/tiny/"), F.md5(text), F.lit("/"), F.sha2(text, 256), F.lit("/"))
    prefix = F.when(user < 20, "events/").when(user < 40, F.concat(F.lit("elsewhere/"), text, F.lit("/"))).otherwise(generation)
    facts = (
        table(spark, folder, "events")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("object_count"),
            F.sum((F.col("value").cast("decimal(18,2)") * 100)).cast("long").alias("total_bytes"),
            F.max("ts").alias("newest_last_modified"),
            newest("click").alias("clicked"),
            newest("view").alias("viewed"),
            newest("signup").alias("signed"),
            F.count_if(kind == "error").alias("errors"),
        )
        .withColumn("prefix", prefix)
    )
    errors = F.col("errors")
    state = F.when(errors >= 18, "retired").otherwise("stopped")
    identity = F.concat_ws(
        ";", F.lit("scale=tiny"), F.concat(F.lit("publication_id="), F.md5(text)),
        F.concat(F.lit("manifest_sha256="), F.sha2(text, 256)),
    )
    facts = facts.withColumns(
        {
            "evaluated_at": F.lit("2024-02-12 12:00:00").cast("timestamp_ntz"),
            "has_lease": F.col("clicked").isNotNull(),
            "lease_checkpoint_id": F.lit("streaming-gh-archive-file-v1"),
            "lease_prefix": F.col("prefix"),
            "lease_state": F.when(errors < 9, "active").otherwise(state),
            "acquired_at": F.col("viewed"),
            "heartbeat_at": F.col("clicked"),
            "expires_at": F.col("clicked") + F.expr("INTERVAL 10 MINUTES"),
            "etag": F.md5(text),
            "lease_conflicting": errors > 16,
            "lease_malformed": F.when(errors != 14, F.lit(False)),
            "inventory_sha256": F.sha2(text, 256),
            "changed_since_plan": F.lit(False),
            "partial_retry_confined": F.lit(True),
            "has_terminal": F.col("signed").isNotNull(),
            "terminal_state": state,
            "occurred_at": F.col("newest_last_modified") + F.expr("INTERVAL 2 MINUTES"),
            "recovery_approved": errors != 12,
            "source_available": F.lit(True),
            "sink_disposition_approved": F.lit(True),
            "terminal_review": F.lit(None).cast("string"),
            "terminal_generation": F.when(errors == 13, "scale=small").otherwise(identity),
            "exclusive_run": F.lit(True),
            "successful": F.lit(True),
        }
    )
    decided = retention.retention_decision(facts, keep=["user_id"])
    return decided.select(
        "user_id",
        F.array_join("refusal_codes", ",").alias("refusal_codes"),
        "retention_anchor",
        "eligible",
    )
