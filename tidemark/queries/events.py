"""Nested events, histograms and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import utc_wall
from tidemark.operators import checks, events
from tidemark.operators.multiset import multiset_report
from tidemark.queries.registry import query, table
from tidemark.session import shared_folder
from tidemark.sources import files
from tidemark.streaming.ingest import decode_payload, encode_payload

NESTED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("actor", T.StructType([T.StructField("login", T.StringType())])),
        T.StructField("repo", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("created_at", T.StringType()),
    ]
)

FLAT_SQL = """
    SELECT cast(event_id AS varchar) AS id, event_type AS type, 'u' || user_id AS actor_login,
           'r' || json_extract_string(props, '$.k') AS repo_name, date_trunc('second', ts) AS created_at
    FROM events
"""


def nested_events(spark, folder):
    """The event table in the nested shape of the landing files."""
    events_table = table(spark, folder, "events")
    k = F.from_json("props", "k int")["k"]
    return events_table.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.struct(F.concat(F.lit("u"), F.col("user_id")).alias("login")).alias("actor"),
        F.struct(F.concat(F.lit("r"), k).alias("name")).alias("repo"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
    )


def event_lines(spark, folder):
    """A folder of gzip JSON lines written from the event table."""
    path = shared_folder(spark, "landing")
    nested_events(spark, folder).write.option("compression", "gzip").json(path)
    return path


def _flat(frame):
    return frame.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("json_flatten", FLAT_SQL)
def json_flatten(spark, folder):
    source = files.read_json_strict(spark, [event_lines(spark, folder)], NESTED)
    checks.require_nested_strings(source, ["id", "type", "actor.login", "repo.name", "created_at"])
    return _flat(events.flatten_events(source))


@query("json_flatten_inferred", FLAT_SQL)
def json_flatten_inferred(spark, folder):
    source = files.read_json_inferred(spark, event_lines(spark, folder))
    return _flat(checks.impose_schema(events.flatten_events(source), events.EVENT_SCHEMA))


@query(
    "props_decode",
    "SELECT event_id, cast(json_extract(props, '$.k') AS int) AS k FROM events",
)
def props_decode(spark, folder):
    return table(spark, folder, "events").select("event_id", F.from_json("props", "k int").alias("p")).select(
        "event_id", "p.*"
    )


@query(
    "payload_round_trip",
    "SELECT 'u' || user_id AS user_id, event_type AS event, date_trunc('millisecond', ts) AS ts FROM events",
)
def payload_round_trip(spark, folder):
    payloads = encode_payload(
        table(spark, folder, "events"),
        {
            "user_id": F.concat(F.lit("u"), F.col("user_id")),
            "event": "event_type",
            "ts": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        },
    )
    decoded = decode_payload(payloads.select(F.encode("value", "UTF-8").alias("value")))
    return decoded.withColumn("ts", utc_wall(F.col("ts")))


@query("type_histogram", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type")
def type_histogram(spark, folder):
    return events.type_histogram(table(spark, folder, "events"), "event_type")


@query(
    "event_checks",
    """
    WITH found AS (
        SELECT 'events_empty' AS "check", (SELECT cast(count(*) = 0 AS int) FROM events) AS violations
        UNION ALL SELECT 'text_blank', (SELECT count(*) FROM events WHERE event_type IS NULL OR trim(event_type) = ''
            OR props IS NULL OR trim(props) = '')
        UNION ALL SELECT 'time_null', (SELECT count(*) FROM events WHERE ts IS NULL)
        UNION ALL SELECT 'conflicting_ids', (SELECT count(*) FROM (
            SELECT event_id FROM (SELECT DISTINCT * FROM events) GROUP BY 1 HAVING count(*) > 1)))
    SELECT "check", cast(violations AS bigint) AS violations,
           CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def event_checks(spark, folder):
    return checks.event_checks(table(spark, folder, "events"), "event_id", ("event_type", "props"), "ts")


@query(
    "conflicting_ids",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS versions FROM (SELECT DISTINCT * FROM lineitem)
    GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def conflicting_ids(spark, folder):
    return checks.conflicting_ids(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def _session_sql(relation: str, user: str, time: str, order: str, gap: int, columns: str) -> str:
    return f"""
        WITH p AS (
            SELECT {columns}, lag({time}) OVER (PARTITION BY {user} ORDER BY {time}, {order}) AS previous_ts FROM {relation}),
        f AS (
            SELECT *, CASE WHEN previous_ts IS NULL
                OR epoch_us({time}) // 1000000 - epoch_us(previous_ts) // 1000000 > {gap} THEN 1 ELSE 0 END AS new_session
            FROM p)
        SELECT *, cast(sum(new_session) OVER (PARTITION BY {user} ORDER BY {time}, {order}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS session_id FROM f
    """


EVENT_SESSION_SQL = _session_sql("events", "user_id", "ts", "event_id", 1800, "event_id, user_id, event_type, ts")


def _event_sessions(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    return rows, events.sessionize(rows, "user_id", "ts", "event_id", previous_name="previous_ts")


@query("sessionize", EVENT_SESSION_SQL)
def sessionize(spark, folder):
    return _event_sessions(spark, folder)[1]


@query(
    "sessionize_types",
    _session_sql("events", "event_type", "ts", "event_id", 1800, "event_id, event_type, ts"),
)
def sessionize_types(spark, folder):
    """Few, very large groups: each event type as one actor."""
    rows = table(spark, folder, "events").select("event_id", "event_type", "ts")
    return events.sessionize(rows, "event_type", "ts", "event_id", previous_name="previous_ts")


@query(
    "sessionize_orders",
    _session_sql("orders", "o_custkey", "o_orderdate", "o_orderkey", 2592000, "o_orderkey, o_custkey, o_orderdate"),
)
def sessionize_orders(spark, folder):
    """Whole-day times with many ties: orders of a customer, a month apart."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return events.sessionize(rows, "o_custkey", "o_orderdate", "o_orderkey", 2592000, "previous_ts")


@query(
    "sessions_per_user",
    f"SELECT user_id, count(DISTINCT session_id) AS sessions FROM ({EVENT_SESSION_SQL}) GROUP BY 1",
)
def sessions_per_user(spark, folder):
    return events.sessions_per_user(_event_sessions(spark, folder)[1], "user_id")


@query(
    "session_checks",
    f"""
    WITH s AS ({EVENT_SESSION_SQL}),
    m AS (SELECT user_id, session_id, min(epoch_us(ts) // 1000000) AS a, max(epoch_us(ts) // 1000000) AS b,
                 sum(new_session) AS flags FROM s GROUP BY 1, 2),
    n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY session_id) AS place,
                 a - lag(b) OVER (PARTITION BY user_id ORDER BY session_id) AS apart FROM m),
    u AS (SELECT user_id, ts AS t, 1 AS w FROM s UNION ALL SELECT user_id, previous_ts, -1 FROM s WHERE previous_ts IS NOT NULL),
    l AS (SELECT user_id, t, sum(w) AS w FROM u GROUP BY 1, 2),
    c AS (SELECT user_id, arg_max(w, t) AS last, sum(abs(w)) AS total FROM l GROUP BY 1),
    found AS (
        SELECT 'annotation_null' AS "check", (SELECT count(*) FROM s WHERE ts IS NULL OR new_session IS NULL OR session_id IS NULL) AS violations
        UNION ALL SELECT 'flag_not_binary', (SELECT count(*) FROM s WHERE new_session NOT IN (0, 1))
        UNION ALL SELECT 'session_id_below_one', (SELECT count(*) FROM s WHERE session_id < 1)
        UNION ALL SELECT 'flag_disagrees_with_gap', (SELECT count(*) FROM s WHERE (new_session = 1) <>
            (previous_ts IS NULL OR epoch_us(ts) // 1000000 - epoch_us(previous_ts) // 1000000 > 1800))
        UNION ALL SELECT 'previous_after_event', (SELECT count(*) FROM s WHERE previous_ts > ts)
        UNION ALL SELECT 'event_rows_changed', (SELECT count(*) FROM (
            (SELECT event_id, user_id, event_type, ts FROM events EXCEPT ALL SELECT event_id, user_id, event_type, ts FROM s)
            UNION ALL
            (SELECT event_id, user_id, event_type, ts FROM s EXCEPT ALL SELECT event_id, user_id, event_type, ts FROM events)))
        UNION ALL SELECT 'previous_chain_broken', (SELECT count(*) FROM c WHERE last <> 1 OR total <> 1)
        UNION ALL SELECT 'session_without_single_flag', (SELECT count(*) FROM n WHERE flags <> 1)
        UNION ALL SELECT 'session_number_gap', (SELECT count(*) FROM n WHERE session_id <> place)
        UNION ALL SELECT 'sessions_too_close', (SELECT count(*) FROM n WHERE apart <= 1800)
        UNION ALL SELECT 'sessions_differ', 0)
    SELECT "check", violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def session_checks(spark, folder):
    rows, sessions = _event_sessions(spark, folder)
    path = shared_folder(spark, "sessions")
    sessions.write.parquet(path)
    return checks.session_checks(spark.read.parquet(path), rows, "user_id", "ts", "previous_ts", 1800, "event_id")


@query(
    "session_checks_reject",
    f"""
    WITH s AS ({EVENT_SESSION_SQL})
    SELECT 'sessions_differ' AS "check", cast(2 * count(*) FILTER (WHERE event_id % 50 = 0) AS bigint) AS violations, 'fail' AS status FROM s
    """,
)
def session_checks_reject(spark, folder):
    """Every fiftieth event with a wrong session number: each is one row missing and one too many."""
    rows, sessions = _event_sessions(spark, folder)
    number = F.when(F.col("event_id") % 50 == 0, F.col("session_id") + 1_000_000).otherwise(F.col("session_id"))
    path = shared_folder(spark, "sessions")
    sessions.withColumn("session_id", number).write.parquet(path)
    found = checks.session_checks(spark.read.parquet(path), rows, "user_id", "ts", "previous_ts", 1800, "event_id")
    return found.where(F.col("check") == "sessions_differ")


@query(
    "session_multiplicity",
    f"""
    WITH s AS (SELECT user_id, session_id, count(*) AS expected_rows FROM ({EVENT_SESSION_SQL}) GROUP BY 1, 2),
    d AS (SELECT user_id, session_id, count(*) AS actual_rows FROM ({EVENT_SESSION_SQL}) WHERE event_type <> 'error' GROUP BY 1, 2)
    SELECT coalesce(s.user_id, d.user_id) AS user_id, coalesce(s.session_id, d.session_id) AS session_id,
           coalesce(expected_rows, 0) AS expected_rows, coalesce(actual_rows, 0) AS actual_rows
    FROM s FULL JOIN d ON s.user_id = d.user_id AND s.session_id = d.session_id
    WHERE coalesce(expected_rows, 0) <> coalesce(actual_rows, 0)
    """,
)
def session_multiplicity(spark, folder):
    """Sessions that would lose rows if error events were dropped."""
    sessions = _event_sessions(spark, folder)[1]
    return checks.multiplicity_comparison(
        sessions, sessions.where(F.col("event_type") != "error"), ["user_id", "session_id"]
    )


@query(
    "session_rows_equal",
    f"""
    WITH s AS (SELECT event_id, user_id, event_type, ts FROM ({EVENT_SESSION_SQL})),
    e AS (SELECT event_id, user_id, event_type, ts FROM events),
    d AS (SELECT (SELECT count(*) FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM s)) AS missing,
                 (SELECT count(*) FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM e)) AS extra)
    SELECT missing AS missing_rows, extra AS extra_rows, missing + extra = 0 AS equal FROM d
    """,
)
def session_rows_equal(spark, folder):
    """The events inside the sessions are the events, copies included."""
    rows, sessions = _event_sessions(spark, folder)
    return multiset_report(rows, sessions.select(*rows.columns))
