"""Streams drained to a sink. Times and counts are compared with the batch equivalent."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.values import utc_wall
from tidemark.operators import events
from tidemark.queries.events import FLAT_SQL, NESTED, event_lines
from tidemark.queries.registry import query, table
from tidemark.session import session_settings, shared_folder
from tidemark.sources import tables
from tidemark.streaming import cdc, ingest, windows


def _event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    return ingest.file_stream(spark, folder, schema, "parquet", glob="events.parquet")


@query(
    "stream_ingest",
    "SELECT 'u' || user_id AS user_id, event_type AS event, date_trunc('second', ts) AS ts FROM events",
)
def stream_ingest(spark, folder):
    """Payload lines through the decoder into an append sink."""
    base = shared_folder(spark, "ingest")
    payloads = ingest.encode_payload(
        table(spark, folder, "events"),
        {
            "user_id": F.concat(F.lit("u"), F.col("user_id")),
            "event": "event_type",
            "ts": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        },
    )
    payloads.write.text(f"{base}/landing")
    lines = ingest.file_stream(spark, f"{base}/landing", payloads.schema, "text")
    stored = ingest.drain_to_folder(ingest.decode_payload(lines), f"{base}/bronze", f"{base}/checkpoint")
    return stored.withColumn("ts", utc_wall(F.col("ts")))


@query("stream_files", FLAT_SQL + " UNION ALL " + FLAT_SQL)
def stream_files(spark, folder):
    """Two declared-schema file streams in one union, appended to a table; checkpoint bound to the generation."""
    base = shared_folder(spark, "file-stream")
    streams = [ingest.file_stream(spark, event_lines(spark, folder), NESTED) for _ in range(2)]
    flat = events.flatten_events(ingest.union_streams(streams))
    checkpoint = ingest.generation_checkpoint(f"{base}/checkpoints", "gh_events_file", "tiny", "0" * 32, "0" * 64)
    suffix = base.rsplit("-", 1)[1]
    tables.ensure_namespaces(spark, [f"bronze_{suffix}"], base)
    stored = ingest.drain_to_table(flat, f"bronze_{suffix}.events", checkpoint)
    return stored.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query(
    "stream_windows",
    """
    SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS count
    FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type FROM events)
    WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    GROUP BY 1, 3
    """,
)
def stream_windows(spark, folder):
    """Closed windows only; read back ordered."""
    base = shared_folder(spark, "windows")
    counts = windows.window_counts(_event_stream(spark, folder), "ts", "event_type")
    stored = ingest.drain_to_folder(counts, f"{base}/gold", f"{base}/checkpoint")
    return stored.orderBy("window_start", "event_type")


@query(
    "stream_late",
    """
    WITH e AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS s FROM events),
    mark AS (SELECT max(ts) - INTERVAL 10 MINUTE AS w FROM events WHERE event_type <> 'signup')
    SELECT s AS window_start, s + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS count
    FROM e, mark
    WHERE (event_type <> 'signup' OR s + INTERVAL 5 MINUTE > w)
      AND s + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    GROUP BY 1, 2, 3
    """,
)
def stream_late(spark, folder):
    """Signups arrive after everything else: those behind the watermark are dropped."""
    base = shared_folder(spark, "late")
    rows = table(spark, folder, "events")
    stored = None
    for late in (False, True):
        arriving = rows.where(F.col("event_type").eqNullSafe("signup") == F.lit(late))
        arriving.write.mode("append").parquet(f"{base}/landing")
        stream = ingest.file_stream(spark, f"{base}/landing", rows.schema, "parquet")
        counts = windows.window_counts(stream, "ts", "event_type")
        stored = ingest.drain_to_folder(counts, f"{base}/gold", f"{base}/checkpoint")
    return stored


CDC_KEYS = ["l_orderkey", "l_linenumber"]
CDC_SET = ["l_quantity", "l_extendedprice"]
CDC_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]
DELIVERIES = ["A", "N", "R"]
# Compressed files cannot be split: one has so many changes, and a task so many bytes of them.
DELIVERED_PER_FILE = 500_000
DELIVERED_PER_TASK = 16 << 20

DELIVERED_SQL = """
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_returnflag, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS place,
        count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS places
    FROM lineitem
"""


def _deliver(spark, folder, base):
    """Three deliveries of changes, each drained into the change log; the last one is replayed.

    Deliveries land as compressed JSON lines, in files of a bounded size.
    """
    columns = [*CDC_KEYS, *CDC_SET, *CDC_ORDER]
    lines = table(spark, folder, "lineitem")
    schema = lines.select(*columns).schema
    write = cdc.change_log_writer(f"{base}/log", CDC_KEYS, CDC_ORDER)

    def write_twice(batch, batch_id):
        write(batch, batch_id)
        if batch_id == len(DELIVERIES) - 1:
            write(batch, batch_id)

    flag = F.coalesce("l_returnflag", F.lit(""))
    for number, name in enumerate(DELIVERIES):
        # the last delivery brings whatever the others do not
        chosen = flag == name if number < len(DELIVERIES) - 1 else ~flag.isin(*DELIVERIES[:-1])
        landed = lines.where(chosen).select(*columns).write.mode("append")
        landed.option("maxRecordsPerFile", DELIVERED_PER_FILE).json(f"{base}/landing", compression="gzip")
        stream = ingest.file_stream(spark, f"{base}/landing", schema, "json")
        with session_settings(spark, {"spark.sql.files.maxPartitionBytes": DELIVERED_PER_TASK}):
            ingest.drain_batches(stream, write_twice, f"{base}/checkpoint")
    return cdc.read_changes(spark, f"{base}/log", schema)


@query(
    "cdc_foreach_batch",
    f"SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM ({DELIVERED_SQL}) WHERE place = places",
)
def cdc_foreach_batch(spark, folder):
    """The state after all deliveries: the last change of every line."""
    changes = _deliver(spark, folder, shared_folder(spark, "cdc"))
    base = changes.select(*CDC_KEYS, *CDC_SET).limit(0)
    return cdc.current_state(base, changes.select(*CDC_KEYS, *CDC_SET, cdc.BATCH, cdc.PLACE), CDC_KEYS, CDC_SET)


@query(
    "cdc_fold",
    f"""
    SELECT l_orderkey, l_linenumber, max(l_quantity) FILTER (WHERE place = places) AS l_quantity,
           max(l_extendedprice) FILTER (WHERE place = 1) AS l_extendedprice
    FROM ({DELIVERED_SQL}) GROUP BY 1, 2
    """,
)
def cdc_fold(spark, folder):
    """Only the quantity is updated: the price stays as inserted. Two batches are folded, one is read on top."""
    base = shared_folder(spark, "fold")
    changes = _deliver(spark, folder, base).select(*CDC_KEYS, *CDC_SET, cdc.BATCH, cdc.PLACE)
    empty = changes.select(*CDC_KEYS, *CDC_SET).limit(0)
    folded = cdc.fold(
        empty, changes.where(F.col(cdc.BATCH) <= 1), CDC_KEYS, ["l_quantity"], f"{base}/base"
    )
    return cdc.current_state(folded, changes.where(F.col(cdc.BATCH) > 1), CDC_KEYS, ["l_quantity"])
