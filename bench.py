"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default: all)
BENCH_QUERIES comma-separated names instead of the headline set
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark import build_session
from tidemark.queries import QUERIES

HEADLINE = [
    "clean_trips",
    "normalize_union",
    "silver_dedupe",
    "gold_daily",
    "quality_split",
    "quality_counts",
    "quality_facts",
    "dq_latest",
    "dq_trend",
    "dq_attention",
    "quality_run",
    "dim_customer",
    "fct_orders",
    "segment_revenue",
    "segment_broadcast",
    "source_totals",
    "source_checks",
    "bi_artifact",
    "user_features",
    "item_features",
    "json_flatten",
    "type_histogram",
    "sessionize",
    "sessions_per_user",
    "session_checks",
    "conflicting_ids",
    "merge_upsert",
    "merge_partial",
    "scd2_apply",
    "schema_evolve",
    "version_as_of",
    "read_branch",
    "expire",
    "compact_rows",
    "export_sorted",
    "stream_ingest",
    "stream_windows",
    "cdc_foreach_batch",
    "multiset_difference",
    "table_fingerprint",
    "manifest_digest",
    "typed_cell_check",
    "json_contract",
    "rolling_p95",
    "monthly_p95",
    "availability",
    "alert_runs",
    "inventory_rollup",
    "retention_eligibility",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["segment_revenue"](spark, folder).collect()
    seconds = {}
    for name in names:
        begun = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "total_wall_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
