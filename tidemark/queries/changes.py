"""Upserts, history dimension and schema evolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import changes
from tidemark.operators.multiset import multiset_report
from tidemark.queries.quality import FACTS_SQL, monthly_facts
from tidemark.queries.registry import query, table
from tidemark.session import session_settings, shared_folder

TARGET = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"
NEW_KEYS = 1_000_000_000_000
# Shuffled bytes that a join of a stored merge gives to one task, where its partitions are not larger anyway.
SORTED_BYTES = 16 << 20

# Changed rows: every fulfilled order costs more and changes hands; every pending one appears under a new key.
SOURCE_SQL = f"""
    SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_orderstatus, o_totalprice + 100 AS o_totalprice
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey + {NEW_KEYS}, o_custkey, 'N', o_totalprice FROM orders WHERE o_orderstatus = 'P'
"""


def _merge_sql(set_columns: list[str]) -> str:
    names = TARGET.split(", ")
    picked = ", ".join(
        f"CASE WHEN t.o_orderkey IS NULL THEN s.{n} WHEN s.o_orderkey IS NOT NULL THEN {'s' if n in set_columns else 't'}.{n} "
        f"ELSE t.{n} END AS {n}"
        for n in names
    )
    return f"""
        SELECT {picked} FROM orders t FULL JOIN ({SOURCE_SQL}) s ON t.o_orderkey = s.o_orderkey
    """


def _target_and_source(spark, folder):
    target = table(spark, folder, "orders").select(*TARGET.split(", "))
    fulfilled = target.where(F.col("o_orderstatus") == "F").withColumns(
        {"o_custkey": F.col("o_custkey") + 1, "o_totalprice": F.col("o_totalprice") + 100}
    )
    pending = target.where(F.col("o_orderstatus") == "P").withColumns(
        {"o_orderkey": F.col("o_orderkey") + NEW_KEYS, "o_orderstatus": F.lit("N")}
    )
    return target, fulfilled.unionByName(pending)


@query("merge_upsert", _merge_sql(["o_custkey", "o_orderstatus", "o_totalprice"]))
def merge_upsert(spark, folder):
    target, source = _target_and_source(spark, folder)
    return changes.merge_upsert(target, source, ["o_orderkey"])


@query("merge_partial", _merge_sql(["o_totalprice"]))
def merge_partial(spark, folder):
    """Matched rows take the price only; the customer keeps its old value."""
    target, source = _target_and_source(spark, folder)
    return changes.merge_upsert(target, source, ["o_orderkey"], ["o_totalprice"])


def _stored(merged, purpose):
    """The rows of a merge, written by tasks that sort ``SORTED_BYTES`` of shuffled rows at most, and read back."""
    spark = merged.sparkSession
    path = shared_folder(spark, purpose)
    with session_settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": SORTED_BYTES}):
        merged.write.parquet(path)
    return spark.read.schema(merged.schema).parquet(path)


@query(
    "merge_replay",
    f"""
    WITH once AS ({_merge_sql(["o_totalprice"])}),
    twice AS ({_merge_sql(["o_totalprice"]).replace("FROM orders t", "FROM once t")}),
    d AS (SELECT (SELECT count(*) FROM (SELECT * FROM once EXCEPT ALL SELECT * FROM twice)) AS missing,
                 (SELECT count(*) FROM (SELECT * FROM twice EXCEPT ALL SELECT * FROM once)) AS extra)
    SELECT missing AS missing_rows, extra AS extra_rows, missing + extra = 0 AS equal FROM d
    """,
)
def merge_replay(spark, folder):
    """The same merge applied twice changes nothing more. Each result is stored, as a table is, before it is read."""
    target, source = _target_and_source(spark, folder)
    once = _stored(changes.merge_upsert(target, source, ["o_orderkey"], ["o_totalprice"]), "merged-once")
    twice = _stored(changes.merge_upsert(once, source, ["o_orderkey"], ["o_totalprice"]), "merged-twice")
    return multiset_report(once, twice)


@query(
    "merge_lines",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
           CASE WHEN o_orderkey IS NOT NULL THEN 0 ELSE l_quantity END AS l_quantity
    FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') ON l_orderkey = o_orderkey
    """,
)
def merge_lines(spark, folder):
    """Target keys that repeat: every line of a pending order is updated by one source row."""
    target = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"
    )
    pending = table(spark, folder, "orders").where(F.col("o_orderstatus") == "P")
    # A pending order without lines would be inserted; it is not part of the change.
    with_lines = pending.select(F.col("o_orderkey").alias("l_orderkey")).join(target, "l_orderkey", "left_semi")
    source = with_lines.select(
        "l_orderkey",
        F.lit(None).cast("int").alias("l_linenumber"),
        F.lit(None).cast("long").alias("l_partkey"),
        F.lit(None).cast("double").alias("l_extendedprice"),
        F.lit(0.0).alias("l_quantity"),
    )
    return changes.merge_upsert(target, source, ["l_orderkey"], ["l_quantity"])


@query(
    "merge_facts",
    f"""
    WITH f AS ({FACTS_SQL})
    SELECT * REPLACE (CASE WHEN status = 'warn' THEN 'Second Owner' ELSE owner END AS owner) FROM f
    """,
)
def merge_facts(spark, folder):
    """Facts merged on (run, rule): the warned ones come again with another owner."""
    facts = monthly_facts(spark, folder)
    again = facts.where(F.col("status") == "warn").withColumn("owner", F.lit("Second Owner"))
    return changes.merge_upsert(facts, again, ["quality_run_id", "rule_id"])


@query(
    "merge_checks",
    """
    WITH found AS (
        SELECT 'rows_over_bound' AS "check", greatest(count(*) - 100, 0) AS violations FROM orders
        UNION ALL SELECT 'not_one_run', abs(count(DISTINCT o_orderstatus) - 1) FROM orders
        UNION ALL SELECT 'o_orderpriority_not_allowed',
            count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) FROM orders
        UNION ALL SELECT 'duplicate_keys', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1))
    SELECT "check", cast(violations AS bigint) AS violations,
           CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def merge_checks(spark, folder):
    return changes.merge_checks(
        table(spark, folder, "orders"), ["o_custkey"], "o_orderstatus", 100, {"o_orderpriority": ["1-URGENT", "2-HIGH"]}
    )


@query(
    "update_where",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 'C' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 0 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def update_where(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    large = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    return changes.update_where(orders, large, {"o_orderstatus": F.lit("C"), "o_totalprice": F.lit(0)})


SCD2_SQL = f"""
    WITH moved AS (SELECT c_custkey FROM customer WHERE c_nationkey < 8 AND c_mktsegment <> 'MACHINERY')
    SELECT c_custkey, c_mktsegment, TIMESTAMP '2023-01-01' AS effective_from,
           CASE WHEN m THEN TIMESTAMP '2024-06-01' END AS effective_to, NOT m AS is_current
    FROM (SELECT *, c_custkey IN (SELECT c_custkey FROM moved) AS m FROM customer)
    UNION ALL SELECT c_custkey, 'MACHINERY', TIMESTAMP '2024-06-01', NULL, true FROM moved JOIN customer USING (c_custkey)
    UNION ALL SELECT c_custkey + {NEW_KEYS}, 'MACHINERY', TIMESTAMP '2024-06-01', NULL, true FROM customer WHERE c_nationkey = 20
"""


def _scd2(spark, folder):
    customer = table(spark, folder, "customer")
    dimension = customer.select(
        "c_custkey",
        "c_mktsegment",
        F.lit("2023-01-01").cast("timestamp_ntz").alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    new = customer.where(F.col("c_nationkey") == 20).select((F.col("c_custkey") + NEW_KEYS).alias("c_custkey"))
    moved = customer.where(F.col("c_nationkey") < 8).select("c_custkey").unionByName(new)
    changed = moved.withColumn("c_mktsegment", F.lit("MACHINERY"))
    effective = F.lit("2024-06-01").cast("timestamp_ntz")
    return dimension, changed, changes.scd2_apply(dimension, changed, ["c_custkey"], ["c_mktsegment"], effective)


@query("scd2_apply", SCD2_SQL)
def scd2_apply(spark, folder):
    return _scd2(spark, folder)[2]


@query(
    "scd2_replay",
    f"SELECT c_custkey, effective_to IS NOT NULL AS closed, count(*) AS versions FROM ({SCD2_SQL}) GROUP BY 1, 2",
)
def scd2_replay(spark, folder):
    """A second application of the same changes opens no further version."""
    _, changed, dimension = _scd2(spark, folder)
    again = changes.scd2_apply(
        dimension, changed, ["c_custkey"], ["c_mktsegment"], F.lit("2025-01-01").cast("timestamp_ntz")
    )
    return again.groupBy("c_custkey", F.col("effective_to").isNotNull().alias("closed")).agg(
        F.count(F.lit(1)).alias("versions")
    )


@query(
    "scd2_checks",
    f"""
    WITH d AS ({SCD2_SQL}), found AS (
        SELECT 'several_current_rows' AS "check", (SELECT count(*) FROM (
            SELECT c_custkey FROM d GROUP BY 1 HAVING count(*) FILTER (WHERE is_current) > 1)) AS violations
        UNION ALL SELECT 'end_disagrees_with_flag',
            (SELECT count(*) FROM d WHERE is_current <> (effective_to IS NULL)))
    SELECT "check", violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def scd2_checks(spark, folder):
    return changes.scd2_checks(_scd2(spark, folder)[2], ["c_custkey"], "effective_to", "is_current")


@query(
    "schema_evolve",
    """
    SELECT cast(event_id AS varchar) AS id, event_type, 'u' || user_id AS actor_login, NULL::VARCHAR AS repo_name
    FROM events WHERE event_type <> 'purchase'
    UNION ALL SELECT cast(event_id AS varchar), event_type, 'u' || user_id, props FROM events WHERE event_type = 'purchase'
    """,
)
def schema_evolve(spark, folder):
    """Old rows without a repository, a renamed column, then rows of the new shape."""
    rows = table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.concat(F.lit("u"), F.col("user_id")).alias("actor_login"),
        "props",
    )
    old = rows.where(F.col("type") != "purchase").drop("props")
    evolved = changes.rename_columns(changes.add_columns(old, {"repo_name": "string"}), {"type": "event_type"})
    new = rows.where(F.col("type") == "purchase").withColumnsRenamed({"type": "event_type", "props": "repo_name"})
    return changes.append_aligned(evolved, new)
