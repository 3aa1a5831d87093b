"""Version history. Orders by year stand for the commits of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import versions
from tidemark.queries.registry import query, table
from tidemark.session import shared_folder
from tidemark.sources import files

ROLLBACK_ID = 9001

# A fulfilled order leaves the table two commits after the one that added it.
ROWS_SQL = """
    SELECT o_orderkey, o_totalprice, year(o_orderdate) AS added,
           CASE WHEN o_orderstatus = 'F' THEN year(o_orderdate) + 2 END AS removed FROM orders
"""
LOG_SQL = "SELECT year(o_orderdate) AS commit_id, max(o_orderdate) AS committed_at FROM orders GROUP BY 1"


def versioned_orders(spark, folder):
    year = F.year("o_orderdate").cast("long")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_totalprice",
        year.alias("added_commit"),
        F.when(F.col("o_orderstatus") == "F", year + 2).alias("removed_commit"),
    )


def order_log(spark, folder):
    """One commit per year, each on top of the year before, stored as the small table a log is."""
    years = (
        table(spark, folder, "orders")
        .groupBy(F.year("o_orderdate").cast("long").alias("commit_id"))
        .agg(F.max("o_orderdate").alias("committed_at"))
    )
    parents = years.select((F.col("commit_id") + 1).alias("commit_id"), F.col("commit_id").alias("parent_id"))
    log = years.join(parents, "commit_id", "left").select(
        "commit_id", "parent_id", "committed_at", F.lit("append").alias("operation")
    )
    path = shared_folder(spark, "log")
    log.write.parquet(path)
    return spark.read.parquet(path)


def order_refs(log):
    return log.agg(F.max("commit_id").alias("commit_id")).select(F.lit(versions.MAIN).alias("name"), "commit_id")


@query("history", f"SELECT committed_at, commit_id FROM ({LOG_SQL}) ORDER BY committed_at")
def history(spark, folder):
    return versions.history(order_log(spark, folder))


@query(
    "version_as_of",
    f"SELECT o_orderkey, o_totalprice FROM ({ROWS_SQL}) WHERE added <= 1998 AND (removed IS NULL OR removed > 1998)",
)
def version_as_of(spark, folder):
    return versions.read_as_of(versioned_orders(spark, folder), 1998)


@query(
    "read_branch",
    f"""
    SELECT o_orderkey, o_totalprice FROM ({ROWS_SQL}) r, (SELECT max(commit_id) AS head FROM ({LOG_SQL})) h
    WHERE added <= head AND (removed IS NULL OR removed > head)
    """,
)
def read_branch(spark, folder):
    log = order_log(spark, folder)
    return versions.read_branch(versioned_orders(spark, folder), log, order_refs(log))


@query(
    "rollback",
    f"SELECT o_orderkey, o_totalprice FROM ({ROWS_SQL}) WHERE added <= 1997 AND (removed IS NULL OR removed > 1997)",
)
def rollback(spark, folder):
    """Back to 1997, then read the branch: later years are no longer in its ancestry."""
    log = order_log(spark, folder)
    refs = order_refs(log)
    when = F.lit("2030-01-01").cast("timestamp_ntz")
    log, refs = versions.roll_back(log, refs, 1997, ROLLBACK_ID, when)
    return versions.read_branch(versioned_orders(spark, folder), log, refs)


@query(
    "branch_audit",
    f"""
    SELECT o_orderkey, o_totalprice FROM ({ROWS_SQL}) r, (SELECT max(commit_id) AS head FROM ({LOG_SQL})) h
    WHERE added <= head AND (removed IS NULL OR removed > head)
    """,
)
def branch_audit(spark, folder):
    """A branch made before a rollback of main still reads the old head."""
    log = order_log(spark, folder)
    refs = versions.create_branch(order_refs(log), "audit")
    refs = versions.create_branch(refs, "audit")
    log, refs = versions.roll_back(log, refs, 1997, ROLLBACK_ID, F.lit("2030-01-01").cast("timestamp_ntz"))
    return versions.read_branch(versioned_orders(spark, folder), log, refs, "audit")


@query(
    "append_commit",
    f"""
    SELECT commit_id, committed_at, CASE WHEN lag(commit_id) OVER (ORDER BY commit_id) IS NULL THEN NULL
           ELSE lag(commit_id) OVER (ORDER BY commit_id) END AS parent_id FROM (
        SELECT * FROM ({LOG_SQL}) UNION ALL SELECT 9002, TIMESTAMP '2030-01-02')
    """,
)
def append_commit(spark, folder):
    log = order_log(spark, folder)
    log, _ = versions.append_commit(log, order_refs(log), 9002, F.lit("2030-01-02").cast("timestamp_ntz"))
    return log.select("commit_id", "committed_at", "parent_id")


@query(
    "branch_head",
    f"SELECT 'main' AS name, commit_id, committed_at FROM ({LOG_SQL}) ORDER BY commit_id DESC LIMIT 1",
)
def branch_head(spark, folder):
    log = order_log(spark, folder)
    return versions.branch_head(log, order_refs(log))


@query(
    "branch_heads",
    f"""
    SELECT 'audit' AS name, commit_id, committed_at FROM ({LOG_SQL}) WHERE commit_id = 1997
    UNION ALL SELECT * FROM (SELECT 'main', commit_id, committed_at FROM ({LOG_SQL}) ORDER BY commit_id DESC LIMIT 1)
    """,
)
def branch_heads(spark, folder):
    """Heads of two branches in one listing."""
    log = order_log(spark, folder)
    refs = versions.move_ref(order_refs(log), "audit", 1997)
    return versions.branch_head(log, refs, "audit").unionAll(versions.branch_head(log, refs)).orderBy("name")


@query("stable_head", "SELECT true AS stable UNION ALL SELECT false")
def stable_head(spark, folder):
    """The head read twice is the same; after a rollback it is not."""
    log = order_log(spark, folder)
    refs = order_refs(log)
    before = versions.branch_head(log, refs)
    moved_log, moved_refs = versions.roll_back(log, refs, 1997, ROLLBACK_ID, F.lit("2030-01-01").cast("timestamp_ntz"))
    after = versions.branch_head(moved_log, moved_refs)
    return versions.same_head(before, before).unionAll(versions.same_head(before, after))


EXPIRED_SQL = f"""
    SELECT commit_id, committed_at FROM ({LOG_SQL}) WHERE committed_at < TIMESTAMP '1999-07-01'
    AND commit_id NOT IN (SELECT commit_id FROM ({LOG_SQL}) ORDER BY committed_at DESC LIMIT 2)
"""


def _expired(log):
    return versions.expire(log, order_refs(log), F.lit("1999-07-01").cast("timestamp_ntz"), retain_last=2)


@query("expire", EXPIRED_SQL)
def expire(spark, folder):
    return _expired(order_log(spark, folder))


@query(
    "expired_files",
    f"""
    SELECT DISTINCT removed || '/' || added AS path FROM ({ROWS_SQL}) WHERE removed <= (
        SELECT min(commit_id) FROM ({LOG_SQL}) WHERE commit_id NOT IN (SELECT commit_id FROM ({EXPIRED_SQL})))
    """,
)
def expired_files(spark, folder):
    """Order groups as files: one per pair of adding and removing commit."""
    log = order_log(spark, folder)
    groups = versioned_orders(spark, folder).select("added_commit", "removed_commit").distinct()
    paths = groups.withColumn("path", F.concat_ws("/", F.col("removed_commit"), F.col("added_commit")))
    return versions.expired_files(paths, log, _expired(log))


# The log after main was rolled back to 1997 while the branch audit stayed at the last year.
BRANCHED_SQL = f"""
    WITH RECURSIVE l AS (
        SELECT commit_id, lag(commit_id) OVER (ORDER BY commit_id) AS parent_id, committed_at FROM ({LOG_SQL})
        UNION ALL SELECT {ROLLBACK_ID}, 1997, TIMESTAMP '2030-01-01'),
    heads AS (SELECT max(commit_id) FILTER (WHERE commit_id < {ROLLBACK_ID}) AS audit FROM l),
    kept AS (SELECT commit_id FROM l, heads WHERE commit_id IN (audit, {ROLLBACK_ID}) OR committed_at >= TIMESTAMP '1999-07-01'),
    anc(reader, commit_id, parent_id) AS (
        SELECT l.commit_id, l.commit_id, l.parent_id FROM l JOIN kept USING (commit_id)
        UNION ALL SELECT anc.reader, l.commit_id, l.parent_id FROM anc JOIN l ON l.commit_id = anc.parent_id)
"""


def _branched(spark, folder):
    log = order_log(spark, folder)
    refs = versions.create_branch(order_refs(log), "audit")
    log, refs = versions.roll_back(log, refs, 1997, ROLLBACK_ID, F.lit("2030-01-01").cast("timestamp_ntz"))
    expired = versions.expire(log, refs, F.lit("1999-07-01").cast("timestamp_ntz"))
    return log, refs, expired


@query(
    "expire_after_rollback",
    f"""
    {BRANCHED_SQL}
    SELECT DISTINCT concat_ws('/', removed, added) AS path FROM ({ROWS_SQL}) r WHERE NOT EXISTS (
        SELECT 1 FROM anc a WHERE a.commit_id = r.added AND NOT EXISTS (
            SELECT 1 FROM anc b WHERE b.reader = a.reader AND b.commit_id = r.removed))
    """,
)
def expire_after_rollback(spark, folder):
    """Files to delete after expiry on a branching log: none that main or audit still reads."""
    log, _, expired = _branched(spark, folder)
    groups = versioned_orders(spark, folder).select("added_commit", "removed_commit").distinct()
    paths = groups.withColumn("path", F.concat_ws("/", F.col("removed_commit"), F.col("added_commit")))
    return versions.expired_files(paths, log, expired)


@query(
    "read_after_expiry",
    f"""
    {BRANCHED_SQL}
    SELECT name, o_orderkey, o_totalprice FROM ({ROWS_SQL}) r, (
        SELECT 'main' AS name, {ROLLBACK_ID} AS head UNION ALL SELECT 'audit', audit FROM heads) h
    WHERE EXISTS (SELECT 1 FROM anc WHERE reader = head AND commit_id = added)
      AND NOT EXISTS (SELECT 1 FROM anc WHERE reader = head AND commit_id = removed)
    """,
)
def read_after_expiry(spark, folder):
    """Both branches, read after the expired commits were dropped and their files deleted."""
    log, refs, expired = _branched(spark, folder)
    rows = versioned_orders(spark, folder)
    groups = rows.select("added_commit", "removed_commit").distinct()
    deleted = versions.expired_files(groups.withColumn("path", F.struct("added_commit", "removed_commit")), log, expired)
    gone = deleted.select("path.added_commit", "path.removed_commit").withColumn("_gone", F.lit(True))
    same = [F.col(f"r.{name}").eqNullSafe(F.col(f"g.{name}")) for name in ("added_commit", "removed_commit")]
    rows = rows.alias("r").join(gone.alias("g"), same, "left_anti")
    log = versions.drop_commits(log, expired)
    return (
        versions.read_branch(rows, log, refs).withColumn("name", F.lit("main"))
        .unionByName(versions.read_branch(rows, log, refs, "audit").withColumn("name", F.lit("audit")))
    )


def _written_orders(spark, folder):
    path = shared_folder(spark, "orders")
    rows = table(spark, folder, "orders").withColumn("commit", F.year("o_orderdate"))
    rows.write.partitionBy("commit").parquet(path)
    return path


@query(
    "orphan_files",
    "SELECT DISTINCT year(o_orderdate) AS commit FROM orders WHERE year(o_orderdate) > 1998",
)
def orphan_files(spark, folder):
    """Files on disk that the versions up to 1998 do not refer to, as the commits that left them."""
    path = _written_orders(spark, folder)
    listing = files.list_files(spark, path, "*.parquet")
    referred = (
        spark.read.parquet(path).where(F.col("commit") <= 1998).select(F.col("_metadata.file_path").alias("path")).distinct()
    )
    # Both sides name a file by URI; the listing uses the short local form.
    same_form = F.regexp_replace("path", "^file:/+", "file:/")
    orphans = versions.orphan_files(
        listing.withColumn("path", same_form), referred.withColumn("path", same_form)
    )
    return orphans.select(F.regexp_extract("path", "commit=([0-9]+)", 1).cast("long").alias("commit")).distinct()


@query(
    "table_counts",
    f"SELECT (SELECT count(DISTINCT year(o_orderdate)) FROM orders) AS folders, (SELECT count(*) FROM ({LOG_SQL})) AS versions",
)
def table_counts(spark, folder):
    listing = files.list_files(spark, _written_orders(spark, folder), "*.parquet")
    per_commit = listing.groupBy(F.regexp_extract("path", "commit=([0-9]+)", 1).alias("path")).agg(
        F.sum("bytes").alias("bytes")
    )
    return versions.table_counts(per_commit, order_log(spark, folder)).select(F.col("files").alias("folders"), "versions")
