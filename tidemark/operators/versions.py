"""Version history of a table as ordinary frames.

``log`` has one row per commit: (commit_id long, parent_id long, committed_at timestamp, operation
string). ``refs`` has one row per branch: (name string, commit_id long). Table rows, or the files
holding them, carry ``added_commit`` and ``removed_commit``. An expired commit stays in the log as a
link (operation ``expired``, no time), so the ancestry of the commits above it stays whole.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_folder

MAIN = "main"
EXPIRED = "expired"
#: Commits (times branches) that one task walks; a longer history goes by doubled links.
SHORT_LOG = 200_000


def _commit_row(log: DataFrame, values: dict[str, Column]) -> DataFrame:
    spark = log.sparkSession
    return spark.range(1).select(
        [values[field.name].cast(field.dataType).alias(field.name) for field in log.schema.fields]
    )


def append_commit(
    log: DataFrame, refs: DataFrame, commit_id: int, committed_at: Column, operation: str = "append", branch: str = MAIN
) -> tuple[DataFrame, DataFrame]:
    """Log and refs after a commit on top of the branch head (no parent when the branch is new)."""
    head = refs.where(F.col("name") == branch).agg(F.max("commit_id").alias("parent_id"))
    row = head.select(
        F.lit(commit_id).cast("long").alias("commit_id"),
        "parent_id",
        committed_at.cast(log.schema["committed_at"].dataType).alias("committed_at"),
        F.lit(operation).alias("operation"),
    )
    return log.unionByName(row.select(*log.columns)), move_ref(refs, branch, commit_id)


def move_ref(refs: DataFrame, branch: str, commit_id: int) -> DataFrame:
    new = refs.sparkSession.range(1).select(F.lit(branch).alias("name"), F.lit(commit_id).cast("long").alias("commit_id"))
    return refs.where(F.col("name") != branch).unionByName(new)


def create_branch(refs: DataFrame, branch: str, source: str = MAIN) -> DataFrame:
    """Add a branch at the head of ``source`` unless it exists."""
    exists = refs.where(F.col("name") == branch).select(F.lit(branch).alias("name"))
    new = refs.where(F.col("name") == source).select(F.lit(branch).alias("name"), "commit_id")
    return refs.unionByName(new.join(exists, "name", "left_anti"))


def roll_back(
    log: DataFrame, refs: DataFrame, to_commit: int, commit_id: int, committed_at: Column, branch: str = MAIN
) -> tuple[DataFrame, DataFrame]:
    """A new head whose parent is ``to_commit``: later commits leave the branch's ancestry."""
    row = _commit_row(
        log,
        {
            "commit_id": F.lit(commit_id),
            "parent_id": F.lit(to_commit),
            "committed_at": committed_at,
            "operation": F.lit("rollback"),
        },
    )
    return log.unionByName(row), move_ref(refs, branch, commit_id)


def live_commits(log: DataFrame) -> DataFrame:
    """Commits that have not expired."""
    return log.where(~F.col("operation").eqNullSafe(EXPIRED))


def history(log: DataFrame) -> DataFrame:
    return live_commits(log).select("committed_at", "commit_id").orderBy("committed_at", "commit_id")


def branch_head(log: DataFrame, refs: DataFrame, branch: str = MAIN) -> DataFrame:
    """The branch's commit id and time."""
    named = refs.where(F.col("name") == branch).select("name", "commit_id")
    return named.join(log.select("commit_id", "committed_at"), "commit_id").select("name", "commit_id", "committed_at")


def same_head(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row telling whether two readings of branch heads agree."""
    joined = before.alias("b").join(after.alias("a"), "name", "full")
    moved = ~(
        F.col("b.commit_id").eqNullSafe(F.col("a.commit_id"))
        & F.col("b.committed_at").eqNullSafe(F.col("a.committed_at"))
    )
    return joined.agg((F.count_if(moved) == 0).alias("stable"))


def _stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _rounds(log: DataFrame) -> int:
    """Doublings that reach from any commit to the first one."""
    return log.count().bit_length()


def _leap(links: DataFrame) -> DataFrame:
    """Links (commit_id, up) of twice the length; those past the first commit are dropped."""
    onward = links.select(F.col("commit_id").alias("up"), F.col("up").alias("_next"))
    return links.join(onward, "up").select("commit_id", F.col("_next").alias("up"))


def _links(log: DataFrame) -> DataFrame:
    return log.where(F.col("parent_id").isNotNull()).select("commit_id", F.col("parent_id").alias("up"))


def _is_short(log: DataFrame, refs: DataFrame | None = None) -> bool:
    """Whether one task can walk the whole log (for each branch), by its measured size."""
    size = log.count()
    return size * (refs.count() if refs is not None and size <= SHORT_LOG else 1) <= SHORT_LOG


def _together(frame: DataFrame, links: DataFrame, function, schema: str) -> DataFrame:
    """Both frames, of a checked size, in one group; the result is stored, as a small table."""
    both = frame.withColumn("_link", F.lit(False)).unionByName(links.withColumn("_link", F.lit(True)), allowMissingColumns=True)

    def split(table: pa.Table) -> pa.Table:
        link = table.column("_link")
        return function(table.filter(pc.invert(link)), table.filter(link))

    return _stored(both.groupBy(F.lit(0).alias("_all")).applyInArrow(split, schema), "history")


def _parents(links: pa.Table) -> dict[int, int]:
    return dict(zip(links.column("commit_id").to_pylist(), links.column("up").to_pylist(), strict=True))


def _walked(heads: pa.Table, links: pa.Table) -> pa.Table:
    """Each branch's commits, from its head to the first one."""
    parents = _parents(links)
    found: dict[tuple, None] = {}
    for name, commit in zip(heads.column("name").to_pylist(), heads.column("commit_id").to_pylist(), strict=True):
        while commit is not None and (name, commit) not in found:
            found[name, commit] = None
            commit = parents.get(commit)
    names, commits = ([key[at] for key in found] for at in (0, 1))
    return pa.table({"name": pa.array(names, pa.string()), "commit_id": pa.array(commits, heads.schema.field("commit_id").type)})


def _summed(counts: pa.Table, links: pa.Table) -> pa.Table:
    """Each commit's own count and those of all commits above it: children are added before their parent."""
    parents = _parents(links)
    above = dict(zip(counts.column("commit_id").to_pylist(), counts.column("above").to_pylist(), strict=True))
    waiting = Counter(parents.values())
    ready = [commit for commit in above if commit not in waiting]
    while ready:
        commit = ready.pop()
        parent = parents.get(commit)
        if parent is not None:
            above[parent] = above.get(parent, 0) + above[commit]
            waiting[parent] -= 1
            if not waiting[parent]:
                ready.append(parent)
    return pa.table({
        "commit_id": pa.array(list(above), counts.schema.field("commit_id").type), "above": pa.array(list(above.values()), pa.int64()),
    })


def branch_ancestry(log: DataFrame, refs: DataFrame) -> DataFrame:
    """(name, commit_id): all commits each branch reaches along parent links, its head included.

    A short history is walked by one task. In a longer one links are doubled in length in each round, so the rounds
    grow with the logarithm of the history. Each round is stored as a small table, whose size Spark then knows.
    """
    reached = refs.join(log.select("commit_id"), "commit_id", "left_semi").select("name", "commit_id")
    if _is_short(log, refs):
        return _together(reached, _links(log), _walked, f"name string, commit_id {dict(log.dtypes)['commit_id']}")
    links = _links(log)
    for _ in range(_rounds(log)):
        further = reached.join(links, "commit_id").select("name", F.col("up").alias("commit_id"))
        reached = _stored(reached.unionByName(further).distinct(), "ancestry")
        links = _stored(_leap(links), "links")
    return reached


def ancestry(log: DataFrame, heads: DataFrame) -> DataFrame:
    """Commit ids reachable from ``heads`` (a frame with commit_id) along parent links."""
    named = heads.select(F.lit("").alias("name"), "commit_id")
    return branch_ancestry(log, named).select("commit_id")


def kept_above(log: DataFrame, kept: DataFrame) -> DataFrame:
    """(commit_id, above): how many of the commits ``kept`` reach each commit, itself included."""
    marked = kept.select("commit_id").distinct().withColumn("_kept", F.lit(1))
    counts = log.join(marked, "commit_id", "left").select("commit_id", F.coalesce("_kept", F.lit(0)).cast("long").alias("above"))
    links = _links(log)
    if _is_short(log):
        return _together(counts, links, _summed, f"commit_id {dict(log.dtypes)['commit_id']}, above bigint")
    for _ in range(_rounds(log)):
        risen = counts.join(links, "commit_id").select(F.col("up").alias("commit_id"), "above")
        counts = _stored(counts.unionByName(risen).groupBy("commit_id").agg(F.sum("above").alias("above")), "above")
        links = _stored(_leap(links), "links")
    return counts


def read_as_of(rows: DataFrame, version: int) -> DataFrame:
    """Rows visible at a version of a linear history."""
    visible = (F.col("added_commit") <= version) & (
        F.col("removed_commit").isNull() | (F.col("removed_commit") > version)
    )
    return rows.where(visible).drop("added_commit", "removed_commit")


def read_commits(rows: DataFrame, visible: DataFrame) -> DataFrame:
    """Rows added by a visible commit and not removed by one; ``visible`` holds commit_id.

    The commit list is metadata, one row per commit, so both joins stay on the small side.
    """
    commits = visible.select("commit_id")
    added = rows.join(commits, F.col("added_commit") == F.col("commit_id"), "left_semi")
    live = added.join(commits, F.col("removed_commit") == F.col("commit_id"), "left_anti")
    return live.drop("added_commit", "removed_commit")


def read_branch(rows: DataFrame, log: DataFrame, refs: DataFrame, branch: str = MAIN) -> DataFrame:
    return read_commits(rows, ancestry(log, refs.where(F.col("name") == branch)))


def expire(log: DataFrame, refs: DataFrame, older_than: Column, retain_last: int = 1) -> DataFrame:
    """Commits to drop: older than the cutoff, no branch head, and among no branch's newest ``retain_last``."""
    live = live_commits(log).select("commit_id", "committed_at")
    newest = Window.partitionBy("name").orderBy(F.desc("committed_at"), F.desc("commit_id"))
    ranked = branch_ancestry(log, refs).join(live, "commit_id").withColumn("_rank", F.row_number().over(newest))
    kept = ranked.where(F.col("_rank") <= retain_last).select("commit_id").unionByName(refs.select("commit_id"))
    return live.where(F.col("committed_at") < older_than).join(kept, "commit_id", "left_anti").select("commit_id", "committed_at")


def drop_commits(log: DataFrame, expired: DataFrame) -> DataFrame:
    """The log after expiry: dropped commits remain as links only, so branches read as before."""
    gone = expired.select("commit_id").distinct().withColumn("_gone", F.lit(True))
    kind = log.schema["committed_at"].dataType
    return log.join(gone, "commit_id", "left").select(
        "commit_id",
        "parent_id",
        F.when(F.col("_gone").isNull(), F.col("committed_at")).cast(kind).alias("committed_at"),
        F.when(F.col("_gone"), F.lit(EXPIRED)).otherwise(F.col("operation")).alias("operation"),
    )


def expired_files(files: DataFrame, log: DataFrame, expired: DataFrame) -> DataFrame:
    """Files that no kept commit can read, once the commits ``expired`` are dropped.

    ``files`` has (path, added_commit, removed_commit). A kept commit reads a file if the adding commit
    is in its ancestry and the removing one is not. A removal descends from the addition, so the file
    goes when as many kept commits stand above the one as above the other.
    """
    kept = live_commits(log).join(expired.select("commit_id"), "commit_id", "left_anti")
    above = kept_above(log, kept)
    added = above.select(F.col("commit_id").alias("added_commit"), F.col("above").alias("_readers"))
    removed = above.select(F.col("commit_id").alias("removed_commit"), F.col("above").alias("_without"))
    counted = files.join(added, "added_commit", "left").join(removed, "removed_commit", "left")
    # a commit the log does not know is not proven unreadable
    return counted.where(F.col("_readers") <= F.coalesce("_without", F.lit(0))).select("path")


def orphan_files(listing: DataFrame, reachable: DataFrame, older_than: Column | None = None) -> DataFrame:
    """Listed files no version refers to; with a cutoff, only those last modified before it."""
    unknown = listing.join(reachable.select("path").distinct(), "path", "left_anti")
    if older_than is not None:
        unknown = unknown.where(F.col("modified_at") < older_than)
    return unknown


def table_counts(listing: DataFrame, log: DataFrame) -> DataFrame:
    """One row: data files, bytes and versions."""
    files = listing.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    return files.withColumn("versions", live_commits(log).agg(F.count(F.lit(1))).scalar())
