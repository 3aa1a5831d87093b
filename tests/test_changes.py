import datetime
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidemark.operators import changes, multiset, versions
from tidemark.queries import QUERIES
from tidemark.session import session_settings

RETAIL = "invoice string, stock_code string, quantity int, price double"
TARGET = [("A1", "SKU1", 5, 2.0), ("A2", "SKU2", 3, 4.0)]
SOURCE = [("A1", "SKU1", 10, 2.5), ("A3", "SKU3", 1, 9.0)]
KEYS = ["invoice", "stock_code"]


def frames(spark, target=TARGET, source=SOURCE):
    return spark.createDataFrame(target, RETAIL), spark.createDataFrame(source, RETAIL)


def test_partial_upsert_keeps_the_old_price_and_replays(spark, rows):
    target, source = frames(spark)
    merged = changes.merge_upsert(target, source, KEYS, ["quantity"])
    assert rows(merged) == [("A1", "SKU1", 10, 2.0), ("A2", "SKU2", 3, 4.0), ("A3", "SKU3", 1, 9.0)]
    assert multiset.same_rows(merged, changes.merge_upsert(merged, source, KEYS, ["quantity"]))


def test_full_upsert_sets_every_column(spark, rows):
    target, source = frames(spark)
    assert ("A1", "SKU1", 10, 2.5) in rows(changes.merge_upsert(target, source, KEYS))


def test_null_keys_match_nothing(spark, rows):
    target, source = frames(spark, [("A1", None, 1, 1.0)], [("A1", None, 2, 2.0), ("A1", None, 3, 3.0)])
    assert len(rows(changes.merge_upsert(target, source, KEYS))) == 3


def test_matched_null_values_are_set(spark, rows):
    target, source = frames(spark, source=[("A1", "SKU1", None, None)])
    assert ("A1", "SKU1", None, None) in rows(changes.merge_upsert(target, source, KEYS))


def test_repeated_source_key_fails(spark):
    target, source = frames(spark, source=[SOURCE[0], SOURCE[0]])
    with pytest.raises(Exception, match="several source rows for one key"):
        changes.merge_upsert(target, source, KEYS).collect()
    with pytest.raises(Exception, match="several source rows for one key"):
        changes.merge_upsert(target, source, KEYS).count()


def test_repeated_target_key_updates_all_its_rows(spark, rows):
    target, source = frames(spark, target=[TARGET[0]] * 3)
    merged = rows(changes.merge_upsert(target, source, KEYS, ["quantity"]))
    assert merged == [("A1", "SKU1", 10, 2.0)] * 3 + [("A3", "SKU3", 1, 9.0)]


def test_small_change_set_does_not_shuffle_the_target(spark, tmp_path):
    target, source = frames(spark)
    target.write.parquet(f"{tmp_path}/target")
    merged = changes.merge_upsert(spark.read.parquet(f"{tmp_path}/target"), source, KEYS, ["quantity"])
    merged.collect()
    updated = merged._jdf.queryExecution().executedPlan().toString().split("Final Plan")[1].split("Initial Plan")[0]
    first_branch = updated.split("Scan parquet")[0]
    assert "BroadcastHashJoin" in first_branch


def scans(frame, columns):
    """How often the plan reads a table of files with these columns."""
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(r"Relation \[" + ",".join(rf"{name}#\d+L?" for name in columns) + r"\] parquet", plan))


@pytest.mark.parametrize("small_bytes", [0, changes.SMALL_CHANGES])
def test_large_change_sets_read_the_target_once(spark, tmp_path, rows, small_bytes):
    """Null, repeated and hot keys, on both paths, against the rule row by row."""
    given = [(None if at % 50 == 9 else 0 if at % 3 == 0 else at % 700, at % 5, at) for at in range(6000)]
    news = [(key, 1, -key) for key in range(0, 1500, 2)] + [(None, 1, 5), (None, 2, 6)]
    spark.createDataFrame(given, "k long, j int, v long").repartition(4).write.parquet(f"{tmp_path}/target")
    target, source = spark.read.parquet(f"{tmp_path}/target"), spark.createDataFrame(news, "k long, j int, v long")
    merged = changes.merge_upsert(target, source, ["k", "j"], ["v"], small_bytes)
    new = {(k, j): v for k, j, v in news if k is not None}
    expected = [(k, j, new.get((k, j), v)) for k, j, v in given]
    expected += [(k, j, v) for (k, j), v in new.items() if not any(row[:2] == (k, j) for row in given)]
    expected += [row for row in news if row[0] is None]
    assert rows(merged) == sorted(expected, key=lambda row: tuple((value is not None, str(value)) for value in row))
    assert scans(merged, target.columns) == (1 if small_bytes == 0 else 2)


def test_hot_key_is_dealt_over_places(spark, tmp_path):
    spark.range(30_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v").repartition(4).write.parquet(f"{tmp_path}/hot")
    target = spark.read.parquet(f"{tmp_path}/hot")
    source = spark.range(0, 60_000, 4).selectExpr("id AS k", "-1L AS v")
    assert [row.k for row in changes.hot_keys(target, ["k"]).collect()] == [0]
    with session_settings(spark, {"spark.sql.shuffle.partitions": 32, "spark.sql.adaptive.enabled": "false"}):
        merged = changes.merge_upsert(target, source, ["k"], small_bytes=0)
        parts = merged.groupBy(F.spark_partition_id()).count().collect()
    assert merged.where("k = 0 AND v = -1").count() == 10_000
    assert max(row["count"] for row in parts) < 6_000
    assert merged.count() == 30_000 + source.join(target, "k", "left_anti").count()


def test_latest_change_wins(spark, rows):
    frame = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("b", 1, 7)], "k string, seq int, v int")
    assert rows(changes.latest_per_key(frame, ["k"], ["seq"])) == [("a", 2, 6), ("b", 1, 7)]


def test_merge_pre_checks(spark, violations):
    batch = spark.createDataFrame([("r1", "a", "pass"), ("r1", "a", "odd"), ("r2", "b", "warn")], "run string, rule string, status string")
    found = violations(changes.merge_checks(batch, ["run", "rule"], "run", 2, {"status": ["pass", "warn"]}))
    assert found == {"rows_over_bound": 1, "not_one_run": 1, "status_not_allowed": 1, "duplicate_keys": 1}


DIMENSION = "customer_id string, segment string, effective_from timestamp, effective_to timestamp, is_current boolean"
START, CHANGE = datetime.datetime(2023, 1, 1), datetime.datetime(2024, 1, 1)


def test_scd2_closes_and_opens(spark, rows):
    dimension = spark.createDataFrame([("C1", "standard", START, None, True), ("C2", "standard", START, None, True)], DIMENSION)
    changed = spark.createDataFrame([("C1", "premium"), ("C2", "standard"), ("C3", None)], "customer_id string, segment string")
    after = changes.scd2_apply(dimension, changed, ["customer_id"], ["segment"], F.lit(CHANGE))
    assert rows(after.select("customer_id", "segment", F.col("effective_to").isNotNull().alias("closed"), "is_current")) == sorted(
        [("C1", "standard", True, False), ("C1", "premium", False, True), ("C2", "standard", False, True), ("C3", None, False, True)],
        key=lambda row: tuple((value is not None, str(value)) for value in row),
    )
    again = changes.scd2_apply(after, changed, ["customer_id"], ["segment"], F.lit(CHANGE))
    assert multiset.same_rows(after, again)


def test_scd2_reads_the_dimension_once(spark, tmp_path, rows):
    """Closed versions, a missing flag, null keys and values, new and unchanged keys, in one read."""
    given = [(f"C{at % 40}", "abc"[at % 3], START, CHANGE, False) for at in range(40, 400)]
    given += [(f"C{at}", "abc"[at % 3], START, None, True) for at in range(40)]
    given += [(None, "a", START, None, True), ("C9", "z", START, None, None), ("N", None, START, None, True)]
    spark.createDataFrame(given, DIMENSION).write.parquet(f"{tmp_path}/dimension")
    news = [(f"C{at}", "b") for at in range(0, 60, 2)] + [(None, "b"), ("N", None)]
    changed = spark.createDataFrame(news, "customer_id string, segment string")
    later = datetime.datetime(2025, 1, 1)
    dimension = spark.read.parquet(f"{tmp_path}/dimension")
    after = changes.scd2_apply(dimension, changed, ["customer_id"], ["segment"], F.lit(later))
    expected, live = [], {row[0]: row for row in given if row[4] and row[0] is not None}
    new = dict(news)
    for row in given:
        moves = row[4] and row[0] in new and row[0] is not None and new[row[0]] != row[1]
        expected.append((*row[:3], later, False) if moves else row)
    expected += [(k, v, later, None, True) for k, v in news if k is None or k not in live or live[k][1] != v]
    assert rows(after) == sorted(expected, key=lambda row: tuple((value is not None, str(value)) for value in row))
    assert scans(after, dimension.columns) == 1


def test_scd2_closed_rows_are_not_touched(spark, violations):
    dimension = spark.createDataFrame([("C1", "a", START, CHANGE, False), ("C1", "b", CHANGE, None, True)], DIMENSION)
    changed = spark.createDataFrame([("C1", "a")], "customer_id string, segment string")
    later = datetime.datetime(2025, 1, 1)
    after = changes.scd2_apply(dimension, changed, ["customer_id"], ["segment"], F.lit(later))
    assert after.where("effective_to = timestamp'2024-01-01'").count() == 1 and after.count() == 3
    assert set(violations(changes.scd2_checks(after, ["customer_id"], "effective_to", "is_current")).values()) == {0}


def test_schema_evolution(spark, rows):
    table = spark.createDataFrame([("1", "PushEvent", "octocat")], "id string, type string, actor_login string")
    evolved = changes.rename_columns(changes.add_columns(table, {"repo_name": "string"}), {"type": "event_type"})
    new = spark.createDataFrame([("2", "WatchEvent", "torvalds", "linux")], "id string, event_type string, actor_login string, repo_name string")
    assert rows(changes.append_aligned(evolved, new)) == [("1", "PushEvent", "octocat", None), ("2", "WatchEvent", "torvalds", "linux")]
    with pytest.raises(ValueError):
        changes.append_aligned(evolved, new.withColumn("x", F.lit(1)))


LOG = "commit_id long, parent_id long, committed_at timestamp, operation string"


def when(day):
    return datetime.datetime(2026, 1, day)


@pytest.fixture
def history(spark):
    log = spark.createDataFrame([(1, None, when(1), "append"), (2, 1, when(2), "append"), (3, 2, when(3), "append")], LOG)
    refs = spark.createDataFrame([("main", 3)], "name string, commit_id long")
    data = spark.createDataFrame([("a", 1, None), ("b", 2, 3), ("c", 3, None)], "v string, added_commit long, removed_commit long")
    return log, refs, data


def test_reads_as_of_and_by_branch(history, rows):
    log, refs, data = history
    assert rows(versions.read_as_of(data, 2)) == [("a",), ("b",)]
    assert rows(versions.read_branch(data, log, refs)) == [("a",), ("c",)]


def test_branch_reads_do_not_shuffle_rows(history):
    log, refs, data = history
    plan = versions.read_branch(data, log, refs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan


def test_rollback_then_commit_leaves_the_old_line(history, rows, spark):
    log, refs, data = history
    refs = versions.create_branch(refs, "audit")
    log, refs = versions.roll_back(log, refs, 1, 4, F.lit(when(4)))
    log, refs = versions.append_commit(log, refs, 5, F.lit(when(5)))
    data = data.unionAll(spark.createDataFrame([("d", 5, None)], data.schema))
    assert rows(versions.read_branch(data, log, refs)) == [("a",), ("d",)]
    assert rows(versions.read_branch(data, log, refs, "audit")) == [("a",), ("c",)]
    assert rows(versions.branch_head(log, refs), "name", "commit_id") == [("main", 5)]
    assert log.where("commit_id = 5").first()["parent_id"] == 4


def test_branch_is_created_once(history, rows):
    log, refs, _ = history
    refs = versions.create_branch(refs, "audit")
    _, refs = versions.append_commit(log, refs, 4, F.lit(when(4)))
    assert rows(versions.create_branch(refs, "audit")) == [("audit", 3), ("main", 4)]


def test_expiry_keeps_the_newest_and_every_head(history, rows):
    log, refs, data = history
    branch = versions.create_branch(refs, "audit").withColumn("commit_id", F.when(F.col("name") == "audit", 1).otherwise(F.col("commit_id")).cast("long"))
    assert rows(versions.expire(log, refs, F.lit(when(9))), "commit_id") == [(1,), (2,)]
    assert rows(versions.expire(log, branch, F.lit(when(9))), "commit_id") == [(2,)]
    assert rows(versions.expire(log, refs, F.lit(when(2))), "commit_id") == [(1,)]
    paths = data.selectExpr("v as path", "added_commit", "removed_commit")
    assert rows(versions.expired_files(paths, log, versions.expire(log, refs, F.lit(when(9))))) == [("b",)]
    assert rows(versions.expired_files(paths, log, versions.expire(log, refs, F.lit(when(2))))) == []


def test_long_chains_are_followed(spark):
    log = spark.range(1, 10_001).selectExpr("id commit_id", "nullif(id - 1, 0) parent_id")
    assert versions.ancestry(log, spark.range(9000, 9001).toDF("commit_id")).count() == 9000


def test_expiry_after_a_rollback_lists_no_live_file(history, rows, spark):
    """A file removed by a commit that was rolled back is read again, and so it stays."""
    log, refs, _ = history
    files = spark.createDataFrame([("f", 1, 3), ("g", 1, 2), ("h", 3, None)], "path string, added_commit long, removed_commit long")
    log, refs = versions.roll_back(log, refs, 2, 4, F.lit(when(4)))
    data = files.withColumnRenamed("path", "v")
    before = rows(versions.read_branch(data, log, refs))
    expired = versions.expire(log, refs, F.lit(when(9)))
    assert before == [("f",)] and rows(expired, "commit_id") == [(1,), (2,), (3,)]
    assert rows(versions.expired_files(files, log, expired)) == [("g",), ("h",)]
    after = versions.drop_commits(log, expired)
    assert rows(versions.read_branch(data, after, refs)) == before
    assert rows(versions.history(after), "commit_id") == [(4,)]
    assert rows(versions.expire(after, refs, F.lit(when(9)))) == []


def test_each_branch_keeps_its_newest(history, rows):
    log, refs, _ = history
    branch = versions.create_branch(refs, "audit").withColumn("commit_id", F.when(F.col("name") == "audit", 2).otherwise(F.col("commit_id")).cast("long"))
    assert rows(versions.expire(log, branch, F.lit(when(9)), retain_last=2), "commit_id") == []
    assert rows(versions.expire(log, refs, F.lit(when(9)), retain_last=2), "commit_id") == [(1,)]


def test_long_histories_are_those_of_short_ones(spark, rows, monkeypatch):
    """Both ways through the same log: branches, a rollback, an unknown parent and a repeated head."""
    parents = {1: None, 2: 1, 3: 2, 4: 3, 5: 2, 6: 5, 7: 4, 8: 99, 9: 6, 10: 9}
    log = spark.createDataFrame([(c, p, when(1), "append") for c, p in parents.items()], LOG)
    refs = spark.createDataFrame([("main", 7), ("audit", 10), ("odd", 8), ("twin", 7), ("gone", 55)], "name string, commit_id long")
    kept = spark.createDataFrame([(7,), (3,), (10,), (8,)], "commit_id long")
    short = rows(versions.branch_ancestry(log, refs)), rows(versions.kept_above(log, kept))
    monkeypatch.setattr(versions, "SHORT_LOG", 0)
    assert short == (rows(versions.branch_ancestry(log, refs)), rows(versions.kept_above(log, kept)))
    assert (2, 3) in short[1] and ("audit", 1) in short[0] and ("odd", 99) in short[0]


def test_a_replayed_merge_reads_stored_results(spark, tmp_path, monkeypatch):
    orders = [(key, key % 7, "FOP"[key % 3], 10.0 * key) for key in range(90)]
    frame = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")
    frame.write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr("tidemark.queries.changes.shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting, None)
    report = QUERIES["merge_replay"](spark, str(tmp_path))
    assert spark.conf.get(setting, None) == before
    # no task that counts the rows sorts them for a join as well
    assert "Join" not in plan_of(report)
    assert tuple(report.first()) == (0, 0, True)
    once = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/merged-once").collect()))
    changed = [(key, customer, status, price + 100 * (status == "F")) for key, customer, status, price in orders]
    added = [(key + 1_000_000_000_000, customer, "N", price) for key, customer, status, price in orders if status == "P"]
    assert once == sorted(changed + added)
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/merged-twice").collect())) == once
