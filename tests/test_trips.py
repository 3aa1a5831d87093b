import datetime

from pyspark.sql import functions as F

from tidemark.operators import cleaning
from tidemark.plans import applications
from tidemark.sources import exports, files, tables

DAY = datetime.datetime(2023, 1, 1, 10)


def trips(spark, rows):
    return spark.createDataFrame(
        rows, "tpep_pickup_datetime timestamp_ntz, passenger_count double, fare_amount double"
    )


def test_clean_keeps_timed_positive_rows(spark, rows):
    raw = trips(spark, [(DAY, 2.0, 5.0), (None, 1.0, 3.0), (datetime.datetime(2023, 1, 2, 11), 0.0, 4.0)])
    cleaned = cleaning.clean_trips(raw, "tpep_pickup_datetime", "passenger_count", "trip_date")
    assert rows(cleaned, "trip_date", "fare_amount") == [(datetime.date(2023, 1, 1), 5.0)]


def test_clean_filter_reaches_the_scan(spark, tmp_path):
    trips(spark, [(DAY, 2.0, 5.0)]).write.parquet(f"{tmp_path}/t")
    cleaned = cleaning.clean_trips(spark.read.parquet(f"{tmp_path}/t"), "tpep_pickup_datetime", "passenger_count", "d")
    plan = cleaned.select("d")._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1]
    assert "GreaterThan(passenger_count,0.0)" in pushed
    assert "fare_amount" not in plan.split("ReadSchema")[1]


def test_drifting_files_union_to_double(spark, tmp_path):
    for name, kind in (("a", "bigint"), ("b", "double"), ("c", "int")):
        spark.range(1).select(F.lit(2).cast(kind).alias("passenger_count"), F.lit(name).alias("n")).write.parquet(
            f"{tmp_path}/{name}"
        )
    united = files.read_parquet_normalised(spark, [f"{tmp_path}/{n}" for n in "abc"], {"passenger_count": "double"})
    assert dict(united.dtypes)["passenger_count"] == "double"
    assert united.count() == 3


def test_dedupe_then_daily(spark, rows):
    same = [(1, 2, 5.0, "x"), (1, 2, 5.0, "x"), (1, 3, 7.0, "x")]
    raw = spark.createDataFrame(same, "pickup int, dropoff int, fare double, day string")
    distinct = cleaning.dedupe(raw, ["pickup", "dropoff"])
    daily = cleaning.daily_totals(distinct, F.col("day"), "fare", "trips", "avg_fare")
    assert rows(daily) == [("x", 2, 6.0)]


def test_dedupe_prefers_the_given_order_and_keeps_null_keys(spark, rows):
    raw = spark.createDataFrame([(None, 2, "b"), (None, 1, "c"), (7, 5, "a")], "k int, v int, s string")
    assert rows(cleaning.dedupe(raw, ["k"], prefer=["v"])) == [(None, 1, "c"), (7, 5, "a")]


def test_trip_application(spark, rows, tmp_path):
    tables.ensure_namespaces(spark, ["trip_app"], str(tmp_path))
    for number, kind in enumerate(["bigint", "double"]):
        raw = spark.createDataFrame(
            [(DAY, DAY, 1.0, 5.0), (DAY, DAY, 1.0, 5.0), (DAY, None, 0.0, 9.0)],
            "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, fare_amount double",
        ).withColumn("passenger_count", F.col("passenger_count").cast(kind))
        raw.write.parquet(f"{tmp_path}/raw{number}")
    bronze = applications.ingest_trips(spark, [f"{tmp_path}/raw0", f"{tmp_path}/raw1"], "trip_app.bronze")
    assert bronze.count() == 4
    gold = applications.refine_trips(spark, "trip_app.bronze", "trip_app.silver", "trip_app.gold")
    assert rows(gold) == [(datetime.date(2023, 1, 1), 1, 5.0)]


def test_export_is_globally_sorted_with_copies(spark, tmp_path):
    frame = spark.range(2000).select((F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("v"))
    exports.export_sorted(frame, ["k"], f"{tmp_path}/out", files=3)
    names = sorted(path.name for path in (tmp_path / "out").glob("*.parquet"))
    assert 1 < len(names) <= 3 and all("zstd" in name for name in names)
    import pyarrow.parquet as pq

    stored = [row for name in names for row in pq.read_table(tmp_path / "out" / name).to_pylist()]
    stored = [(row["k"], row["v"]) for row in stored]
    assert stored == sorted(stored)
    assert sorted(stored) == sorted((row["k"], row["v"]) for row in frame.collect())


def test_export_bounds_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    exports.export_sorted(spark.range(250_000), ["id"], f"{tmp_path}/out", files=1)
    (path,) = (tmp_path / "out").glob("*.parquet")
    meta = pq.ParquetFile(path).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [100_000, 100_000, 50_000]


def test_compaction_reduces_files_and_keeps_rows(spark, tmp_path):
    frame = spark.range(5000)
    frame.repartition(20).write.parquet(f"{tmp_path}/small")
    counts = exports.compact(spark, f"{tmp_path}/small", f"{tmp_path}/large").first()
    assert counts["files_before"] == 20 and counts["files_after"] == 1
    assert spark.read.parquet(f"{tmp_path}/large").count() == 5000
    total = sum(path.stat().st_size for path in (tmp_path / "small").glob("*.parquet"))
    exports.compact(spark, f"{tmp_path}/small", f"{tmp_path}/medium", file_bytes=total // 4)
    assert 4 <= len(list((tmp_path / "medium").glob("*.parquet"))) <= 6
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
