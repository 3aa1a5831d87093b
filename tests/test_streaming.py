import datetime

from pyspark.sql import functions as F

from tidemark.queries import QUERIES, streaming
from tidemark.streaming import cdc, ingest, windows

T0 = datetime.datetime(2026, 1, 1)
EVENTS = "ts timestamp, event string"


def minutes(*values):
    return [(T0 + datetime.timedelta(minutes=value), "click") for value in values]


def deliver(spark, tmp_path, *batches):
    for batch in batches:
        spark.createDataFrame(batch, EVENTS).write.mode("append").parquet(f"{tmp_path}/in")
        stream = ingest.file_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], EVENTS).schema, "parquet")
        stored = ingest.drain_to_folder(windows.window_counts(stream), f"{tmp_path}/out", f"{tmp_path}/cp")
    return {row["window_start"]: row["count"] for row in stored.collect()}


def test_only_closed_windows_are_emitted(spark, tmp_path):
    found = deliver(spark, tmp_path, minutes(0, 1, 6, 16))
    assert found == {T0: 2}


def test_late_rows_inside_the_watermark_count_and_others_drop(spark, tmp_path):
    found = deliver(spark, tmp_path, minutes(1, 7, 16), minutes(8, 2, 40))
    assert found == {T0: 1, T0 + datetime.timedelta(minutes=5): 2, T0 + datetime.timedelta(minutes=15): 1}


def test_clicks_decode_to_typed_rows(spark):
    clicks = ingest.click_events(spark, 25, F.lit(T0))
    decoded = ingest.decode_payload(clicks.select(F.encode("value", "utf-8").alias("value")))
    rows = decoded.orderBy("ts").collect()
    assert [row["user_id"] for row in rows[:11]] == [f"u{i % 10}" for i in range(11)]
    assert rows[24]["ts"] == T0 + datetime.timedelta(seconds=24) and rows[0]["event"] == "click"


def test_generation_checkpoint_path():
    path = ingest.generation_checkpoint("s3a://cp/", "gh_events_file", "tiny", "a" * 32, "b" * 64)
    assert path == f"s3a://cp/gh_events_file/tiny/{'a' * 32}/{'b' * 64}/"


def test_second_drain_continues_from_the_checkpoint(spark, tmp_path):
    schema = spark.createDataFrame([], EVENTS).schema
    for batch in (minutes(0), minutes(1), []):
        if batch:
            spark.createDataFrame(batch, EVENTS).write.mode("append").json(f"{tmp_path}/in")
        stream = ingest.file_stream(spark, f"{tmp_path}/in", schema)
        stored = ingest.drain_to_folder(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert stored.count() == 2


RETAIL = "invoice string, quantity int, price double, seq int"


def test_replayed_batches_change_nothing(spark, tmp_path, rows):
    write = cdc.change_log_writer(f"{tmp_path}/log", ["invoice"], ["seq"])
    first = spark.createDataFrame([("A", 1, 1.0, 1), ("A", 2, 2.0, 2), ("B", 5, 5.0, 1)], RETAIL)
    second = spark.createDataFrame([("A", 9, 9.0, 1)], RETAIL)
    for batch, number in ((first, 0), (second, 1), (second, 1), (first, 0)):
        write(batch, number)
    changes = cdc.read_changes(spark, f"{tmp_path}/log", first.schema).drop("seq")
    base = spark.createDataFrame([("B", 0, 0.5), ("C", 7, 7.0)], "invoice string, quantity int, price double")
    state = cdc.current_state(base, changes, ["invoice"], ["quantity", "price"])
    assert rows(state) == [("A", 9, 9.0), ("B", 5, 5.0), ("C", 7, 7.0)]
    partial = cdc.current_state(base, changes, ["invoice"], ["quantity"])
    assert rows(partial) == [("A", 9, 1.0), ("B", 5, 0.5), ("C", 7, 7.0)]


def test_the_state_does_not_depend_on_where_batches_are_cut(spark, tmp_path, rows):
    changes = [("A", 1, 10.0, 1), ("A", 2, 99.0, 2), ("A", 3, 98.0, 3), ("B", None, None, 1)]
    base = spark.createDataFrame([], "invoice string, quantity int, price double")
    for name, cuts in {"one": [changes], "two": [changes[:1], changes[1:]], "three": [changes[:1], changes[1:2], changes[2:]]}.items():
        write = cdc.change_log_writer(f"{tmp_path}/{name}", ["invoice"], ["seq"])
        for number, batch in enumerate(cuts):
            write(spark.createDataFrame(batch, RETAIL), number)
        read = cdc.read_changes(spark, f"{tmp_path}/{name}", spark.createDataFrame([], RETAIL).schema).drop("seq")
        assert rows(cdc.current_state(base, read, ["invoice"], ["quantity"])) == [("A", 3, 10.0), ("B", None, None)]


def test_folding_some_batches_gives_the_same_state(spark, tmp_path, rows):
    write = cdc.change_log_writer(f"{tmp_path}/log", ["invoice"], ["seq"])
    schema = spark.createDataFrame([], RETAIL).schema
    for number in range(3):
        write(spark.createDataFrame([("A", number, float(number), 1), (f"N{number}", 1, 1.0, 1)], RETAIL), number)
    read = lambda after=-1: cdc.read_changes(spark, f"{tmp_path}/log", schema, after).drop("seq")
    base = spark.createDataFrame([], "invoice string, quantity int, price double")
    whole = cdc.current_state(base, read(), ["invoice"], ["quantity"])
    folded = cdc.fold(base, read().where("batch_id <= 1"), ["invoice"], ["quantity"], f"{tmp_path}/base")
    assert rows(cdc.current_state(folded, read(1), ["invoice"], ["quantity"])) == rows(whole)


def test_deliveries_land_compressed_in_files_of_a_bounded_size(spark, tmp_path, rows, monkeypatch):
    moment = datetime.datetime(2026, 1, 1)
    lines = [
        (key, 1, flag, float(place), float(100 * place), moment + datetime.timedelta(days=place), key, key)
        for key in range(300)
        for place, flag in enumerate(["A", "N", None if key % 2 else "R"])
    ]
    kinds = "l_orderkey long, l_linenumber int, l_returnflag string, l_quantity double, l_extendedprice double, "
    frame = spark.createDataFrame(lines, kinds + "l_shipdate timestamp, l_partkey long, l_suppkey long")
    frame.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(streaming, "DELIVERED_PER_FILE", 100)
    monkeypatch.setattr(streaming, "shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    state = rows(QUERIES["cdc_fold"](spark, str(tmp_path)))
    assert state == sorted(((key, 1, 2.0, 0.0) for key in range(300)), key=lambda row: tuple(map(str, row)))
    landed = [path for path in (tmp_path / "fold" / "landing").iterdir() if path.name.startswith("part-")]
    assert len(landed) == 9 and all(path.name.endswith(".json.gz") for path in landed)
    assert {spark.read.json(str(path)).count() for path in landed} == {100}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
