"""Digests of files of any size: a file is hashed stretch by stretch, by one task after the other."""

from __future__ import annotations

import collections
import itertools
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sha256_state import Sha256
from tidemark.operators.checks import ContractError
from tidemark.session import session_settings, shared_folder

#: Bytes of a file that one task reads.
STRETCH = 128 << 20
#: Bytes of one stored row.
PIECE = 1 << 18
#: A task takes so many stored rows at once.
PIECES = 64
BYTE_ORDER_MARK = b"\xef\xbb\xbf"


def _pieces(lines: DataFrame) -> DataFrame:
    """(path, start, number, bytes, content): the lines of each split with their line feeds, in rows of a bounded size."""
    schema = pa.schema([
        ("path", pa.string()), ("start", pa.int64()), ("number", pa.int64()), ("bytes", pa.int64()), ("content", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count()
        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns), strict=True)
            for (path, start), group in itertools.groupby(rows, key=lambda row: row[:2]):
                whole = b"\n".join([line for _, _, line in group]) + b"\n"
                parts = [whole[at : at + PIECE] for at in range(0, len(whole), PIECE)]
                for part in parts:
                    yield pa.RecordBatch.from_pylist(
                        [{"path": path, "start": start, "number": next(number), "bytes": len(part), "content": part}], schema=schema
                    )

    line = F.col("line").cast("binary").alias("line")
    return lines.select("path", "start", line).mapInArrow(run, "path string, start bigint, number bigint, bytes bigint, content binary")


def long_digests(lines: DataFrame, sizes: Mapping[str, int], stretch: int = STRETCH) -> dict[str, str]:
    """sha256 of each file in ``sizes`` (path: bytes), none of them compressed; ``lines`` is ``files.raw_lines`` of them.

    A hash runs over a file from its first byte to its last, but no task has to. The files are read once, split by
    split, and stored by stretches of ``stretch`` bytes. Then there is one job for each stretch, in order: its
    tasks, one for each file, take the state of the hash up where the stretch before put it down. The driver holds a
    state of 112 bytes for each file. What the line reader does not say, a byte order mark and whether the last line has
    its line feed, follows from the size of the file.
    """
    spark = lines.sparkSession
    folder = shared_folder(spark, "stretches")
    pieces = _pieces(lines).withColumn("stretch", F.floor(F.col("start") / stretch))
    with session_settings(spark, {"spark.sql.files.maxPartitionBytes": stretch}):
        pieces.write.partitionBy("stretch").option("compression", "none").parquet(folder)
    stored = spark.read.parquet(folder)
    counts = stored.groupBy("path", "stretch").agg(F.sum("bytes").alias("bytes")).collect()
    read = collections.Counter()
    for row in counts:
        read[row["path"]] += row["bytes"]
    states, left = {}, dict(sizes)
    for path, size in sizes.items():
        found = read[path] - size
        if found not in (0, 1, -2, -3):
            raise ContractError(f"{path}: {found} bytes more than its size were read")
        begun = Sha256()
        if found < 0:
            begun.update(BYTE_ORDER_MARK)
            left[path] -= len(BYTE_ORDER_MARK)
        states[path] = begun.state()
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": PIECES}
    for number in sorted({row["stretch"] for row in counts}):
        ordered = stored.where(F.col("stretch") == number).select("path", "start", "number", "content")
        ordered = ordered.repartition("path").sortWithinPartitions("path", "start", "number").select("path", "content")
        with session_settings(spark, settings):
            for row in ordered.mapInArrow(_taken_up(dict(states), dict(left)), "path string, state binary, bytes bigint").collect():
                states[row["path"]] = bytes(row["state"])
                left[row["path"]] -= row["bytes"]
    return {path: Sha256(state).hexdigest() for path, state in states.items()}


def _taken_up(states: Mapping[str, bytes], left: Mapping[str, int]):
    """The state of each file's hash after the rows of a partition, and how many bytes they were; rows are ordered."""
    schema = pa.schema([("path", pa.string()), ("state", pa.binary()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running: dict[str, Sha256] = {}
        fed: dict[str, int] = {}
        for batch in batches:
            for path, content in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if path not in running:
                    running[path], fed[path] = Sha256(states[path]), 0
                taken = content[: left[path] - fed[path]]  # the line feed that the last line does not have
                running[path].update(taken)
                fed[path] += len(taken)
        found = [(path, one.state(), fed[path]) for path, one in running.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in found], schema=schema)

    return run
