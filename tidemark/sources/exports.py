"""Sinks: deterministic sorted export, compaction, and verified table replacement."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.checks import ContractError, provenance_differences
from tidemark.operators.events import COPIES_PER_TASK
from tidemark.operators.multiset import fingerprint, fingerprint_columns
from tidemark.operators.star import measured_bytes
from tidemark.session import session_settings
from tidemark.sources.files import list_files
from tidemark.sources.tables import read_properties, replace_table

# File layout of the deterministic export and of compaction.
ROW_GROUP_ROWS = 100_000
TARGET_FILE_BYTES = 134_217_728


def export_sorted(frame: DataFrame, keys: Sequence[str], path: str, files: int | None = None) -> None:
    """Write files in one global order of the keys, then of all columns; zstd, bounded row groups.

    Copies of a row travel as (row, block) and are repeated after the range split, so neither a hot
    key nor a hot row can fill one file. Without a number of files, the rows' bytes are measured and
    each file gets about ``TARGET_FILE_BYTES`` of them before compression.
    """
    if files is None:
        files = max(1, -(-measured_bytes(frame) // TARGET_FILE_BYTES))
    rest = [name for name in frame.columns if name not in keys]
    order = [*keys, *rest]
    counted = frame.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
    blocks = counted.withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES_PER_TASK)))
    )
    ranged = blocks.repartitionByRange(files, *order, "_block").sortWithinPartitions(*order, "_block")
    size = F.least(F.lit(COPIES_PER_TASK).cast("long"), F.col("_n") - F.col("_block") * COPIES_PER_TASK)
    rows = ranged.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).select(*frame.columns)
    (
        rows.write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", ROW_GROUP_ROWS)
        .parquet(path)
    )


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Rewrite a folder of Parquet files into files of about ``file_bytes``; one row of counts.

    Nothing is shuffled: a task reads as many small files as make up the target size and writes
    one file. The source stays as it is until the caller has verified the target and switched to it.
    """
    packing = {
        "spark.sql.files.maxPartitionBytes": file_bytes,
        "spark.sql.files.openCostInBytes": 1,
        "spark.sql.files.minPartitionNum": 1,
    }
    with session_settings(spark, packing):
        spark.read.parquet(source).write.mode("overwrite").parquet(target)
    before, after = (
        list_files(spark, path, "*.parquet").agg(F.count(F.lit(1))).scalar() for path in (source, target)
    )
    return spark.range(1).select(before.alias("files_before"), after.alias("files_after"))


def observed_fingerprint(frame: DataFrame, name: str = "written") -> tuple[DataFrame, Observation]:
    """The frame with count and hash sums of its rows taken while it is being written."""
    observation = Observation(name)
    return frame.observe(observation, *fingerprint_columns(frame.columns)), observation


def replace_verified(
    frame: DataFrame,
    name: str,
    properties: Mapping[str, str],
    nonempty: bool = True,
    audit: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Replace a table with its provenance once its stored rows and properties are known to be right.

    The written rows are fingerprinted during the write and the stored ones on readback, so the result is computed
    once and compared without a shuffle. Then ``audit`` may raise on what it finds in the stored rows. All this is
    before the table takes its name: on any failure the old table is as it was.
    """
    spark = frame.sparkSession
    watched, observation = observed_fingerprint(frame)

    def verify(stored: DataFrame, stored_name: str) -> None:
        written, found = observation.get, fingerprint(stored).first().asDict()
        if nonempty and found["row_count"] == 0:
            raise ContractError(f"{name} is empty")
        if written != found:
            raise ContractError(f"{name}: stored rows differ from the rows written")
        expected = spark.createDataFrame(sorted(properties.items()), "key string, value string")
        if not provenance_differences(expected, read_properties(spark, stored_name, list(properties))).isEmpty():
            raise ContractError(f"{name}: stored properties differ")
        if audit is not None:
            audit(stored)

    replace_table(watched, name, properties, verify)
    return spark.table(name)
