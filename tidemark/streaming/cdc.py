"""Change-data capture: micro-batches of upserts kept as a change log, merged when read.

A micro-batch writes one folder ``batch_id=N`` holding the first and the last change of each of its
keys (``place`` 0 and 1), so the state does not depend on where the batches were cut. A
replayed batch overwrites the same folder, so delivery at least once has the effect of once, and
the cost of a batch follows its size and not the size of the target. The current state is the base
table merged with the last change per key; ``fold`` turns it into a new base now and then.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import merge_upsert

BATCH, PLACE = "batch_id", "place"


def change_log_writer(
    folder: str, keys: Sequence[str], order: Sequence[str]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler. ``order`` decides between several changes of a key in one batch."""
    if not order:
        raise ValueError("a change order is required: one batch may change a key several times")

    def write(batch: DataFrame, batch_id: int) -> None:
        ends = first_and_last(batch, keys, order)
        ends.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")

    return write


def first_and_last(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first change of each key as ``place`` 0 and, if it is another one, the last as 1."""
    rest = [name for name in batch.columns if name not in order]
    change = F.struct(*order, *rest)
    ends = batch.groupBy(*keys).agg(F.min(change).alias("_first"), F.max(change).alias("_last"))
    both = F.when(F.col("_first") == F.col("_last"), F.array("_first")).otherwise(F.array("_first", "_last"))
    placed = ends.select(F.posexplode(both).alias(PLACE, "_change"))
    return placed.select(*[F.col("_change")[name].alias(name) for name in batch.columns], PLACE)


def read_changes(spark: SparkSession, folder: str, schema: T.StructType, after_batch: int = -1) -> DataFrame:
    """Logged changes with their batch id; folders up to ``after_batch`` (already folded) are not read."""
    logged = T.StructType([*schema.fields, T.StructField(PLACE, T.IntegerType()), T.StructField(BATCH, T.LongType())])
    return spark.read.schema(logged).option("basePath", folder).parquet(folder).where(F.col(BATCH) > after_batch)


def net_changes(changes: DataFrame, keys: Sequence[str], set_columns: Sequence[str]) -> DataFrame:
    """One upsert per key with the effect of all its batches in order.

    Set columns carry the last value; other columns the first one, as the insert gave it and no
    later update touched it.
    """
    rest = [name for name in changes.columns if name not in (*keys, *set_columns, BATCH, PLACE)]
    first = F.min(F.struct(BATCH, PLACE, *rest)).alias("_first")
    last = F.max(F.struct(BATCH, PLACE, *set_columns)).alias("_last")
    merged = changes.groupBy(*keys).agg(first, last)
    return merged.select(
        *keys,
        *[F.col("_last")[name].alias(name) for name in set_columns],
        *[F.col("_first")[name].alias(name) for name in rest],
    )


def current_state(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], set_columns: Sequence[str]
) -> DataFrame:
    """The base table after all logged changes."""
    upserts = net_changes(changes, keys, set_columns).select(*base.columns)
    return merge_upsert(base, upserts, keys, set_columns)


def fold(base: DataFrame, changes: DataFrame, keys: Sequence[str], set_columns: Sequence[str], target: str) -> DataFrame:
    """Write the current state as a new base folder and return it; the old base is left alone."""
    current_state(base, changes, keys, set_columns).write.mode("overwrite").parquet(target)
    return base.sparkSession.read.parquet(target)
