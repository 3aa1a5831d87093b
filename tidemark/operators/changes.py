"""Row-level change operators over plain tables: upsert, conditional update, history dimension, evolution."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.predicates import all_of, any_null, any_of, is_true
from tidemark.operators.checks import check_rows
from tidemark.session import shared_folder

_SOURCE = "_source"
#: Bytes of stored changes up to which the target of an upsert is not shuffled.
SMALL_CHANGES = 256 << 20
#: Places that the rows of a hot key are dealt over.
PLACES = 16
#: Types whose ranges prune files.
_RANGED = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.DecimalType)


def _one_row_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows packed as (keys, _source); a key given twice fails the job when it runs.

    Grouping by the key as one struct leaves the result without a partitioning on the key columns.
    A shuffled join then exchanges both sides itself, the shape in which adaptive execution can
    split a key that holds very many target rows.
    """
    message = F.concat(F.lit("several source rows for one key: "), F.to_json("_key"))
    packed = source.groupBy(F.struct(*keys).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"), F.any_value(F.struct(*source.columns)).alias("_row")
    )
    def single(name: str) -> Column:
        # the key is guarded as well, for plans that read nothing else
        failure = F.raise_error(message).cast(packed.schema[name].dataType)
        return F.when(F.col("_rows") == 1, F.col(name)).otherwise(failure)

    return packed.select(single("_key").alias("_key"), single("_row").alias(_SOURCE)).select("_key.*", _SOURCE)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_columns: Sequence[str] | None = None,
    small_bytes: int = SMALL_CHANGES,
) -> DataFrame:
    """MERGE: matched target rows take ``set_columns`` from the source, unmatched source rows are added.

    ``set_columns`` defaults to every column outside the key. Null keys match nothing, so such
    source rows are always added. Several source rows for one key are an error.

    The changes are stored once and measured. Up to ``small_bytes`` the target does not move: it is the left side
    of one left join (Spark broadcasts a small change set, and splits a hot target key when it has to shuffle), and a
    second read of the key columns alone, pruned to the range of the changes, finds the insertions. Beyond
    that, both come from one full join in which the target is read and shuffled once; keys that a sample shows to be
    hot are dealt over several places, with a copy of their change in each.
    """
    names = target.columns
    updated = set(set_columns if set_columns is not None else [name for name in names if name not in keys])
    unknown = (updated | set(keys)) - set(names)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    source = source.select(*names)
    keyless = source.where(any_null(keys))
    spark = target.sparkSession
    path = shared_folder(spark, "changes")
    packed = _one_row_per_key(source.where(~any_null(keys)), keys)
    packed.write.parquet(path)
    changes = spark.read.schema(packed.schema).parquet(path)

    def merged(name: str) -> Column:
        if name not in updated:
            return F.col(name)
        return F.when(F.col(_SOURCE).isNotNull(), F.col(_SOURCE)[name]).otherwise(F.col(name)).alias(name)

    if _stored_bytes(spark, path) > small_bytes:
        return _merged_in_one_join(target, changes, keys, merged).unionByName(keyless)
    kept = target.join(changes, list(keys), "left").select([merged(name) for name in names])
    found = target.where(_within(target, changes, keys)).select(*keys).distinct()
    matched = found.join(changes.select(*keys), list(keys), "left_semi")
    added = changes.join(matched, list(keys), "left_anti").select([F.col(_SOURCE)[name].alias(name) for name in names])
    return kept.unionByName(added).unionByName(keyless)


def _stored_bytes(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def _within(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> Column:
    """Whether each key column is between the least and the greatest of the changes: literals, so files are pruned."""
    ranged = [name for name in keys if isinstance(target.schema[name].dataType, _RANGED)]
    if not ranged:
        return F.lit(True)
    ends = changes.agg(*[f(name).alias(f"{f.__name__}_{name}") for name in ranged for f in (F.min, F.max)]).first()
    if ends[0] is None:
        return F.lit(False)
    bounds = [(name, ends[f"min_{name}"], ends[f"max_{name}"]) for name in ranged]
    return functools.reduce(lambda x, y: x & y, [F.col(name).between(F.lit(low), F.lit(high)) for name, low, high in bounds])


def hot_keys(frame: DataFrame, keys: Sequence[str], share: float = 0.01, sample: float = 0.01) -> DataFrame:
    """Keys with more than ``share`` of the rows of a sample: 1 / share of them at most."""
    counts = frame.select(*keys).where(~any_null(keys)).sample(sample, seed=1).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    return counts.where(F.col("_rows") > max(20, share * total)).select(*keys)


def _merged_in_one_join(target: DataFrame, changes: DataFrame, keys: Sequence[str], merged) -> DataFrame:
    """Updated, untouched and added rows from one full join of the target with all changes.

    A hot key has its rows dealt over ``PLACES`` places and a copy of its change in each. It was seen in the target, so
    a copy that meets no row is no insertion. Null keys meet nothing and are dealt over many places.
    """
    spark = target.sparkSession
    path = shared_folder(spark, "hot-keys")
    hot_keys(target, keys).withColumn("_hot", F.lit(True)).write.parquet(path)
    hot = F.broadcast(spark.read.parquet(path))  # a bounded number of keys
    number = F.monotonically_increasing_id()
    place = F.when(any_null(keys), 1 + number % 10_000).when(F.col("_hot"), number % PLACES).otherwise(0)
    dealt = target.join(hot, list(keys), "left").withColumn("_place", place.cast("long")).drop("_hot").withColumn("_there", F.lit(True))
    places = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(PLACES - 1))).otherwise(F.array(F.lit(0)))
    copies = changes.join(hot, list(keys), "left").select(
        *keys, _SOURCE, F.coalesce("_hot", F.lit(False)).alias("_hot"), F.explode(places.cast("array<bigint>")).alias("_place")
    )
    met = dealt.join(copies, [*keys, "_place"], "full")
    met = met.where(F.col("_there") | ~F.col("_hot"))
    return met.select(
        [F.when(F.col("_there"), merged(name)).otherwise(F.col(_SOURCE)[name]).alias(name) for name in target.columns]
    )


def latest_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last state per key in ``order``; an aggregate, so a key changed very often collapses early."""
    rest = [name for name in changes.columns if name not in order]
    winner = F.max(F.struct(*order, *rest)).alias("_winner")
    return changes.groupBy(*keys).agg(winner).select([F.col("_winner")[name].alias(name) for name in changes.columns])


def merge_checks(
    source: DataFrame, keys: Sequence[str], run_key: str, max_rows: int, allowed: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Pre-checks of a fact batch: row bound, a single run, unique keys, allowed codes."""
    groups = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    duplicated = groups.agg(F.count_if(F.col("_rows") > 1).alias("duplicate_keys"))
    codes = [
        F.count_if(~is_true(F.col(name).isin(list(values)))).alias(f"{name}_not_allowed")
        for name, values in allowed.items()
    ]
    totals = source.agg(
        F.greatest(F.count(F.lit(1)) - max_rows, F.lit(0)).alias("rows_over_bound"),
        F.abs(F.countDistinct(run_key) - 1).alias("not_one_run"),
        *codes,
    )
    return check_rows(totals).unionByName(check_rows(duplicated))


def update_where(frame: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """UPDATE … SET … WHERE: rows where the condition holds take the assigned values."""
    hit = is_true(condition)
    kinds = {name: frame.schema[name].dataType for name in assignments}
    return frame.withColumns(
        {
            name: F.when(hit, value.cast(kinds[name])).otherwise(F.col(name))
            for name, value in assignments.items()
        }
    )


def scd2_apply(
    dimension: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: Column,
    start: str = "effective_from",
    end: str = "effective_to",
    current: str = "is_current",
) -> DataFrame:
    """Close current rows whose tracked values change and open their new versions.

    Unchanged values produce no new version; unknown keys open a first version. ``effective`` is
    the time of the change set. One change per key is required, as is one current row per key.

    The dimension is read once: one full join gives for each version and change the one or two rows that it leaves.
    Only the current version of a key meets its change, so a key of very many closed versions is spread.
    """
    packed = _one_row_per_key(changes.select(*keys, *tracked), keys)
    names = dimension.columns
    kinds = {name: dimension.schema[name].dataType for name in names}
    # a closed version meets no change: it goes to a place of its own, as do versions without a flag
    place = F.when(is_true(F.col(current)), F.lit(-1).cast("long")).otherwise(F.monotonically_increasing_id())
    met = dimension.withColumns({"_place": place, "_version": F.struct(*names)}).select(*keys, "_place", "_version").join(
        packed.withColumn("_place", F.lit(-1).cast("long")), [*keys, "_place"], "full"
    )
    version = F.col("_version")
    differs = any_of(~version[name].eqNullSafe(F.col(_SOURCE)[name]) for name in tracked)
    opens = F.col(_SOURCE).isNotNull() & (version.isNull() | differs)
    closes = version.isNotNull() & opens
    closed = {end: effective, current: F.lit(False)}
    fixed = {start: effective, end: F.lit(None), current: F.lit(True)}

    def kept(name: str) -> Column:
        return F.when(closes, closed[name].cast(kinds[name])).otherwise(version[name]) if name in closed else version[name]

    def opened(name: str) -> Column:
        if name in fixed:
            return fixed[name].cast(kinds[name])
        if name in keys:
            return F.col(name)
        return F.col(_SOURCE)[name] if name in tracked else F.lit(None).cast(kinds[name])

    rows = [
        F.when(version.isNotNull(), F.struct([kept(name).alias(name) for name in names])),
        F.when(opens, F.struct([opened(name).alias(name) for name in names])),
    ]
    return met.select(F.explode(F.array_compact(F.array(*rows))).alias("_row")).select("_row.*")


def add_columns(frame: DataFrame, columns: Mapping[str, str | T.DataType]) -> DataFrame:
    """New columns, null in the existing rows."""
    return frame.withColumns({name: F.lit(None).cast(kind) for name, kind in columns.items()})


def rename_columns(frame: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return frame.withColumnsRenamed(dict(renames))


def append_aligned(frame: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows to an evolved table: columns by name, missing ones null, types of the table."""
    extra = set(rows.columns) - set(frame.columns)
    if extra:
        raise ValueError(f"columns not in the table: {sorted(extra)}")
    aligned = rows.select(
        [
            (F.col(field.name) if field.name in rows.columns else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in frame.schema.fields
        ]
    )
    return frame.unionByName(aligned)


def scd2_checks(dimension: DataFrame, keys: Sequence[str], end: str, current: str) -> DataFrame:
    """One current row per key, and an end time exactly on the closed rows."""
    per_key = dimension.groupBy(*keys).agg(F.count_if(is_true(F.col(current))).alias("_current"))
    wrong = all_of([F.col(current), F.col(end).isNotNull()]) | all_of([~F.col(current), F.col(end).isNull()])
    return check_rows(per_key.agg(F.count_if(F.col("_current") > 1).alias("several_current_rows"))).unionByName(
        check_rows(dimension.agg(F.count_if(is_true(wrong)).alias("end_disagrees_with_flag")))
    )
