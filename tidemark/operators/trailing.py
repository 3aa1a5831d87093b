"""Order statistics of trailing ranges: every range is a rank search in a wavelet matrix, none is copied out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import shared_folder

#: Counted rows (one for each step and value) that one task searches at once.
GROUP_ROWS = 2_000_000
#: Value ranges that a larger group is divided into.
FAN_OUT = 64
_QUERIES_AT_ONCE = 1 << 18

_LOWER, _UPPER = 0, 1


class Wavelet:
    """Weighted rows in the order of their steps; finds the value of a rank among the rows of a range of places.

    Values are numbered in order. Bit by bit, from the highest, the rows with a 0 go before those with a 1; a range
    of places stays one range on either side, found by counts of the zeros up to a place. One level is held at a time.
    """

    def __init__(self, values: np.ndarray, weights: np.ndarray):
        self.distinct, self.number = np.unique(values, return_inverse=True)
        self.weights = weights

    def select(self, begin: np.ndarray, end: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value at ``rank`` (from 0, each row counting as often as its weight) of places [begin, end)."""
        begin, end, rank = begin.copy(), end.copy(), rank.copy()
        number, weights = self.number.copy(), self.weights.copy()
        found = np.zeros(len(rank), np.int64)
        for bit in range(max(0, int(len(self.distinct) - 1).bit_length()) - 1, -1, -1):
            one = (number >> bit) & 1
            zeros = np.concatenate(([0], np.cumsum(1 - one)))
            weight = np.concatenate(([0], np.cumsum(np.where(one, 0, weights))))
            below = weight[end] - weight[begin]
            right = rank >= below
            rank = np.where(right, rank - below, rank)
            begin = np.where(right, zeros[-1] + begin - zeros[begin], zeros[begin])
            end = np.where(right, zeros[-1] + end - zeros[end], zeros[end])
            found |= right.astype(np.int64) << bit
            order = np.argsort(one, kind="stable")
            number, weights = number[order], weights[order]
        return self.distinct[found]


def _ranges(steps: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sorted steps in (at - width, at]."""
    return np.searchsorted(steps, at - width, "right"), np.searchsorted(steps, at, "right")


def _all_queries(steps: np.ndarray, weights: np.ndarray, width: int, q: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(step, samples, rank below, rank above, fraction) of every step whose range has a sample, piece by piece."""
    if not len(steps):
        return
    until = np.concatenate(([0], np.cumsum(weights)))
    distinct = np.unique(steps)
    fresh = np.minimum(np.diff(distinct, append=distinct[-1] + width), width)  # steps that only this sample opens
    ends = np.cumsum(fresh)
    for first in range(0, int(ends[-1]), _QUERIES_AT_ONCE):
        number = np.arange(first, min(first + _QUERIES_AT_ONCE, int(ends[-1])))
        own = np.searchsorted(ends, number, "right")
        at = distinct[own] + number - (ends - fresh)[own]
        begin, end = _ranges(steps, at, width)
        samples = until[end] - until[begin]
        position = q * (samples - 1)
        yield at, samples, np.floor(position).astype(np.int64), np.ceil(position).astype(np.int64), position


def _kinds(series_type: str) -> str:
    return f"_series {series_type}, _at bigint, _side int, _quantile double, samples bigint"


def trailing_ranks(
    counted: DataFrame, width: int, q: float, group_rows: int = GROUP_ROWS, fan_out: int = FAN_OUT
) -> DataFrame:
    """(_series, _at, _quantile, samples) of the last ``width`` steps at every step that has a sample in them.

    ``counted`` has _series, _step, _value (double, not null) and _n, once for each step and value. The quantile is
    interpolated between the two nearest samples.

    A series of at most ``group_rows`` rows is searched whole. A larger one is divided by value: its counts by step
    and range of values, no more than the steps times ``fan_out``, tell in which range the two samples of every step
    lie and at what rank; only ranges that are asked for go on, and are divided again while they are too large. Rows
    are never copied into the ranges of steps that hold them, and no task gets more rows than these bounds.
    """
    spark = counted.sparkSession
    series_type = dict(counted.dtypes)["_series"]
    path = shared_folder(spark, "trailing")
    stages = iter(range(1 << 20))

    def stored(frame: DataFrame) -> DataFrame:
        place = f"{path}/{next(stages)}"
        frame.write.parquet(place)
        return spark.read.schema(frame.schema).parquet(place)

    rows = stored(counted.select("_series", F.lit(0).cast("bigint").alias("_node"), "_step", "_value", "_n"))
    queries, answers = None, []
    while True:
        sizes = rows.groupBy("_series", "_node").agg(
            F.count(F.lit(1)).alias("_rows"), F.min("_value").alias("_least"), F.max("_value").alias("_most")
        )
        large = sizes.where((F.col("_rows") > group_rows) & (F.col("_least") < F.col("_most"))).select("_series", "_node", "_least")
        large = stored(large)
        if large.isEmpty():
            answers.append(_searched(rows, queries, width, q, series_type))
            break
        same = [F.col(f"r.{name}").eqNullSafe(F.col(f"l.{name}")) for name in ("_series", "_node")]
        answers.append(_searched(rows.alias("r").join(large.alias("l"), same, "left_anti"), _of(queries, large, "left_anti"), width, q, series_type))
        inner = [at / fan_out for at in range(1, fan_out)]
        divided = rows.alias("r").join(large.alias("l"), same).select("r.*", "_least")
        edges = divided.groupBy("_series", "_node", "_least").agg(F.percentile_approx("_value", F.lit(inner), F.lit(1000)).alias("_edges"))
        edges = edges.select("_series", "_node", F.array_union(F.array("_least"), "_edges").alias("_edges")).alias("l")
        bucket = F.size(F.filter("_edges", lambda edge: edge < F.col("_value")))
        below = (F.col("r._node") * (fan_out + 1) + bucket + 1).cast("bigint").alias("_below")
        dealt = stored(rows.alias("r").join(edges, same).select("r.*", below))
        by_step = dealt.groupBy("_series", "_node", "_below", "_step").agg(F.sum("_n").alias("_n"))
        queries = stored(_descended(by_step, _of(queries, large, "left_semi"), width, q, series_type))
        asked = queries.select("_series", "_node").distinct().alias("l")
        rows = dealt.select("_series", F.col("_below").alias("_node"), "_step", "_value", "_n").alias("r")
        rows = stored(rows.join(asked, same, "left_semi"))
    found = answers[0]
    for more in answers[1:]:
        found = found.unionByName(more)
    if len(answers) == 1:  # both samples of a step were found together
        return found.select("_series", "_at", "_quantile", "samples")
    # the two samples of a step may have been found in different groups
    sides = found.groupBy("_series", "_at").agg(
        F.max(F.when(F.col("_side") == _LOWER, F.col("_quantile"))).alias("_lower"),
        F.max(F.when(F.col("_side") == _UPPER, F.col("_quantile"))).alias("_upper"),
        F.max(F.when(F.col("_side").isNull(), F.col("_quantile"))).alias("_whole"),
        F.max("samples").alias("samples"),
    )
    position = F.lit(q) * (F.col("samples") - 1)
    between = (F.ceil(position) - position) * F.col("_lower") + (position - F.floor(position)) * F.col("_upper")
    same_value = (F.col("_lower") == F.col("_upper")) | (position == F.floor(position))
    value = F.when(F.col("_whole").isNotNull(), F.col("_whole")).when(same_value, F.col("_lower")).otherwise(between)
    return sides.select("_series", "_at", value.alias("_quantile"), "samples")


def _of(queries: DataFrame | None, large: DataFrame, how: str) -> DataFrame | None:
    if queries is None:
        return None
    same = [F.col(f"q.{name}").eqNullSafe(F.col(f"l.{name}")) for name in ("_series", "_node")]
    return queries.alias("q").join(large.alias("l"), same, how)


def _sorted(rows: pa.Table) -> tuple[np.ndarray, ...]:
    steps = rows.column("_step").to_numpy()
    order = np.argsort(steps, kind="stable")
    return steps[order], rows.column("_n").to_numpy()[order], order


def _searched(rows: DataFrame, queries: DataFrame | None, width: int, q: float, series_type: str) -> DataFrame:
    """Answers of whole groups: for every step of a series, or for the queries that came down to a node."""

    def out(series: pa.Array, pieces: list[tuple]) -> pa.Table:
        at, side, value, samples = (np.concatenate(part) if part else np.empty(0) for part in (zip(*pieces) if pieces else ((),) * 4))
        return pa.table({
            "_series": pa.repeat(series, len(at)), "_at": pa.array(at, pa.int64()),
            "_side": pa.array(side, pa.int32(), from_pandas=True) if len(side) else pa.array([], pa.int32()),
            "_quantile": pa.array(value, pa.float64()), "samples": pa.array(samples, pa.int64()),
        })

    def whole(table: pa.Table) -> pa.Table:
        steps, weights, order = _sorted(table)
        wavelet = Wavelet(table.column("_value").to_numpy()[order], weights)
        pieces = []
        for at, samples, low, high, position in _all_queries(steps, weights, width, q):
            begin, end = _ranges(steps, at, width)
            lower = wavelet.select(begin, end, low)
            upper = wavelet.select(begin, end, high)
            exact = (lower == upper) | (low == high)
            value = np.where(exact, lower, (high - position) * lower + (position - low) * upper)
            pieces.append((at, np.full(len(at), np.nan), value, samples))
        return out(table.column("_series")[0], pieces)

    def asked(table: pa.Table, queries: pa.Table) -> pa.Table:
        if not table.num_rows or not queries.num_rows:
            return out(pa.scalar(None, queries.schema.field("_series").type), [])
        steps, weights, order = _sorted(table)
        wavelet = Wavelet(table.column("_value").to_numpy()[order], weights)
        at = queries.column("_at").to_numpy()
        begin, end = _ranges(steps, at, width)
        value = wavelet.select(begin, end, queries.column("_rank").to_numpy())
        return out(table.column("_series")[0], [(at, queries.column("_side").to_numpy().astype(float), value, queries.column("samples").to_numpy())])

    if queries is None:
        return rows.groupBy("_series", "_node").applyInArrow(whole, _kinds(series_type))
    grouped = rows.groupBy("_series", "_node").cogroup(queries.groupBy("_series", "_node"))
    return grouped.applyInArrow(asked, _kinds(series_type))


def _descended(by_step: DataFrame, queries: DataFrame | None, width: int, q: float, series_type: str) -> DataFrame:
    """Queries of divided nodes as queries of the ranges of values below them: _node, _at, _side, _rank, samples."""
    schema = f"_series {series_type}, _node bigint, _at bigint, _side int, _rank bigint, samples bigint"

    def table_of(series: pa.Array, pieces: list[tuple]) -> pa.Table:
        node, at, side, rank, samples = (np.concatenate(part) for part in zip(*pieces)) if pieces else (np.empty(0, np.int64),) * 5
        return pa.table({
            "_series": pa.repeat(series, len(at)), "_node": pa.array(node, pa.int64()), "_at": pa.array(at, pa.int64()),
            "_side": pa.array(side, pa.int32()), "_rank": pa.array(rank, pa.int64()), "samples": pa.array(samples, pa.int64()),
        })

    class Histogram:
        def __init__(self, table: pa.Table):
            steps = table.column("_step").to_numpy()
            self.nodes, bucket = np.unique(table.column("_below").to_numpy(), return_inverse=True)
            self.steps, place = np.unique(steps, return_inverse=True)
            dense = np.zeros((len(self.steps) + 1, len(self.nodes)), np.int64)
            np.add.at(dense, (place + 1, bucket), table.column("_n").to_numpy())
            self.until = np.cumsum(dense, axis=0)

        def down(self, at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            begin, end = _ranges(self.steps, at, width)
            node, left = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
            for first in range(0, len(at), 1 << 14):
                tile = slice(first, first + (1 << 14))
                upto = np.cumsum(self.until[end[tile]] - self.until[begin[tile]], axis=1)
                bucket = (upto <= rank[tile, None]).sum(1)
                before = np.concatenate((np.zeros((len(upto), 1), np.int64), upto), axis=1)
                node[tile] = self.nodes[bucket]
                left[tile] = rank[tile] - before[np.arange(len(upto)), bucket]
            return node, left

    def every(table: pa.Table) -> pa.Table:
        histogram = Histogram(table)
        totals = np.diff(histogram.until.sum(1))
        pieces = []
        for at, samples, low, high, _ in _all_queries(histogram.steps, totals, width, q):
            for side, rank in ((_LOWER, low), (_UPPER, high)):
                node, left = histogram.down(at, rank)
                pieces.append((node, at, np.full(len(at), side), left, samples))
        return table_of(table.column("_series")[0], pieces)

    def some(table: pa.Table, queries: pa.Table) -> pa.Table:
        if not table.num_rows or not queries.num_rows:
            return table_of(pa.scalar(None, queries.schema.field("_series").type), [])
        at, side, rank, samples = (queries.column(name).to_numpy() for name in ("_at", "_side", "_rank", "samples"))
        node, left = Histogram(table).down(at, rank)
        return table_of(table.column("_series")[0], [(node, at, side, left, samples)])

    if queries is None:
        return by_step.groupBy("_series", "_node").applyInArrow(every, schema)
    return by_step.groupBy("_series", "_node").cogroup(queries.groupBy("_series", "_node")).applyInArrow(some, schema)
