"""Hard negatives by exact window searches in a multiway hyperplane tree with distance ranges between siblings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

#: Rows the split points are chosen from (about; by a hash of the row), and the bound on their components.
SAMPLE_ROWS, SAMPLE_CELLS = 4096, 1 << 22
#: Split points of a node; rows that a leaf is meant to have.
ARITY, LEAF_ROWS = 16, 8192
#: Rows of a leaf, or anchors, that meet in one group at most (about), and its components.
BLOCK_ROWS, BLOCK_CELLS = 8192, 1 << 21
#: Quantised components are held in this range, so that products stay whole numbers.
LIMIT = 1 << 20


def quantised(embeddings: DataFrame, label: Column) -> DataFrame:
    """vec_id, label and vector (floor(256 * component)) of the rows that take part.

    Rows with a null label, a null vector or a component that is null or not finite do not. Components beyond
    ``LIMIT`` in size are taken as ``LIMIT``.
    """
    doubles = F.col("embedding").cast("array<double>")
    whole = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    cell = F.transform(
        doubles, lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x * 256.0))).cast("int")
    )
    return (
        embeddings.select("vec_id", label.cast("long").alias("label"), "embedding")
        .filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
        .select("vec_id", "label", cell.alias("vector"))
    )


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as the rows of a matrix; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(column), width).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in the narrowest floats that hold every partial sum."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    bound = float(np.abs(left).max()) * float(np.abs(right).max()) * left.shape[1]
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return (left.astype(kind) @ right.astype(kind).T).astype(np.int64)


def squares(points: np.ndarray, splits: np.ndarray) -> np.ndarray:
    """Squared distances of points from split points."""
    own = (points * points).sum(1)[:, None] + (splits * splits).sum(1)[None, :]
    return np.maximum(own - 2.0 * products(points, splits), 0)


def spread(points: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different points far from each other: each next one is the farthest from those chosen."""
    chosen = [int((points * points).sum(1).argmax())]
    nearest = squares(points, points[chosen])[:, 0]
    while len(chosen) < count and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squares(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


@dataclass
class Tree:
    """Nodes of split points. ``children`` holds the node below a split point, or ``~leaf``.

    ``low[node][i, j]`` and ``high[node][i, j]`` bound the distance of split point i from every row below split
    point j, ``norms[node]`` the squared norms of the rows below each, ``rows`` counts the rows of each leaf.
    """

    splits: list[np.ndarray]
    children: list[list[int]]
    low: list[np.ndarray]
    high: list[np.ndarray]
    norms: list[np.ndarray]
    rows: np.ndarray

    @classmethod
    def plant(cls, sample: np.ndarray, levels: int, arity: int = ARITY) -> Tree:
        tree = cls([], [], [], [], [], np.zeros(0, np.int64))
        leaves = 0

        def grow(points: np.ndarray, level: int) -> int:
            nonlocal leaves
            if level == 0 or len(points) < 2:
                leaves += 1
                return ~(leaves - 1)
            node = len(tree.splits)
            splits = spread(points, arity)
            tree.splits.append(splits)
            tree.children.append([])
            nearest = squares(points, splits).argmin(1)
            for at in range(len(splits)):
                tree.children[node].append(grow(points[nearest == at], level - 1))
            return node

        if grow(sample, max(1, levels)) < 0:  # no two points: one split point, so that there is a root
            tree.splits.append(sample[:1] if len(sample) else np.zeros((1, sample.shape[1])))
            tree.children.append([~0])
        tree.rows = np.zeros(leaves, np.int64)
        for splits in tree.splits:
            size = len(splits)
            tree.low.append(np.full((size, size), np.inf))
            tree.high.append(np.full((size, size), -np.inf))
            tree.norms.append(np.array([[np.inf, -np.inf]] * size))
        return tree

    def walk(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(node, places of the points that come by it, their squared distances, their nearest split point)."""
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, places = stack.pop()
            if not len(places):
                continue
            distance = squares(points[places], self.splits[node])
            nearest = distance.argmin(1)
            yield node, places, distance, nearest
            stack += [
                (child, places[nearest == at]) for at, child in enumerate(self.children[node]) if child >= 0
            ]

    def leaves_of(self, points: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(points), np.int64)
        for node, places, _, nearest in self.walk(points):
            child = np.array(self.children[node])[nearest]
            leaf[places[child < 0]] = ~child[child < 0]
        return leaf

    def reach(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which leaves (columns) may hold a row whose product with an anchor (row) is in one of its windows.

        ``low`` and ``high`` have one column for each window, empty ones with low above high. A window of
        products is an annulus of distances around the anchor; a sibling goes if the annulus does not
        meet the distances that the ranges of the split points allow to its rows.
        """
        open_leaf = np.zeros((len(anchors), len(self.rows)), bool)
        norm = (anchors * anchors).sum(1)
        stack = [(0, np.arange(len(anchors)))]
        while stack:
            node, places = stack.pop()
            if not len(places):
                continue
            distance = np.sqrt(squares(anchors[places], self.splits[node]))[:, :, None]
            slack = 1e-6 * (1 + distance.max(initial=0.0))
            nearest = np.maximum(distance - self.high[node], self.low[node] - distance).max(1).clip(min=0) - slack
            farthest = (distance + self.high[node]).min(1) + slack
            for at, child in enumerate(self.children[node]):
                least, most = self.norms[node][at]
                if least > most:  # no row is below
                    continue
                with np.errstate(invalid="ignore"):
                    inner = np.sqrt(np.maximum(norm[places, None] + least - 2 * high[places], 0))
                    outer = norm[places, None] + most - 2 * low[places]
                meets = (low[places] <= high[places]) & (outer >= 0)
                meets &= (np.sqrt(np.maximum(outer, 0)) + slack >= nearest[:, at, None]) & (inner - slack <= farthest[:, at, None])
                into = places[meets.any(1)]
                if child < 0:
                    open_leaf[into, ~child] = True
                else:
                    stack.append((child, into))
        return open_leaf


def best(scores: np.ndarray, allowed: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, place) of the ``count`` highest allowed scores of each row; equal ones in column order."""
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    kept = place < count
    return row[kept], column[kept], place[kept]


def last_best(scores: np.ndarray, allowed: np.ndarray, count: int, otherwise: np.ndarray) -> np.ndarray:
    """The ``count``-th highest allowed score of each row: a bound that the true one cannot be below."""
    row, column, place = best(scores, allowed, count)
    out = otherwise.astype(np.float64)
    full = place == count - 1
    out[row[full]] = np.maximum(out[row[full]], scores[row[full], column[full]])
    return out


def windows_of(positive_scores: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores s with least * p <= 100 * s <= most * p, for each p; low above high where there are none."""
    return -((-least * positive_scores) // 100), (most * positive_scores) // 100


def _tiles(count: int, width: int) -> Iterator[slice]:
    step = max(1, (1 << 22) // max(1, width))
    return (slice(at, at + step) for at in range(0, count, step))


_NOWHERE = np.iinfo(np.int64).max


class _Sample:
    """Rows known everywhere, from which every task derives bounds: they are real rows, so the bounds hold."""

    def __init__(self, rows: pa.Table, width: int):
        self.points = matrix(rows.column("vector"), width).astype(np.int32)
        self.labels = rows.column("label").to_numpy()
        self.row = rows.column("row").to_numpy()


def mine_hard_negatives(
    spark: SparkSession,
    embeddings: DataFrame,
    anchors: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    leaf_rows: int = LEAF_ROWS,
    block_rows: int = BLOCK_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``embeddings`` has vec_id, embedding and label; other columns are ignored. A score is the integer inner product
    of two quantised vectors; higher ones come first, equal ones by vec_id, nulls last. Each row for which
    ``anchors`` holds has its ``positives`` best other rows of its label (all, if fewer); for each, the ``negatives``
    best rows of other labels are returned whose score is between the two percentages of ``window`` of the positive's.

    Rows without a label or a whole vector take no part; a shorter vector ends in zeros, an empty one scores 0.
    Repeated rows are rows of their own: each is an anchor, and a copy is an "other row". A null vec_id is no
    anchor, but may be found. No rows give no rows.

    The split points come from about ``sample_rows`` rows chosen by hash. Every row is routed to the leaf of its
    nearest split points, and the distance ranges between split points and sibling subtrees are aggregated over all
    rows. An anchor's own best scores among the sampled rows bound its window; it is sent to
    the leaves that its annulus meets, split into blocks of bounded rows, and scanned there exactly. Anchors are
    blocks too, so no task holds more than two blocks, and a leaf full of copies is many blocks.
    """
    scratch = Scratch(spark, "negatives")
    own = quantised(embeddings, F.col("label") if label is None else label)
    is_anchor = F.coalesce(anchors, F.lit(False))
    vectors = scratch.write(
        own.select("*", is_anchor.alias("is_anchor")).withColumn("row", F.monotonically_increasing_id())
    )
    size = vectors.agg(F.count("*"), F.max(F.size("vector")), F.count_if("is_anchor")).first()
    count, width, n_anchors = size[0], max(1, size[1] or 0), size[2]
    least_sample = max(1, min(sample_rows, SAMPLE_CELLS // width))
    share = 1.0 if count <= least_sample else least_sample / count
    chosen = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30)) if share < 1 else F.lit(True)
    sample = _Sample(vectors.filter(chosen).select("row", "label", "vector").toArrow(), width)
    levels = 1
    while leaf_rows * ARITY**levels < count and ARITY**levels < least_sample:
        levels += 1
    tree = Tree.plant(sample.points.astype(np.float64), levels)
    routed = scratch.write(_routed(vectors, tree, width))
    _measure(routed, tree, width)
    block = max(1, min(block_rows, BLOCK_CELLS // width))
    parts = np.maximum(1, -(-tree.rows // block))
    blocks = spark.createDataFrame([(at, int(n)) for at, n in enumerate(parts)], "leaf int, parts int")
    anchor_blocks = max(1, -(-n_anchors // block))
    dealt = (
        routed.join(F.broadcast(blocks), "leaf")  # one row a leaf, and the leaves are bounded by the sample
        .withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
        .withColumn("anchor_block", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))
        .select("leaf", "part", "anchor_block", "row", "vec_id", "label", "vector")
    )
    known = spark.sparkContext.broadcast((tree, sample, parts, anchor_blocks, width))
    rank = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    wanted = vectors.filter("is_anchor").select("row", "vec_id", "label", "vector")
    found = _scan(dealt, _sent(wanted, known, positives, None), width, positives, None)
    best_positives = scratch.write(
        found.withColumn("place", F.row_number().over(rank)).filter(F.col("place") <= positives)
    )
    ordered = F.sort_array(F.collect_list(F.struct("place", F.col("vec_id").alias("id"), "score")))
    by_anchor = best_positives.groupBy("anchor").agg(ordered.alias("positives"))
    asked = scratch.write(
        wanted.join(by_anchor, wanted["row"] == by_anchor["anchor"]).select(
            "row", "vec_id", "label", "vector", F.col("positives.score").alias("scores"), "positives"
        )
    )
    sent = _sent(asked.select("row", "label", "vector", "scores"), known, negatives, window)
    near = _scan(dealt, sent, width, negatives, window)
    rank = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    mined = near.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= negatives)
    one = F.col("positives")[F.col("positive")]
    result = mined.join(
        asked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "positives"), "anchor"
    ).select(
        "anchor_id",
        one["id"].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        one["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
    written = scratch.write(result)
    known.unpersist()
    return written


def _routed(vectors: DataFrame, tree: Tree, width: int) -> DataFrame:
    """The rows with their leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaves_of(matrix(batch.column("vector"), width)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    return vectors.select("row", "vec_id", "label", "vector").mapInArrow(
        run, "row bigint, vec_id bigint, label bigint, vector array<int>, leaf int"
    )


def _measure(routed: DataFrame, tree: Tree, width: int) -> None:
    """Fill in the distance ranges, norms and row counts over all rows; one small partial result a task."""
    schema = pa.schema([
        ("node", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("low", pa.float64()), ("high", pa.float64()),
        ("least", pa.float64()), ("most", pa.float64()), ("leaf", pa.int32()), ("n", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            points = matrix(batch.column("vector"), width)
            norm = (points * points).sum(1)
            for node, places, distance, nearest in tree.walk(points):
                for j in np.unique(nearest):
                    below = nearest == j
                    own = norm[places[below]]
                    low, high = distance[below].min(0), distance[below].max(0)
                    child = tree.children[node][j]
                    for i in range(distance.shape[1]):
                        now = [low[i], high[i], own.min(), own.max(), ~child if child < 0 else -1, int(below.sum())]
                        old = seen.get((node, i, int(j)))
                        if old is not None:
                            now = [min(old[0], now[0]), max(old[1], now[1]), min(old[2], now[2]), max(old[3], now[3]), now[4], old[5] + now[5]]
                        seen[node, i, int(j)] = now
        if seen:
            columns = zip(*((*key, *value) for key, value in seen.items()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    partial = routed.mapInArrow(
        run, "node int, i int, j int, low double, high double, least double, most double, leaf int, n bigint"
    )
    total = partial.groupBy("node", "i", "j").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.max("leaf").alias("leaf"), F.sum("n").alias("n"),
    )
    for one in total.toArrow().to_pylist():
        node, i, j = one["node"], one["i"], one["j"]
        tree.low[node][i, j], tree.high[node][i, j] = np.sqrt(one["low"]), np.sqrt(one["high"])
        tree.norms[node][j] = one["least"], one["most"]
        if one["leaf"] >= 0:
            tree.rows[one["leaf"]] = one["n"]


def _sent(anchors: DataFrame, known, count: int, window: tuple[int, int] | None) -> DataFrame:
    """Each anchor once for every block of every leaf that its windows meet, with the windows.

    The sampled rows raise the lower end of a window to their own ``count``-th best in it.
    """
    schema = pa.schema([
        ("leaf", pa.int32()), ("part", pa.int32()), ("anchor_block", pa.int32()), ("row", pa.int64()), ("label", pa.int64()),
        ("vector", pa.list_(pa.int32())), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, sample, parts, anchor_blocks, width = known.value
        for whole in batches:
            for tile in _tiles(whole.num_rows, max(len(sample.row), 256)):
                batch = whole.slice(tile.start, tile.stop - tile.start)
                points = matrix(batch.column("vector"), width)
                label = batch.column("label").to_numpy()
                row = batch.column("row").to_numpy()
                scores = products(points, sample.points)
                same = label[:, None] == sample.labels[None, :]
                if window is None:
                    lowest = np.full(len(row), -np.inf)
                    low = last_best(scores, same & (row[:, None] != sample.row[None, :]), count, lowest)[:, None]
                    high = np.full_like(low, np.inf)
                    finite = np.where(np.isfinite(low), low, -_NOWHERE).astype(np.int64)
                    ends = (finite, np.full_like(finite, _NOWHERE))
                else:
                    lists = batch.column("scores").to_pylist()
                    most = max((len(one) for one in lists), default=0)
                    ends = (np.full((len(row), most), 1, np.int64), np.zeros((len(row), most), np.int64))
                    for at, one in enumerate(lists):
                        ends[0][at, : len(one)], ends[1][at, : len(one)] = windows_of(np.array(one, np.int64), *window)
                    for k in range(most):
                        inside = ~same & (scores >= ends[0][:, k, None]) & (scores <= ends[1][:, k, None])
                        ends[0][:, k] = last_best(scores, inside, count, ends[0][:, k])
                    low, high = (end.astype(np.float64) for end in ends)
                at, leaf = np.nonzero(tree.reach(points, low, high))
                repeat = parts[leaf]
                at, leaf = np.repeat(at, repeat), np.repeat(leaf, repeat)
                part = np.arange(len(at)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
                # a copy of a vector for each block: no more than a bounded piece of them at a time
                for piece in _tiles(len(at), width):
                    own = pa.array(at[piece])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(leaf[piece], pa.int32()), pa.array(part[piece], pa.int32()),
                        pa.array(row[at[piece]] % anchor_blocks, pa.int32()), batch.column("row").take(own),
                        batch.column("label").take(own), batch.column("vector").take(own),
                        *(_lists(end[at[piece]]) for end in ends),
                    ], schema=schema)

    return anchors.mapInArrow(
        run,
        "leaf int, part int, anchor_block int, row bigint, label bigint, vector array<int>, low array<bigint>, high array<bigint>",
    )


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def _scan(dealt: DataFrame, sent: DataFrame, width: int, count: int, window: tuple[int, int] | None) -> DataFrame:
    """The best rows of every block for the anchors sent to it: anchor, positive, row, vec_id, score.

    Without a window these are other rows of the anchor's label, with one rows of other labels, for each
    positive of the anchor.
    """
    schema = pa.schema([
        ("anchor", pa.int64()), ("positive", pa.int32()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
    ])

    def scan(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        parts: list[Sequence[np.ndarray]] = []
        if rows.num_rows and anchors.num_rows:
            order = [("vec_id", "ascending"), ("row", "ascending")]
            rows = rows.sort_by(order)  # nulls come last
            points, labels = matrix(rows.column("vector"), width), rows.column("label").to_numpy()
            row = rows.column("row").to_numpy()
            mine, own_row = anchors.column("label").to_numpy(), anchors.column("row").to_numpy()
            ends = [
                np.array(anchors.column(name).combine_chunks().flatten()).reshape(anchors.num_rows, -1) for name in ("low", "high")
            ]
            vectors = matrix(anchors.column("vector"), width)
            for tile in _tiles(anchors.num_rows, len(row)):
                scores = products(vectors[tile], points)
                same = mine[tile][:, None] == labels[None, :]
                if window is None:
                    allowed = same & (own_row[tile][:, None] != row[None, :])
                else:
                    allowed = ~same
                for k in range(ends[0].shape[1]):
                    low, high = (end[tile][:, k, None] for end in ends)
                    at, column, _ = best(scores, allowed & (scores >= low) & (scores <= high), count)
                    parts.append((own_row[tile][at], np.full(len(at), k), column, scores[at, column]))
        if not parts:
            return schema.empty_table()
        anchor, positive, column, score = (np.concatenate(one) for one in zip(*parts, strict=True))
        place = pa.array(column)
        return pa.table(
            [pa.array(anchor), pa.array(positive, pa.int32()), rows.column("row").take(place), rows.column("vec_id").take(place), pa.array(score)],
            schema=schema,
        )

    key = ("leaf", "part", "anchor_block")
    return (
        dealt.groupBy(*key)
        .cogroup(sent.groupBy(*key))
        .applyInArrow(scan, "anchor bigint, positive int, row bigint, vec_id bigint, score bigint")
    )


def oracle_sql(anchor_step: int = 50, positives: int = 5, negatives: int = 3) -> str:
    """DuckDB SQL of the same search over all pairs of anchors and rows."""
    return f"""
WITH whole AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
    list_transform(embedding, lambda x: greatest(-{LIMIT}, least({LIMIT}, floor(x::DOUBLE * 256)))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
flat AS (SELECT row, unnest(v) AS x, unnest(range(len(v))) AS dim FROM whole),
products AS (
  SELECT a.row AS anchor, r.row, sum(a.x * r.x) AS score
  FROM (SELECT flat.* FROM flat JOIN whole USING (row) WHERE vec_id % {anchor_step} = 0) a JOIN flat r USING (dim) GROUP BY ALL),
pairs AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, r.row, r.vec_id, a.label = r.label AS same, coalesce(score, 0)::BIGINT AS score
  FROM whole a JOIN whole r ON a.row <> r.row AND a.vec_id % {anchor_step} = 0
  LEFT JOIN products p ON p.anchor = a.row AND p.row = r.row),
best AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, row) <= {positives})
SELECT b.anchor_id, b.vec_id AS positive_id,
  row_number() OVER (PARTITION BY b.anchor, b.row ORDER BY n.score DESC, n.vec_id NULLS LAST, n.row)::INTEGER AS rank,
  n.vec_id AS negative_id, b.score AS positive_score, n.score AS negative_score
FROM best b JOIN pairs n ON n.anchor = b.anchor AND NOT n.same
  AND 50 * b.score <= 100 * n.score AND 100 * n.score <= 95 * b.score
QUALIFY row_number() OVER (PARTITION BY b.anchor, b.row ORDER BY n.score DESC, n.vec_id NULLS LAST, n.row) <= {negatives}"""
