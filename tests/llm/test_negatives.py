"""Hard negatives against their SQL over all pairs, on odd rows and with small leaves, blocks and samples."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"
LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def clusters(seed=1, count=900, width=6):
    """Points around few centres, a third of them copies of one, and every odd row."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, width)) * 2
    points = centres[rng.integers(8, size=count)] + rng.normal(size=(count, width)) * 0.15
    points[: count // 3] = points[0]
    points[5] = -points[6]
    rows = [(at, points[at].astype(np.float32).tolist(), int(rng.integers(4))) for at in range(count)]
    rows += [(50, points[600].tolist(), 1), (50, points[600].tolist(), 1), (350, points[601].tolist(), 2)]
    rows += [(None, points[7].tolist(), 1), (None, points[8].tolist(), None), (5000, None, 1), (5050, [], 2), (5001, [], 1)]
    rows += [(5100, [1.0, float("nan")] + [0.0] * 4, 1), (5150, [float("inf")] * width, 1), (5200, [None, 1.0], 1)]
    rows += [(5250, [0.5, -0.5], 3), (5300, [0.0] * width, 0), (5301, [0.0] * width, 0), (5350, points[9].tolist(), 77)]
    return rows


def by_sql(rows):
    kinds = [pa.int64(), pa.list_(pa.float32()), pa.int32()]
    columns = list(zip(*rows, strict=True)) or [[]] * 3
    embeddings = pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["vec_id", "embedding", "label"]
    )
    with duckdb.connect() as connection:
        connection.register("embeddings", embeddings)
        result = connection.execute(negatives.oracle_sql())
        return [column[0] for column in result.description], result.fetchall()


@pytest.mark.parametrize(
    "sizes",
    [{}, {"leaf_rows": 8, "block_rows": 40, "sample_rows": 300}, {"leaf_rows": 4, "block_rows": 7, "sample_rows": 12}],
)
def test_negatives_are_those_of_the_sql(spark, rows, sizes):
    given = clusters()
    frame = spark.createDataFrame(given, SCHEMA).selectExpr("*", "1 AS row", "2 AS leaf", "3 AS vector", "4 AS positive")
    found = negatives.mine_hard_negatives(spark, frame.repartition(3), F.col("vec_id") % 50 == 0, F.expr(LABEL), **sizes)
    names, expected = by_sql(given)
    assert len(expected) > 100
    assert rows(found, *names) == sorted(expected, key=lambda row: tuple((value is not None, str(value)) for value in row))


def test_without_rows_or_anchors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.mine_hard_negatives(spark, empty, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(1, [0.5, 0.5], 1), (2, [0.5, 0.4], 2)], SCHEMA)
    assert negatives.mine_hard_negatives(spark, one, F.col("vec_id") % 50 == 0).count() == 0
    assert negatives.mine_hard_negatives(spark, one, F.col("vec_id") == 1).count() == 0


def tree_of(points, levels=2, arity=4):
    tree = negatives.Tree.plant(points, levels, arity)
    for node, places, distance, nearest in tree.walk(points):
        for at in np.unique(nearest):
            own = distance[nearest == at]
            tree.low[node][:, at], tree.high[node][:, at] = np.sqrt(own.min(0)), np.sqrt(own.max(0))
            norm = (points[places[nearest == at]] ** 2).sum(1)
            tree.norms[node][at] = norm.min(), norm.max()
            if (child := tree.children[node][at]) < 0:
                tree.rows[~child] = len(own)
    return tree


def test_a_leaf_goes_only_if_no_row_of_it_is_in_a_window():
    rng = np.random.default_rng(3)
    centres = rng.integers(-400, 400, size=(12, 5))
    points = (centres[rng.integers(12, size=500)] + rng.integers(-9, 9, size=(500, 5))).astype(np.float64)
    tree = tree_of(points)
    leaf = tree.leaves_of(points)
    anchors = points[:60]
    scores = negatives.products(anchors, points)
    low = np.column_stack([np.quantile(scores, 0.97, 1), np.quantile(scores, 0.6, 1), np.full(60, 1)])
    high = np.column_stack([np.full(60, np.inf), np.quantile(scores, 0.62, 1), np.full(60, 0)])
    open_leaf = tree.reach(anchors, low, high)
    inside = ((scores[:, :, None] >= low[:, None]) & (scores[:, :, None] <= high[:, None])).any(2)
    for anchor in range(60):
        assert open_leaf[anchor, np.unique(leaf[inside[anchor]])].all()
    assert open_leaf.mean() < 0.8  # siblings are eliminated
    assert not tree.reach(anchors, low[:, 2:], high[:, 2:]).any()


def test_products_are_whole_at_every_size():
    big = np.array([[negatives.LIMIT, -negatives.LIMIT, 3]], np.float64)
    assert negatives.products(big, big)[0, 0] == 2 * negatives.LIMIT**2 + 9
    assert negatives.products(np.array([[3.0]]), np.array([[-5.0]]))[0, 0] == -15
