"""Packing by optimal length buckets: exact dynamic programming over the global histogram of lengths."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, partitions_for, words_column

BUCKETS = 16
#: Tokens of a batch, padding included. A longer document is a batch of its own.
TOKEN_BUDGET = 32_768


def optimal_bounds(lengths: Sequence[int], counts: Sequence[int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most ``buckets`` length intervals with the least total padding.

    ``lengths`` are distinct and ascending. Every bound is a length that occurs; each document is padded
    to the bound of its interval. The recurrence is a lower envelope of lines (their slopes fall and the
    queries rise), so a layer takes one pass. Of equal totals the earlier cut wins.
    """
    size = len(lengths)
    if not size:
        return []
    buckets = min(buckets, size)
    rows, tokens = [0], [0]
    for length, count in zip(lengths, counts, strict=True):
        rows.append(rows[-1] + count)
        tokens.append(tokens[-1] + length * count)
    best = [lengths[j - 1] * rows[j] - tokens[j] if j else 0 for j in range(size + 1)]
    cuts = []
    for layer in range(2, buckets + 1):
        line: list[tuple[int, int, int]] = []  # slope, offset, cut
        head, now, cut = 0, list(best), [0] * (size + 1)
        for j in range(layer, size + 1):
            i = j - 1
            slope, offset = -rows[i], best[i] + tokens[i]
            while len(line) - head >= 2:
                (s1, o1, _), (s2, o2, _) = line[-2], line[-1]
                if (offset - o1) * (s1 - s2) < (o2 - o1) * (s1 - slope):
                    line.pop()
                else:
                    break
            line.append((slope, offset, i))
            x = lengths[j - 1]
            while len(line) - head >= 2 and line[head + 1][0] * x + line[head + 1][1] < line[head][0] * x + line[head][1]:
                head += 1
            value = line[head][0] * x + line[head][1] + x * rows[j] - tokens[j]
            now[j], cut[j] = value, line[head][2]
        best = now
        cuts.append(cut)
    bounds, j = [], size
    for cut in reversed(cuts):
        bounds.append(lengths[j - 1])
        j = cut[j]
    bounds.append(lengths[j - 1])
    return bounds[::-1]


def word_count(text: Column) -> Column:
    return F.size(words_column(text)).cast("long")


def pack(
    spark: SparkSession, lengths: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET
) -> DataFrame:
    """Every row of ``lengths`` (doc_id, n_tokens) with its bucket, batch and slot.

    Columns: doc_id, n_tokens, bucket, bucket_tokens (the padded length), batch (counted inside the
    bucket), slot (inside the batch), padding. A batch holds as many padded documents as the budget
    allows, one at least. Inside a bucket rows are taken by n_tokens and doc_id; rows that tie in both
    take any order. Null lengths count as 0 and null ids are kept. No rows give no rows.

    Rows are range-partitioned by length and id, so a length that a third of the rows share is split
    over tasks. The driver sees the histogram (a row for each distinct length) and the join side has a
    row for each task and bucket.
    """
    scratch = Scratch(spark, "packing")
    plain = scratch.write(
        lengths.select("doc_id", F.coalesce(F.col("n_tokens").cast("long"), F.lit(0).cast("long")).alias("n_tokens"))
    )
    histogram = plain.groupBy("n_tokens").count().orderBy("n_tokens").toArrow().to_pydict()
    bounds = optimal_bounds(histogram["n_tokens"], histogram["count"], buckets) or [0]
    number = reduce(
        lambda total, bound: total + (F.col("n_tokens") > bound).cast("int"), bounds[:-1], F.lit(0)
    )
    place = F.monotonically_increasing_id()
    placed = scratch.write(
        plain.withColumn("bucket", number)
        .repartitionByRange(partitions_for(spark), "n_tokens", "doc_id")
        .sortWithinPartitions("n_tokens", "doc_id")
        .withColumn("place", place)
        .withColumn("part", F.shiftright("place", 33))
    )
    scratch.drop(plain)
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("part", "bucket")
        .agg(F.min("place").alias("first_place"), F.count(F.lit(1)).alias("n"))
        .select("part", "bucket", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_place")).alias("shift"))
    )
    length = F.element_at(F.array(*[F.lit(bound).cast("long") for bound in bounds]), F.col("bucket") + 1)
    capacity = F.greatest(F.lit(1).cast("long"), F.expr(f"{token_budget}L div greatest(bucket_tokens, 1L)"))
    rank = F.col("place") + F.col("shift")
    return (
        placed.join(F.broadcast(offsets), ["part", "bucket"])
        .withColumn("bucket_tokens", length)
        .select("doc_id", "n_tokens", "bucket", "bucket_tokens", rank.alias("rank"), capacity.alias("capacity"))
        .selectExpr(
            "doc_id", "n_tokens", "bucket", "bucket_tokens", "rank div capacity AS batch", "rank % capacity AS slot",
            "bucket_tokens - n_tokens AS padding",
        )
    )
