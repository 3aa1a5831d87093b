"""Bounded result artifacts: ordered rows as canonical JSON with a digest, and their reconciliation."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import fixed_decimal_text, plain_decimal_text
from tidemark.operators.multiset import check_rows

# Bounds and columns of the two artifacts.
SEGMENT_COUNT = 5
SEGMENT_MAX_BYTES = 64 * 1024
DAILY_MAX_ROWS = 4000
DAILY_MAX_BYTES = 256 * 1024
SEGMENT_COLUMNS = [
    ("market_segment", "varchar"),
    ("total_revenue", "decimal(38,2)"),
    ("line_count", "bigint"),
    ("order_count", "bigint"),
]
DAILY_COLUMNS = [("trip_date", "date"), ("trip_count", "bigint"), ("avg_fare", "double")]


def json_text(value: Column) -> Column:
    """A JSON string literal."""
    encoded = F.to_json(F.array(value.cast("string")))
    return F.substring(encoded, F.lit(2), F.length(encoded) - 2)


def result_artifact(
    rows: DataFrame,
    columns: Sequence[tuple[str, str]],
    cells: Sequence[Column],
    order: str,
    max_rows: int,
    max_bytes: int,
) -> DataFrame:
    """One row: row_count, rows_json and the sha256 of the canonical result.

    The input is a report whose row and byte bounds are part of its contract. Both are measured first;
    an overflow fails the job whichever columns are read, and no row of it is gathered.
    """
    line = F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]"))
    lined = rows.select(F.col(order).cast("string").alias("_key"), line.alias("_line"))
    header = json.dumps([{"name": name, "type": kind} for name, kind in columns], separators=(",", ":"))
    begin, end = '{"columns":' + header + ',"rows":', "}"
    row_count = F.count(F.lit(1))
    # the brackets, and a comma between two lines
    size = F.coalesce(F.sum(F.octet_length("_line") + 1), F.lit(1)) + 1 + len((begin + end).encode())
    fits = lined.agg(((row_count <= max_rows) & (size <= max_bytes)).alias("fits")).scalar()
    packed = lined.where(fits).agg(F.sort_array(F.collect_list(F.struct("_key", "_line"))).alias("_rows"))
    body = F.concat(F.lit("["), F.concat_ws(",", F.col("_rows._line")), F.lit("]"))
    result = F.struct(
        F.size("_rows").cast("long").alias("row_count"),
        body.alias("rows_json"),
        F.sha2(F.concat(F.lit(begin), body, F.lit(end)), 256).alias("result_sha256"),
    )
    guarded = F.when(fits, result).otherwise(F.raise_error(F.lit("artifact exceeds its bound")))
    return packed.select(guarded.alias("_result")).select("_result.*")


def segment_artifact(segments: DataFrame) -> DataFrame:
    cells = [
        json_text(F.col("market_segment")),
        json_text(fixed_decimal_text(F.col("total_revenue"), 2)),
        F.col("line_count").cast("string"),
        F.col("order_count").cast("string"),
    ]
    return result_artifact(segments, SEGMENT_COLUMNS, cells, "market_segment", SEGMENT_COUNT, SEGMENT_MAX_BYTES)


def daily_artifact(days: DataFrame, day: str, count: str, mean: str) -> DataFrame:
    cells = [
        json_text(F.date_format(day, "yyyy-MM-dd")),
        F.col(count).cast("string"),
        json_text(plain_decimal_text(F.col(mean))),
    ]
    return result_artifact(days, DAILY_COLUMNS, cells, day, DAILY_MAX_ROWS, DAILY_MAX_BYTES)


def segment_reconciliation(segments: DataFrame, totals: DataFrame) -> DataFrame:
    """Segment rows against the totals of their source; every difference is a violation."""
    summed = segments.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("market_segment").alias("names"),
        F.count_if(F.col("line_count") < F.col("order_count")).alias("short"),
        F.count_if(~(F.col("total_revenue") > 0)).alias("unpaid"),
        F.sum("total_revenue").alias("revenue"),
        F.sum("line_count").alias("lines"),
        F.sum("order_count").alias("orders"),
    )
    one_row = totals.select(F.struct(*totals.columns).alias("t")).scalar()
    compared = summed.withColumn("t", one_row)
    return check_rows(
        compared.select(
            F.abs(F.col("n") - SEGMENT_COUNT).alias("segment_count"),
            (F.col("n") - F.col("names")).alias("segment_repeated"),
            F.col("short").alias("fewer_lines_than_orders"),
            F.col("unpaid").alias("revenue_not_positive"),
            (~F.col("revenue").eqNullSafe(F.col("t.fact_revenue"))).cast("long").alias("revenue_differs"),
            (~F.col("lines").eqNullSafe(F.col("t.fact_line_count"))).cast("long").alias("lines_differ"),
            (~F.col("orders").eqNullSafe(F.col("t.fact_order_count"))).cast("long").alias("orders_differ"),
            F.col("t.unmatched_orders").alias("unmatched_orders"),
        )
    )


def daily_reconciliation(days: DataFrame, day: str, count: str, source: DataFrame) -> DataFrame:
    """Daily rows against the source row count: totals, unique and non-null days, row bound."""
    summed = days.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(day).alias("days"),
        F.count_if(F.col(day).isNull()).alias("undated"),
        F.coalesce(F.sum(count), F.lit(0)).alias("rows"),
    )
    compared = summed.withColumn("source", source.agg(F.count(F.lit(1))).scalar())
    return check_rows(
        compared.select(
            F.abs(F.col("rows") - F.col("source")).alias("rows_differ"),
            (F.col("n") - F.col("days") - F.col("undated")).alias("day_repeated"),
            F.col("undated").alias("day_null"),
            F.greatest(F.col("n") - DAILY_MAX_ROWS, F.lit(0)).alias("over_row_bound"),
        )
    )
