"""Star schema: customer dimension, order fact, and the revenue joins over them."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"
TOTAL = "decimal(38,2)"

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def customer_dimension(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def order_fact(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per order with lines: exact revenue and line count.

    Lines are summed per order before the join. A hot order collapses on the map side, and the
    join reuses the partitioning of that sum. Order keys are unique by contract.
    """
    lines = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("revenue"),
        F.count(F.lit(1)).alias("line_count"),
    )
    return orders.select("o_orderkey", "o_custkey", "o_orderdate").join(lines, "o_orderkey")


def _fact_per_customer(fact: DataFrame) -> DataFrame:
    """A customer with very many orders becomes one row before it meets the dimension."""
    return fact.groupBy("o_custkey").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("line_count").alias("line_count"),
        F.count(F.lit(1)).alias("order_count"),
    )


def segment_revenue(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    """Revenue, lines and orders per market segment."""
    joined = _fact_per_customer(fact).join(
        dimension.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.groupBy(F.col("c_mktsegment").alias("market_segment")).agg(
        F.sum("revenue").cast(TOTAL).alias("total_revenue"),
        F.sum("line_count").cast("long").alias("line_count"),
        F.sum("order_count").cast("long").alias("order_count"),
    )


def source_totals(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    """One row: orders, revenue and lines of the fact, and orders without a customer."""
    joined = _fact_per_customer(fact).join(
        dimension.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    unmatched = F.sum(F.when(F.col("c_custkey").isNull(), F.col("order_count")).otherwise(F.lit(0)))
    return joined.agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).cast("long").alias("fact_order_count"),
        F.sum("revenue").cast(TOTAL).alias("fact_revenue"),
        F.sum("line_count").cast("long").alias("fact_line_count"),
        F.coalesce(unmatched, F.lit(0)).cast("long").alias("unmatched_orders"),
    )


def measured_bytes(frame: DataFrame) -> int:
    """Exact payload bytes of a flat frame, measured by one aggregate over its columns."""
    fixed = 8 * sum(1 for _, kind in frame.dtypes if kind not in ("string", "binary"))
    variable: list[Column] = [F.octet_length(name) for name, kind in frame.dtypes if kind in ("string", "binary")]
    row_bytes = F.lit(fixed)
    for size in variable:
        row_bytes = row_bytes + F.coalesce(size, F.lit(0)) + F.lit(8)
    return frame.agg(F.coalesce(F.sum(row_bytes.cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_small(frame: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> tuple[DataFrame, bool]:
    """The frame hinted for broadcast when its measured size is within the limit, else unchanged."""
    small = measured_bytes(frame) <= limit_bytes
    return (F.broadcast(frame), True) if small else (frame, False)


def plan_text(frame: DataFrame, mode: str = "formatted") -> str:
    """The plan as ``explain`` prints it, to report which join was chosen."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        frame.explain(mode)
    return printed.getvalue()


def segment_orders(orders: DataFrame, customer: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Order value and count per segment, joined by broadcast when the dimension fits.

    Beyond the limit the orders are summed per customer first, so the shuffled join sees one row
    per customer on both sides.
    """
    dimension, small = broadcast_if_small(customer.select("c_custkey", "c_mktsegment"), limit_bytes)
    facts = orders.select("o_custkey", F.col("o_totalprice").cast(MONEY).alias("price"))
    if small:
        priced = facts.withColumn("orders", F.lit(1))
    else:
        priced = facts.groupBy("o_custkey").agg(F.sum("price").alias("price"), F.count(F.lit(1)).alias("orders"))
    joined = priced.join(dimension, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(
        F.sum("price").cast(TOTAL).alias("total_price"), F.sum("orders").cast("long").alias("order_count")
    )
