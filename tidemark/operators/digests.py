"""Digests of row sets that need no global order and no single task holding all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_digest(
    frame: DataFrame, groups: Sequence[str], line: Column, name: str = "digest", hex_digits: int = 4
) -> DataFrame:
    """sha256 per group over the multiset of ``line`` texts, in two levels.

    Copies of a line become one entry with a count. The entries' hashes are spread by their first
    hex digits into 16^n buckets, each bucket is hashed over its sorted entries, and the group over
    its sorted buckets. Hash buckets split the largest group evenly: with four digits, ten billion
    lines make buckets of about 150,000 entries and a last step of at most 65,536.
    """
    counted = frame.groupBy(*groups, line.alias("_line")).agg(F.count(F.lit(1)).alias("_copies"))
    entry = F.sha2(F.concat_ws("\n", "_line", F.col("_copies").cast("string")), 256)
    hashed = counted.select(*groups, entry.alias("_entry")).withColumn("_bucket", F.substring("_entry", 1, hex_digits))
    buckets = hashed.groupBy(*groups, "_bucket").agg(
        F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("_entry"))), 256).alias("_bucket_digest")
    )
    part = F.concat_ws(":", "_bucket", "_bucket_digest")
    return buckets.groupBy(*groups).agg(
        F.sha2(F.concat_ws(",", F.sort_array(F.collect_list(part))), 256).alias(name)
    )
