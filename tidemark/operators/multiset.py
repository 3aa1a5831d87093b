"""Order-independent comparison of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import portable_hash

# Salts of the two row hashes.
FINGERPRINT_SALTS = ("nyc-quality-a", "nyc-quality-b")
FINGERPRINT_NAMES = ["row_count", "sum_a", "xor_a", "sum_b", "xor_b"]


def multiset_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows whose number of copies differs; ``surplus`` is copies in actual minus copies in expected.

    One pass: both sides are stacked with weights and summed per distinct row, so copies collapse
    before the shuffle and each input is read once.
    """
    names = expected.columns
    stacked = expected.select(*names, F.lit(-1).alias("_weight")).unionByName(
        actual.select(*names, F.lit(1).alias("_weight"))
    )
    summed = stacked.groupBy(*names).agg(F.sum("_weight").alias("surplus"))
    return summed.where(F.col("surplus") != 0)


def multiset_report(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: copies missing from actual, copies extra in it, and whether both are equal."""
    difference = multiset_difference(expected, actual)
    return difference.agg(
        F.coalesce(F.sum(F.when(F.col("surplus") < 0, -F.col("surplus"))), F.lit(0)).alias("missing_rows"),
        F.coalesce(F.sum(F.when(F.col("surplus") > 0, F.col("surplus"))), F.lit(0)).alias("extra_rows"),
        (F.count(F.lit(1)) == 0).alias("equal"),
    )


def same_rows(expected: DataFrame, actual: DataFrame) -> bool:
    return multiset_difference(expected, actual).isEmpty()


def _hash_sums(hashes: Sequence[Column]) -> list[Column]:
    """Count, and sum and xor of each hash; sums are decimals, so they cannot overflow."""
    columns = [F.count(F.lit(1)).alias("row_count")]
    for value, suffix in zip(hashes, "ab", strict=True):
        total = F.sum(value.cast("decimal(19,0)")).cast("decimal(38,0)")
        columns.append(F.coalesce(total, F.lit(0).cast("decimal(38,0)")).alias(f"sum_{suffix}"))
        columns.append(F.coalesce(F.bit_xor(value), F.lit(0).cast("long")).alias(f"xor_{suffix}"))
    return columns


def fingerprint_columns(names: Sequence[str], salts: Sequence[str] = FINGERPRINT_SALTS) -> list[Column]:
    """Aggregates that fingerprint the named columns; usable in ``agg``, per group and in ``observe``."""
    return _hash_sums([F.xxhash64(F.lit(salt), *[F.col(name) for name in names]) for salt in salts])


def fingerprint(frame: DataFrame, salts: Sequence[str] = FINGERPRINT_SALTS) -> DataFrame:
    """One row: count, and sum and xor of two salted 64-bit row hashes over all columns."""
    return frame.agg(*fingerprint_columns(frame.columns, salts))


def portable_fingerprint(frame: DataFrame, salts: Sequence[str] = FINGERPRINT_SALTS) -> DataFrame:
    """As ``fingerprint`` with sha256-based row hashes over the columns' text, comparable across engines."""
    columns = [F.col(name) for name in frame.columns]
    hashed = frame.select([portable_hash(F.lit(salt), *columns).alias(f"_hash_{salt}") for salt in salts])
    return hashed.agg(*_hash_sums([F.col(f"`{name}`") for name in hashed.columns]))


def table_snapshot(frame: DataFrame, portable: bool = False) -> DataFrame:
    """One row: sorted schema text, row count and fingerprint; ``portable`` as in ``portable_fingerprint``."""
    schema_text = ",".join(sorted(f"{field.name}:{field.dataType.simpleString()}" for field in frame.schema.fields))
    print_of = portable_fingerprint if portable else fingerprint
    return print_of(frame).select(F.lit(schema_text).alias("schema_text"), "*")


def partition_report(source: DataFrame, clean: DataFrame, quarantine: DataFrame, valid: Column) -> DataFrame:
    """Proof that clean and quarantine split the source: check rows, zero violations when it holds."""
    names = source.columns
    parts = clean.select(*names, F.lit(1).alias("_part")).unionByName(
        quarantine.select(*names, F.lit(2).alias("_part"))
    )
    stacked = source.select(*names, F.lit(0).alias("_part")).unionByName(parts)
    per_row = stacked.groupBy(*names).agg(
        F.count_if(F.col("_part") == 0).alias("in_source"),
        F.count_if(F.col("_part") == 1).alias("in_clean"),
        F.count_if(F.col("_part") == 2).alias("in_quarantine"),
    )
    covered = F.col("in_clean") + F.col("in_quarantine")
    totals = per_row.agg(
        F.sum(F.when(valid, F.lit(0)).otherwise(F.col("in_clean"))).alias("clean_holds_invalid"),
        F.sum(F.when(valid, F.col("in_quarantine")).otherwise(F.lit(0))).alias("quarantine_holds_valid"),
        F.sum(F.greatest(F.col("in_source") - covered, F.lit(0))).alias("rows_omitted"),
        F.sum(F.greatest(covered - F.col("in_source"), F.lit(0))).alias("rows_added"),
    )
    return check_rows(totals)


def check_rows(totals: DataFrame) -> DataFrame:
    """Turn one row of violation counts into rows (check, violations, status)."""
    entries = [
        F.struct(F.lit(name).alias("check"), F.coalesce(F.col(f"`{name}`"), F.lit(0)).cast("long").alias("violations"))
        for name in totals.columns
    ]
    return totals.select(F.inline(F.array(*entries))).withColumn(
        "status", F.when(F.col("violations") == 0, "pass").otherwise("fail")
    )
