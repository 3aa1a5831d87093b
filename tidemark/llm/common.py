"""What the operators of this subpackage share: scratch tables, word hashes, bounded bitmaps."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder

#: Bytes that separate words: space and the controls 09 to 0D. ``bytes.split()`` splits on the same.
SPACES = " \t\n\x0b\f\r"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


class Scratch:
    """Tables written between the steps of a job, in the folder that all executors share.

    A written table cuts the lineage: after a lost executor only the step at hand runs again.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.base = shared_folder(spark, purpose)
        self.count = 0

    def write(self, frame: DataFrame) -> DataFrame:
        path = f"{self.base}/{self.count}"
        self.count += 1
        frame.write.option("compression", "zstd").parquet(path)
        table = self.spark.read.schema(frame.schema).parquet(path)
        table._scratch_path = path
        return table

    def again(self, table: DataFrame) -> DataFrame:
        """The same table as a new frame, for a plan in which it meets itself."""
        return self.spark.read.schema(table.schema).parquet(table._scratch_path)

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that no later step reads."""
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions_for(spark: SparkSession) -> int:
    """Tasks of an exchange with a fixed count: the session's own setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of 1,000 rows, so a batch of long texts fits a worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` as often as needed."""
    return F.transform(F.array(value), body)[0]


def words_column(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null and blank texts give an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def crc_fold(column: str, modulus: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` modulo ``modulus``; false for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == fold, F.lit(False))


def mix(values: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


_powers = np.ones(1, np.uint64)


def powers(count: int) -> np.ndarray:
    """The first ``count`` powers of an odd constant modulo 2^64."""
    global _powers
    if len(_powers) < count:
        grown = np.full(max(count, 1024), _ODD, np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:count]


def hash_words(words: Sequence[bytes], slice_words: int = 200_000) -> np.ndarray:
    """A 64-bit hash of each word, vectorised over slices of the list."""
    out = []
    for begin in range(0, len(words), slice_words):
        part = words[begin : begin + slice_words]
        data = np.frombuffer(b" ".join(part) + b" ", np.uint8)
        ends = np.flatnonzero(data == 32)
        starts = np.concatenate(([0], ends[:-1] + 1))
        lengths = ends - starts + 1
        place = np.arange(len(data)) - np.repeat(starts, lengths)
        value = data.astype(np.uint64) * powers(int(lengths.max()))[place]
        out.append(mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def hash_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for step, power in enumerate(powers(width + 1)[1:]):
        total += hashes[step : step + count] * power
    return mix(total + np.uint64(width))


def word_groups(
    texts: Sequence[str | None], lower: bool = False, group_words: int = 200_000
) -> Iterator[tuple[range, list[bytes], np.ndarray, np.ndarray]]:
    """Texts in groups of about ``group_words`` words: (their places, words, word bounds, hashes)."""
    words: list[bytes] = []
    bounds, begin = [0], 0
    for place, text in enumerate(texts):
        data = (text or "").encode("utf-8")
        words.extend((data.lower() if lower else data).split())
        bounds.append(len(words))
        if len(words) >= group_words or place == len(texts) - 1:
            yield range(begin, place + 1), words, np.array(bounds), hash_words(words)
            words, bounds, begin = [], [0], place + 1


def bitmap_of(frame: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of 2^bits cells in which the low bits of every value are set.

    It is built by the cluster and has a fixed size (2^bits / 8 bytes) at any size of the data.
    Where it fills up it only lets more rows through to the exact step behind it.
    """
    cell = F.col(column).bitwiseAND((1 << bits) - 1)
    words = (
        frame.filter(F.col(column).isNotNull())
        .select(
            F.shiftright(cell, 6).alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(63).cast("int")).alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << max(0, bits - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    cells = values & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(cells >> np.uint64(6)).astype(np.int64)] >> (cells & np.uint64(63))) & np.uint64(1) == 1


def may_be_in(spark: SparkSession, bitmap: np.ndarray, value: Column) -> Column:
    """Whether the cell of a 64-bit value, never null, is set; only that value goes to Python."""
    shared = spark.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def look(values: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(shared.value, values.to_numpy().view(np.uint64)), pa.bool_())

    return look(value)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def key_halves(keys: Sequence[bytes]) -> np.ndarray:
    """The first 8 bytes of each 16-byte key as an integer."""
    return np.frombuffer(b"".join(keys), np.uint64)[::2].copy() if keys else np.empty(0, np.uint64)
