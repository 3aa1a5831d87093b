"""Context-triggered piecewise hashes of texts, and their likeness by edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, mix, partitions_for, powers, small_batches

#: Bytes that the rolling hash sees; a boundary depends on them alone.
WINDOW = 7
#: Pieces of a signature: at most so many and half of them at least, where a block size gives that.
PIECES = 64
#: Two signatures are alike only if they share a run of so many pieces.
COMMON_RUN = 4
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _signature(data: np.ndarray, rolling: np.ndarray, ends: np.ndarray) -> str:
    ends = ends + 1
    if not len(ends) or ends[-1] < len(data):
        ends = np.append(ends, len(data))
    starts = np.concatenate(([0], ends[:-1]))
    lengths = ends - starts
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    pieces = np.add.reduceat(data * powers(int(lengths.max()) + 1)[place + 1], starts)
    return _LETTERS[mix(pieces + rolling[ends - 1]) & np.uint64(63)].tobytes().decode()


def fingerprint(text: str) -> str:
    """``block:signature:signature at twice the block``; equal texts have equal fingerprints.

    The block size is the smallest power of two that promises at most 64 pieces, doubled while the text has
    more, then halved while it has fewer than 32. Where no block size gives 32 to 64 pieces, as in periodic
    texts, the signature is longer: every piece has its letter. The empty text is ``1::``.
    """
    data = np.frombuffer(text.encode("utf-8"), np.uint8).astype(np.uint64)
    if not len(data):
        return "1::"
    padded = np.concatenate((np.zeros(WINDOW - 1, np.uint64), data))
    rolling = np.zeros(len(data), np.uint64)
    for step, power in enumerate(powers(WINDOW + 1)[1:]):
        rolling += padded[step : step + len(data)] * power
    rolling = mix(rolling)

    def ends(level: int) -> np.ndarray:
        mask = np.uint64((1 << level) - 1)
        return np.flatnonzero((rolling & mask) == mask)

    level = max(0, (max(1, len(data) // PIECES) - 1).bit_length())
    found = ends(level)
    while len(found) >= PIECES and level < 63:
        level += 1
        found = ends(level)
    while level and len(found) < PIECES // 2:
        level -= 1
        found = ends(level)
    return f"{1 << level}:{_signature(data, rolling, found)}:{_signature(data, rolling, ends(level + 1))}"


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel between what both begin and end with."""
    same = len(commonprefix((a, b)))
    a, b = a[same:], b[same:]
    tail = len(commonprefix((a[::-1], b[::-1])))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    same += tail
    places: dict[str, int] = {}
    for at, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << at
    full = rest = (1 << len(a)) - 1
    for letter in b:
        hit = rest & places.get(letter, 0)
        rest = ((rest + hit) | (rest - hit)) & full
    return same + len(a) - rest.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    runs = {a[at : at + COMMON_RUN] for at in range(len(a) - COMMON_RUN + 1)}
    if not any(b[at : at + COMMON_RUN] in runs for at in range(len(b) - COMMON_RUN + 1)):
        return 0.0
    return 2.0 * _common(a, b) / (len(a) + len(b))


def likeness(left: str, right: str) -> float:
    """From 0 to 1: one less the share of letters to insert or delete, at the best shared block size.

    Block sizes that differ by more than a factor of two are not comparable and give 0.
    """
    if left == right:
        return 1.0
    (a, a1, a2), (b, b1, b2) = left.split(":"), right.split(":")
    if not a1 or not b1:
        return 0.0
    if a == b:
        return max(_alike(a1, b1), _alike(a2, b2))
    if int(a) == 2 * int(b):
        return _alike(a1, b2)
    if 2 * int(a) == int(b):
        return _alike(a2, b1)
    return 0.0


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by as many first ones of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = (
    "doc_id {id}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_NAMES = [part.split()[0] for part in _RESULT.split(", ")]


def _compared(doc_id, text: str, own: str, following: str, other: str) -> tuple:
    changed = edited(text, following)
    mark = fingerprint(changed)
    digest = hashlib.sha256(changed.encode("utf-8")).hexdigest()
    return doc_id, len(text), digest, own, mark, likeness(own, mark), likeness(own, other)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)],
        schema=schema,
    )


def fingerprints(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, with the likeness to it and to the next text.

    The next document is the one with the next higher ``doc_id``; the last one is followed by the first.
    Null texts count as empty, null ids come first, rows with equal ids follow each other in the order
    of their texts. One document alone follows itself. Other columns are not read.

    Texts are range-partitioned by id once and compared with their neighbour while they stream by. Only
    the first and the last row of each task meet in a second, small step.
    """
    small_batches(spark)
    kind = dict(documents.dtypes)["doc_id"]
    schema = _RESULT.format(id=kind) + ", part int, edge int, text string"
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = texts.repartitionByRange(partitions_for(spark), F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, arrow = None, None
        for batch in batches:
            arrow = pa.schema([
                ("doc_id", batch.schema.field("doc_id").type), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                ("near_next", pa.float64()), ("part", pa.int32()), ("edge", pa.int32()), ("text", pa.string()),
            ])
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                mark = fingerprint(text)
                if last is None:
                    rows.append((doc_id, None, None, mark, None, None, None, part, 0, text))
                else:
                    rows.append((*_compared(*last, text, mark), None, None, None))
                last = (doc_id, text, mark)
            if rows:
                yield _batch(rows, arrow)
        if last is not None:
            yield _batch([(last[0], None, None, last[2], None, None, None, part, 1, last[1])], arrow)

    found = Scratch(spark, "fingerprints").write(ordered.mapInArrow(compare, schema))
    edges = found.filter("edge IS NOT NULL")
    # one row for each task of the exchange
    order = Window.orderBy("part")
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = edges.filter("edge = 0").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_mark"))
    follows = heads.select(
        "part", F.coalesce(F.lead("part").over(order), F.first("part").over(everything)).alias("next_part")
    )
    pairs = (
        edges.filter("edge = 1")
        .select("part", "doc_id", "text", "fingerprint")
        .join(follows, "part")
        .join(heads.withColumnRenamed("part", "next_part"), "next_part")
        .select("doc_id", "text", "fingerprint", "next_text", "next_mark")
    )

    def compare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_compared(*row) for row in zip(*(column.to_pylist() for column in batch.columns), strict=True)]
            if rows:
                arrow = pa.schema([
                    ("doc_id", batch.schema.field("doc_id").type), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                    ("near_next", pa.float64()),
                ])
                yield _batch(rows, arrow)

    return found.filter("edge IS NULL").select(*_NAMES).unionByName(
        pairs.mapInArrow(compare_pairs, _RESULT.format(id=kind))
    )
