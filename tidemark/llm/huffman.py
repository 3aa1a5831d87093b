"""Token files: canonical length-limited Huffman codes in independent blocks with bit-offset checkpoints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import cached_encoder, pack_numbers, unpack_numbers
from tidemark.llm.common import Scratch, partitions_for, small_batches

#: Longest code. Two bits more than 2^16 ids need cost next to nothing against unlimited codes.
MAX_BITS = 18
#: Tokens after which a block is closed; a document is never split over blocks.
BLOCK_TOKENS = 1 << 18
#: Every so many tokens of a block the bit offset is noted; decoding runs from all of them at once.
CHECKPOINT = 256


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Code length of each id, 0 where it does not occur: optimal under the limit, by package-merge."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} ids do not fit codes of {most} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    packages, levels = np.empty(0, np.int64), []
    for _ in range(most):
        items = np.concatenate([leaves, packages])
        order = np.argsort(items, kind="stable")
        levels.append(order < len(leaves))
        items = items[order]
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * (len(used) - 1)
    for is_leaf in reversed(levels):
        some = int(is_leaf[:take].sum())
        lengths[used[:some]] += 1
        take = 2 * (take - some)
    return lengths


def canonical_codes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes by id, and the ids in the order of their codes: by length, then id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint64)
    if len(order):
        most = int(lengths.max())
        width = np.uint64(1) << (np.uint64(most) - lengths[order].astype(np.uint64))
        begins = np.cumsum(width) - width
        codes[order] = begins >> (np.uint64(most) - lengths[order].astype(np.uint64))
    return codes, order


def encode_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ``ids`` one after the other, and the bit offset of every 256th."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    begins = ends - size
    total = int(ends[-1]) if len(ids) else 0
    shifted = codes[ids] << (32 - size - (begins & 7)).astype(np.uint64)
    first = begins >> 3
    room = (total + 7) // 8 + 4
    data = np.zeros(room)
    for step in range(4):
        data += np.bincount(first + step, weights=(shifted >> np.uint64(24 - 8 * step)) & np.uint64(255), minlength=room)
    return data[: (total + 7) // 8].astype(np.uint8).tobytes(), begins[::CHECKPOINT]


class Decoder:
    """Looks up the next code of every checkpoint's run in one table step."""

    def __init__(self, lengths: np.ndarray):
        _, order = canonical_codes(lengths)
        self.bits = int(lengths.max()) if len(order) else 1
        span = 1 << (self.bits - lengths[order].astype(np.int64))
        self.ids = np.zeros(1 << self.bits, np.uint32)
        self.sizes = np.ones(1 << self.bits, np.uint8)
        self.ids[: span.sum()] = np.repeat(order, span)
        self.sizes[: span.sum()] = np.repeat(lengths[order], span)

    def __call__(self, data: bytes, checkpoints: np.ndarray, count: int) -> np.ndarray:
        padded = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
        words = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
        place = checkpoints.astype(np.int64)
        out = np.empty((len(place), CHECKPOINT), np.uint32)
        drop = np.uint32(32 - self.bits)
        for step in range(CHECKPOINT):
            at = np.minimum(place >> 3, len(words) - 1)  # the last run may go past its end
            key = (words[at] << (place & 7).astype(np.uint32)) >> drop
            out[:, step] = self.ids[key]
            place += self.sizes[key]
        return out.reshape(-1)[:count]


def tokenize(spark: SparkSession, documents: DataFrame, definition: str, end_id: int | None = 2) -> DataFrame:
    """(doc_id, ids) with the ids as ``pack_numbers`` stores them, ``end_id`` after each document."""
    small_batches(spark)
    kind = dict(documents.dtypes)["doc_id"]
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = cached_encoder(definition)
        for batch in batches:
            found = encode(text.as_py() or "" for text in batch.column("text"))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "ids": pa.array([pack_numbers(np.concatenate((ids, tail))) for ids in found], pa.binary()),
            })

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def _counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs: summed by task, then over tasks; a row for each id at most comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(0, np.int64)
        for batch in batches:
            ids = [unpack_numbers(data) for data in batch.column(0).to_pylist()]
            own = np.bincount(np.concatenate([np.empty(0, np.uint32), *ids]), minlength=len(sums)).astype(np.int64)
            own[: len(sums)] += sums
            sums = own
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"id": pa.array(some, pa.int64()), "n": pa.array(sums[some], pa.int64())})

    table = tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids = table.column("id").to_numpy()
    out = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
    out[ids] = table.column("n").to_numpy()
    return out


def write_tokens(spark: SparkSession, tokens: DataFrame, path: str) -> None:
    """Write (doc_id, ids) to ``path``: blocks in ascending doc_id order and the code lengths.

    ``ids`` are as ``pack_numbers`` stores them; null counts as none. Null ids of documents come first.
    Rows with equal ids follow each other in the order of their bytes. A shard is a range of doc_ids,
    written by one task; its blocks know their place in the shard, the reader adds the shards up.
    """
    staged = Scratch(spark, "tokens")
    rows = staged.write(
        tokens.select("doc_id", F.coalesce("ids", F.lit(pack_numbers(np.empty(0, np.uint32)))).alias("ids"))
    )
    lengths = code_lengths(_counts(rows))
    codes, _ = canonical_codes(lengths)
    kind = dict(rows.dtypes)["doc_id"]
    ordered = rows.repartitionByRange(partitions_for(spark), F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, parts, held = [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts).astype(np.int64)
            bits, checkpoints = encode_bits(ids, codes, lengths)
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()),
                "first_token": pa.array([first], pa.int64()), "n_tokens": pa.array([len(ids)], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(id_type)),
                "doc_tokens": pa.array([[len(part) for part in parts]], pa.list_(pa.int64())),
                "checkpoints": pa.array([checkpoints.astype("<u8").tobytes()], pa.binary()),
                "bits": pa.array([bits], pa.binary()),
            })

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                doc_ids.append(doc_id)
                parts.append(unpack_numbers(data))
                held += len(parts[-1])
                if held >= BLOCK_TOKENS:
                    yield close()
                    block, first = block + 1, first + held
                    doc_ids, parts, held = [], [], 0
        if doc_ids:
            yield close()

    schema = (
        f"shard int, block int, first_token bigint, n_tokens bigint, doc_ids array<{kind}>, doc_tokens array<bigint>, "
        "checkpoints binary, bits binary"
    )
    ordered.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/blocks")
    staged.drop(rows)
    some = np.flatnonzero(lengths)
    table = pa.table({"id": pa.array(some, pa.int32()), "bits": pa.array(lengths[some].astype(np.int32))})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/codes")


def read_tokens(spark: SparkSession, path: str, doc_id_type: str = "bigint") -> DataFrame:
    """(doc_id, start, ids) from files of ``write_tokens``: ``start`` counts all ids before the document."""
    table = spark.read.parquet(f"{path}/codes").toArrow()
    ids = table.column("id").to_numpy()
    lengths = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint8)
    lengths[ids] = table.column("bits").to_numpy()
    blocks = spark.read.parquet(f"{path}/blocks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (
        blocks.groupBy("shard")
        .agg(F.sum("n_tokens").alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("shard_start"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(lengths)
        for batch in batches:
            id_type = batch.schema.field("doc_ids").type.value_type
            for row in batch.to_pylist():
                tokens = decode(row["bits"], np.frombuffer(row["checkpoints"], "<u8"), row["n_tokens"]).astype("<u4")
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(sizes)
                start = row["shard_start"] + row["first_token"]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], id_type), "start": pa.array(start + ends - sizes, pa.int64()),
                    "ids": pa.array([tokens[end - size : end].tobytes() for end, size in zip(ends, sizes, strict=True)], pa.binary()),
                })

    # a row for each shard, that is for each task of the writing job
    return blocks.join(F.broadcast(shards), "shard").mapInArrow(
        run, f"doc_id {doc_id_type}, start bigint, ids binary"
    )


