"""Removal of repeated passages: windows of words counted exactly in super-k-mer buckets."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (
    Scratch,
    bitmap_of,
    hash_windows,
    in_bitmap,
    key_halves,
    signed,
    small_batches,
    word_groups,
)

#: Words of a window, and of the runs among which a window's minimiser is chosen.
WINDOW, MINIMISER = 35, 8
#: Cells (a power of two) of the bitmap of minimisers that occur more than once: 2^27 bits are 16 MB.
BITMAP_BITS = 27
#: Cells (a power of two) of the bitmap of texts that lose words: 2^25 bits are 4 MB.
TEXT_BITS = 25
#: Strings of one minimiser that a task sorts; the windows of larger buckets are dealt out one by one.
BUCKET_STRINGS = 20_000


def text_key(words: list[bytes]) -> bytes:
    """128 bits that stand for a sequence of words."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def super_kmers(hashes: np.ndarray, window: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser hash, first window, windows) of each run of windows that share a minimiser.

    The minimiser of a window is the least hash of its runs of words, the first one of equals. Equal
    windows have equal minimisers wherever they stand.
    """
    runs = hash_windows(hashes, minimiser)
    span = window - minimiser + 1
    if len(hashes) < window:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    views = sliding_window_view(runs, span)
    place = np.argmin(views, axis=1) + np.arange(len(views))
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return runs[place[first]], first, np.diff(np.append(first, len(place)))


def _distinct_texts(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple]:
    """(key, words, hashes) of the texts of a task; copies within a bounded stretch come once."""
    seen: set[bytes] = set()
    for batch in batches:
        for _, words, bounds, hashes in word_groups(batch.column(column).to_pylist()):
            for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
                own = words[begin:end]
                key = text_key(own)
                if key in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(key)
                yield key, own, hashes[begin:end]


def _minimisers(texts: DataFrame, window: int, minimiser: int) -> DataFrame:
    """(value, n): super-k-mers by minimiser, summed over stretches of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_pydict({"value": signed(values), "n": pa.array(counts, pa.int32())})

        for _, _, hashes in _distinct_texts(batches):
            found = super_kmers(hashes, window, minimiser)[0]
            if len(found):
                held.append(found)
                size += len(found)
            if size >= 1_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return texts.mapInArrow(run, "value bigint, n int")


def _packed(texts: DataFrame, repeated: np.ndarray, window: int, minimiser: int) -> DataFrame:
    """(string key, minimiser, string, text key, first window) of super-k-mers whose minimiser recurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[], [], [], [], []]
        size = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[0], pa.binary()), signed(np.array(rows[1], np.uint64)), pa.array(rows[2], pa.binary()),
                    pa.array(rows[3], pa.binary()), pa.array(rows[4], pa.int32()),
                ],
                names=["skey", "minimiser", "packed", "key", "first"],
            )

        for key, words, hashes in _distinct_texts(batches):
            values, firsts, counts = super_kmers(hashes, window, minimiser)
            for at in np.flatnonzero(in_bitmap(repeated, values)):
                packed = b" ".join(words[firsts[at] : firsts[at] + counts[at] + window - 1])
                rows[0].append(hashlib.blake2b(packed, digest_size=16).digest())
                rows[1].append(int(values[at]))
                rows[2].append(packed)
                rows[3].append(key)
                rows[4].append(int(firsts[at]))
                size += len(packed)
            if size >= 4_000_000:
                yield flush()
                rows, size = [[], [], [], [], []], 0
        if rows[0]:
            yield flush()

    return texts.mapInArrow(run, "skey binary, minimiser bigint, packed binary, key binary, first int")


def _windows(strings: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of packed strings as rows of word numbers, with their string and place in it."""
    numbers: dict[bytes, int] = {}
    rows, owner, place = [], [], []
    for at, string in enumerate(strings):
        ids = np.array([numbers.setdefault(word, len(numbers)) for word in string.split(b" ")], np.uint32)
        views = sliding_window_view(ids, window)
        rows.append(views)
        owner.append(np.full(len(views), at))
        place.append(np.arange(len(views)))
    return np.concatenate(rows), np.concatenate(owner), np.concatenate(place)


def _count_sorted(strings: list[bytes], twice: np.ndarray, window: int) -> list[list[int]]:
    """Places of repeated windows in each string, by sorting all windows; ``twice``: the string recurs."""
    rows, owner, place = _windows(strings, window)
    packed = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * 4))).ravel()
    order = np.argsort(packed, kind="stable")
    ordered = packed[order]
    group = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
    total = np.bincount(group, weights=1 + twice[owner[order]])
    hit = np.zeros(len(rows), bool)
    hit[order] = total[group] >= 2
    out: list[list[int]] = [[] for _ in strings]
    for at, where in zip(owner[hit].tolist(), place[hit].tolist(), strict=True):
        out[at].append(where)
    return out


def _small_buckets(strings: DataFrame, window: int) -> DataFrame:
    """(skey, places) of repeated windows: buckets of whole minimisers are sorted a stretch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, twice, size, last = [], [], [], 0, None

        def flush() -> pa.RecordBatch:
            found = _count_sorted(held, np.array(twice), window)
            some = [at for at, places in enumerate(found) if places]
            return pa.RecordBatch.from_pydict({
                "skey": pa.array([keys[at] for at in some], pa.binary()),
                "places": pa.array([found[at] for at in some], pa.list_(pa.int32())),
            })

        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("minimiser", "skey", "packed", "twice"))
            for value, skey, packed, again in zip(*columns, strict=True):
                if value != last and size >= 2_000_000:
                    yield flush()
                    keys, held, twice, size = [], [], [], 0
                last = value
                keys.append(skey)
                held.append(packed)
                twice.append(again)
                size += len(packed)
        if held:
            yield flush()

    ordered = strings.select("minimiser", "skey", "packed", "twice").repartition("minimiser").sortWithinPartitions("minimiser")
    return ordered.mapInArrow(run, "skey binary, places array<int>")


def _large_buckets(strings: DataFrame, window: int) -> DataFrame:
    """The same for minimisers with very many strings: a row for each window, counted by its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, keys, places, weights = [], [], [], []
            columns = (batch.column(name).to_pylist() for name in ("skey", "packed", "twice"))
            for skey, packed, again in zip(*columns, strict=True):
                words = packed.split(b" ")
                for at in range(len(words) - window + 1):
                    digests.append(text_key(words[at : at + window]))
                    keys.append(skey)
                    places.append(at)
                    weights.append(1 + again)
            yield pa.RecordBatch.from_pydict({
                "window": pa.array(digests, pa.binary()), "skey": pa.array(keys, pa.binary()),
                "place": pa.array(places, pa.int32()), "weight": pa.array(weights, pa.int32()),
            })

    rows = strings.select("skey", "packed", "twice").mapInArrow(run, "window binary, skey binary, place int, weight int")
    repeated = rows.groupBy("window").agg(F.sum("weight").alias("n")).filter("n >= 2").select("window")
    return rows.join(repeated, "window").groupBy("skey").agg(F.collect_list("place").alias("places"))


def _spans(found: DataFrame, window: int) -> DataFrame:
    """(key, begins, ends): word spans to remove, from rows (key, first, places) of repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], []]
        for key, first, places in _sorted_rows(batches):
            for at in sorted(places):
                begin, end = first + at, first + at + window
                if out[0] and out[0][-1] == key and begin <= out[2][-1][-1]:
                    out[2][-1][-1] = max(end, out[2][-1][-1])
                elif out[0] and out[0][-1] == key:
                    out[1][-1].append(begin)
                    out[2][-1].append(end)
                else:
                    if len(out[0]) >= 20_000:
                        yield batch_of(out)
                        out = [[], [], []]
                    out[0].append(key)
                    out[1].append([begin])
                    out[2].append([end])
        if out[0]:
            yield batch_of(out)

    def batch_of(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "key": pa.array(out[0], pa.binary()), "begins": pa.array(out[1], pa.list_(pa.int32())),
            "ends": pa.array(out[2], pa.list_(pa.int32())),
        })

    ordered = found.repartition("key").sortWithinPartitions("key", "first")
    return ordered.mapInArrow(run, "key binary, begins array<int>, ends array<int>")


def _sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in ("key", "first", "places")), strict=True)


def repeated_spans(
    spark: SparkSession,
    texts: DataFrame,
    window: int = WINDOW,
    minimiser: int = MINIMISER,
    bitmap_bits: int = BITMAP_BITS,
    bucket_strings: int = BUCKET_STRINGS,
) -> DataFrame:
    """(key, begins, ends) of words covered by a window that also starts elsewhere in a different text,
    or twice in the same one. ``texts`` has the column ``text``; equal texts count as one here.

    1. Super-k-mers are counted by minimiser. A repeated window's minimiser occurs twice at least.
    2. Those with a repeated minimiser travel as one packed string; equal strings become one row that
       knows whether it occurs once or more often, so copies and shared passages are not multiplied.
    3. A minimiser's distinct strings meet in a bucket, where all windows are sorted and counted.
    4. Repeated windows go back to their texts by the string's digest.

    The bitmap between 1 and 2 has a fixed size; where it fills up, more strings travel, and the result
    is the same.
    """
    scratch = Scratch(spark, "supermers")
    counted = _minimisers(texts, window, minimiser).groupBy("value").agg(F.sum("n").alias("n"))
    repeated = bitmap_of(counted.filter("n >= 2"), "value", bitmap_bits)
    mers = scratch.write(_packed(texts, repeated, window, minimiser))
    occurrence = F.xxhash64("key", "first")
    strings = (
        mers.select("skey", "minimiser", "packed", occurrence.alias("occurrence"))
        .groupBy("skey")
        .agg(
            F.first("minimiser").alias("minimiser"),
            F.first("packed").alias("packed"),
            (F.min("occurrence") != F.max("occurrence")).cast("int").alias("twice"),
        )
    )
    strings = scratch.write(strings)
    large = strings.groupBy("minimiser").count().filter(F.col("count") > bucket_strings).select("minimiser")
    places = _small_buckets(strings.join(large, "minimiser", "left_anti"), window).unionByName(
        _large_buckets(strings.join(large, "minimiser"), window)
    )
    found = mers.select("skey", "key", "first").join(places, "skey").select("key", "first", "places")
    spans = scratch.write(_spans(found, window))
    scratch.drop(mers, strings)
    return spans


def remove_repeats(
    spark: SparkSession,
    documents: DataFrame,
    window: int = WINDOW,
    minimiser: int = MINIMISER,
    bitmap_bits: int = BITMAP_BITS,
    bucket_strings: int = BUCKET_STRINGS,
) -> DataFrame:
    """All columns of ``documents`` plus n_words, n_removed and kept_words.

    Words are ``[^\\x20\\x09-\\x0D]+`` unchanged. A word is removed if a window of 35 words that covers
    it also starts anywhere else; ``kept_words`` has the others joined by one space. Null and empty
    texts have no words and an empty ``kept_words``. A text that occurs in two rows is removed whole if
    it has a window. Rows with null or equal ids are rows like any other. Columns of the three names are
    replaced, all others stay, whatever their names.

    A bitmap of fixed size tells which texts may lose words. Only those meet their spans; the others are not shuffled.
    """
    small_batches(spark)
    own = [name for name in documents.columns if name not in ("n_words", "n_removed", "kept_words")]
    documents = documents.select(*own)
    scratch = Scratch(spark, "substring-dedup")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_key((text or "").encode("utf-8").split()) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"key": pa.array(found, pa.binary())})

    texts = documents.select("text").filter("text IS NOT NULL")
    copies = texts.mapInArrow(keys, "key binary").groupBy("key").count().filter("count >= 2").select("key")
    spans = repeated_spans(spark, texts, window, minimiser, bitmap_bits, bucket_strings)
    whole = copies.select("key", F.lit(True).alias("copied"))
    removed = scratch.write(spans.join(whole, "key", "full_outer"))

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"half": signed(key_halves(batch.column(0).to_pylist()))})

    bitmap = bitmap_of(removed.select("key").mapInArrow(halves, "half bigint"), "half", TEXT_BITS)
    shared = spark.sparkContext.broadcast(bitmap)

    width = len(own)
    taken = {name.lower() for name in own}
    key, *edges = (next(n for k in itertools.count(2) if (n := name + "_" * k) not in taken) for name in ("key", "begins", "ends", "copied"))
    removed = removed.select(*[F.col(name).alias(free) for name, free in zip(("key", "begins", "ends", "copied"), (key, *edges), strict=True)])
    schema = documents.schema
    nested = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)

    def met(batch: pa.RecordBatch) -> tuple[list[list[bytes]], list[bytes], np.ndarray]:
        """Words and key of each text, and whether it may lose words."""
        words = [(text or "").encode("utf-8").split() for text in batch.column(own.index("text")).to_pylist()]
        keys = list(map(text_key, words))
        return words, keys, in_bitmap(shared.value, key_halves(keys))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found, some = met(batch)
            rows = pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*own, key])
            yield rows.filter(pa.array(some))

    def whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, _, some = met(batch)
            words = [words[at] for at in np.flatnonzero(~some)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.filter(pa.array(~some)).columns, pa.array(list(map(len, words)), pa.int64()),
                    pa.array([0] * len(words), pa.int64()), pa.array([b" ".join(part).decode("utf-8") for part in words], pa.string()),
                ],
                names=[*own, "n_words", "n_removed", "kept_words"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = own.index("text")
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            columns = (batch.column(place).to_pylist() for place in (at, width, width + 1, width + 2))
            for text, begins, ends, copied in zip(*columns, strict=True):
                words = (text or "").encode("utf-8").split()
                size = len(words)
                if copied and size >= window:
                    words = []
                elif begins:
                    edge, parts = 0, []
                    for begin, end in zip(begins, ends, strict=True):
                        parts.extend(words[edge:begin])
                        edge = end
                    words = parts + words[edge:]
                n_words.append(size)
                n_removed.append(size - len(words))
                kept.append(b" ".join(words).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:width], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=[*own, "n_words", "n_removed", "kept_words"],
            )

    joined = (
        documents.mapInArrow(keyed, f"{nested}, `{key}` binary")
        .join(removed, key, "left")
        .select(*[F.col(f"`{name}`") for name in own], *edges)
    )
    schema = f"{nested}, n_words bigint, n_removed bigint, kept_words string"
    return documents.mapInArrow(whole_texts, schema).union(joined.mapInArrow(cut, schema))
