"""Byte-pair encoding through a table of distinct words, and decoding by looking ids up in the vocabulary.

The tokenizer splits a text into words and encodes each on its own, so a word has the same ids wherever
it stands. Words are split where the texts are; each distinct word of the corpus is encoded once.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import partitions_for, small_batches

#: Words of a chunk of documents; a chunk's distinct words are looked up together.
CHUNK_WORDS = 2_000_000


def read_tokenizer(path: str) -> str:
    """The tokenizer's JSON, read once where the job is declared; tasks get it with their code."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _latin(kind: str) -> str:
    """Characters below U+0250 whose Unicode category begins with ``kind``, as part of a pattern."""
    return "".join(re.escape(chr(code)) for code in range(33, 0x250) if unicodedata.category(chr(code))[0] == kind)


class Splitter:
    """Splits a text into the words that the tokenizer would encode one by one.

    Texts of plain Latin characters, on which all versions of Unicode agree, go through one pattern; any
    other text goes through the library's own normaliser and pre-tokeniser. Special tokens are words.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        special = [token["content"] for token in json.loads(definition)["added_tokens"]]
        self.special = frozenset(special)
        self.cut = re.compile("(" + "|".join(re.escape(token) for token in special) + ")") if special else None
        letters, numbers = _latin("L"), _latin("N")
        # capitals whose small letters are further on (and dotted I, which becomes two) are not plain
        plain = [chr(code) for code in range(0xA1, 0x250) if len(low := chr(code).lower()) == 1 and ord(low) < 0x250]
        self.other = re.compile(rf"[^\t\n\r -~{''.join(map(re.escape, plain))}]")
        # only the contractions begin with what else is a mark, so they stand before the marks alone
        marks = r"'s|'t|'re|'ve|'m|'ll|'d"
        self.words = re.compile(rf"[{letters}]+|[{numbers}]|{marks}|[^\s{letters}{numbers}]+")
        self.ascii_words = re.compile(rf"[a-z]+|[0-9]|{marks}|[^\sa-z0-9]+")

    def __call__(self, text: str) -> list[str]:
        if self.cut is None or "<" not in text:
            return self._ordinary(text)
        parts = self.cut.split(text)
        return list(itertools.chain.from_iterable([part] if part in self.special else self._ordinary(part) for part in parts))

    def pieces(self, text: str) -> list[str]:
        """Larger parts than words: what stands between white space in plain texts, else words."""
        if self.other.search(text):
            return self(text)
        if self.cut is None or "<" not in text:
            return text.lower().split()
        parts = self.cut.split(text)
        return list(itertools.chain.from_iterable([part] if part in self.special else part.lower().split() for part in parts))

    def distinct_pieces(self, texts: list[str]) -> tuple[list[int], list[str], np.ndarray, np.ndarray]:
        """The texts' order, their distinct pieces, and for the texts in that order the place of each piece among
        those and how many pieces each text has.

        Plain texts, whose only white space is ASCII, are cut and their pieces made distinct by Arrow; the others come last.
        """
        odd = [at for at, text in enumerate(texts) if self.cut is not None and "<" in text or self.other.search(text)]
        plain = sorted(set(range(len(texts))).difference(odd))
        cut = pc.ascii_split_whitespace(pa.array([texts[at].lower().strip() or None for at in plain], pa.string()))
        rest = [self.pieces(texts[at]) for at in odd]
        found = pa.concat_arrays([cut.flatten(), pa.array(itertools.chain.from_iterable(rest), pa.string())]).dictionary_encode()
        sizes = np.concatenate((pc.fill_null(pc.list_value_length(cut), 0).to_numpy(), np.array(list(map(len, rest)), np.int32)))
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        return plain + odd, distinct, found.indices.to_numpy(), sizes

    def words_of(self, piece: str) -> list[str]:
        """The words of a piece; a word is its only one."""
        if piece in self.special or self.other.search(piece):
            return [piece]
        return (self.ascii_words if piece.isascii() else self.words).findall(piece)

    def _ordinary(self, text: str) -> list[str]:
        if not self.other.search(text):
            return (self.ascii_words if text.isascii() else self.words).findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        return [normal[begin:end] for _, (begin, end) in self.library.pre_tokenizer.pre_tokenize_str(normal)]


class WordEncoder:
    """Ids of words by the library's own model: all ids one after the other, and how many each word has."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        self.special = {token["content"]: token["id"] for token in parts["added_tokens"]}
        parts |= {"normalizer": None, "added_tokens": [], "post_processor": None, "truncation": None, "padding": None}
        self.library = Tokenizer.from_str(json.dumps(parts))
        self.model = self.library.model
        # the byte level stands for each byte by a character: printable ones of Latin-1 for themselves
        same = [code for code in range(256) if 33 <= code <= 126 or 161 <= code <= 172 or code >= 174]
        others = (code for code in range(256) if code not in set(same))
        self.characters = {code: 256 + at for at, code in enumerate(others)}

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, special, found = self.model.tokenize, self.special, []
        for word in words:
            if word in special:
                found.append([special[word]])
            else:
                if not word.isascii() or not word.isprintable() or " " in word:
                    word = word.encode().decode("latin-1").translate(self.characters)
                found.append([token.id for token in tokenize(word)])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes


def gather(ids: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` with these begins and sizes, one after the other."""
    ends = np.cumsum(sizes)
    return ids[np.repeat(begins - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def newest(table: dict[str, int], count: int) -> list[str]:
    """The last ``count`` keys of a table in their order, without a walk over all others."""
    return list(itertools.islice(reversed(table), count))[::-1]


@functools.lru_cache(maxsize=2)
def splitter(definition: str) -> Splitter:
    return Splitter(definition)


@functools.lru_cache(maxsize=2)
def word_encoder(definition: str) -> WordEncoder:
    return WordEncoder(definition)


def pieces_of(definition: str) -> pa.Array:
    """Pieces by id for the whole vocabulary, a fixed size."""
    parts = json.loads(definition)
    pieces = dict(zip(parts["model"]["vocab"].values(), parts["model"]["vocab"].keys(), strict=True))
    pieces |= {token["id"]: token["content"] for token in parts["added_tokens"]}
    return pa.array([pieces.get(number) for number in range(max(pieces, default=-1) + 1)], pa.string())


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers as three planes of bytes, compressed: small numbers, the frequent ones, cost little."""
    data = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return zlib.compress(np.ascontiguousarray(data.T).tobytes(), 1)


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


_SPLIT = "doc_ids array<{kind}>, sizes array<int>, chunk bigint, bucket int, numbers binary, words binary"


def split_documents(
    spark: SparkSession, documents: DataFrame, definition: str, chunk_words: int = CHUNK_WORDS, buckets: int = 64
) -> DataFrame:
    """Chunks of documents as numbers of words, and the distinct words of each chunk by bucket.

    Rows without ``words`` hold documents: their ids, how many words each has, and all their words as
    numbers in the chunk's order of frequency. Rows with ``words`` hold the words of a bucket, which is a
    hash of the word, and their numbers. Words are joined by a line break, which no word has.
    """
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(definition)
        chunk, id_type = TaskContext.get().partitionId() << 32, None
        table: dict[str, int] = defaultdict(itertools.count().__next__)
        ids, sizes, streams, count = [], [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            words = list(table)
            stream = np.concatenate(streams) if streams else np.empty(0, np.uint32)
            order = np.argsort(-np.bincount(stream, minlength=len(words)), kind="stable")
            number = np.empty(len(words), np.uint32)
            number[order] = np.arange(len(words))
            ends = np.cumsum(sizes)
            for begin in range(0, len(ids), 512):
                stop = min(begin + 512, len(ids))
                part = stream[ends[begin] - sizes[begin] : ends[stop - 1]]
                yield row([ids[begin:stop]], [sizes[begin:stop]], [None], [pack_numbers(number[part])], [None])
            bucket = np.fromiter(map(zlib.crc32, map(str.encode, words)), np.uint32, len(words)) % buckets
            by_bucket = np.lexsort((number, bucket))
            edges = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
            for at in np.flatnonzero(np.diff(edges)):
                own = by_bucket[edges[at] : edges[at + 1]]
                text = "\n".join([words[place] for place in own]).encode()
                gaps = np.diff(number[own], prepend=np.uint32(0))
                yield row([None], [None], [at], [pack_numbers(gaps)], [zlib.compress(text, 1)])

        def row(doc_ids: list, doc_sizes: list, bucket: list, numbers: list, words: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "doc_ids": pa.array(doc_ids, pa.list_(id_type)), "sizes": pa.array(doc_sizes, pa.list_(pa.int32())),
                "chunk": pa.array([chunk], pa.int64()), "bucket": pa.array(bucket, pa.int32()),
                "numbers": pa.array(numbers, pa.binary()), "words": pa.array(words, pa.binary()),
            })

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = split(text or "")
                ids.append(doc_id)
                sizes.append(len(words))
                streams.append(np.fromiter(map(table.__getitem__, words), np.uint32, len(words)))
                count += len(words)
                if count >= chunk_words:
                    yield from close()
                    chunk, count = chunk + 1, 0
                    table = defaultdict(itertools.count().__next__)
                    ids, sizes, streams = [], [], []
        if ids:
            yield from close()

    return documents.select("doc_id", "text").mapInArrow(run, _SPLIT.format(kind=kind))


def encode_buckets(split: DataFrame, definition: str) -> DataFrame:
    """(chunk, numbers, sizes, ids) for each row with words: the ids of the same words.

    All rows of a bucket meet in one task, which encodes each distinct word of it once.
    """

    def words_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(batch.column("words").is_valid()).select(["chunk", "bucket", "numbers", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(definition)
        current, known = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != current:
                    current, known = row["bucket"], KnownWords(encode)
                words = zlib.decompress(row["words"]).decode().split("\n")
                ids, sizes = known.ids_of(known.numbers_of(words))
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([row["chunk"]], pa.int64()), "numbers": pa.array([row["numbers"]], pa.binary()),
                    "sizes": pa.array([pack_numbers(sizes)], pa.binary()), "ids": pa.array([pack_numbers(ids)], pa.binary()),
                })

    words = split.mapInArrow(words_only, "chunk bigint, bucket int, numbers binary, words binary")
    ordered = words.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(run, "chunk bigint, numbers binary, sizes binary, ids binary")


def encode_decode(
    spark: SparkSession, documents: DataFrame, definition: str, chunk_words: int = CHUNK_WORDS, buckets: int | None = None
) -> DataFrame:
    """doc_id, n_tokens, ids and decoded (text, joined by one space) for each document.

    The ids are those the library gives without special tokens added; ``decoded`` is what its decode
    gives for them. Null and empty texts have no ids. Rows with null or equal ids are kept, each by its
    own text. Other columns are not read.

    A chunk has a bounded number of words (a longer document is one alone), so the group in which its
    words meet its documents is bounded, and a word of all documents is sent once per chunk. The words
    are dealt over ``buckets`` (four for each task of an exchange, if not given).

    Texts are split once: both sides of the join read the same exchange by chunk. The filters are in the
    functions, as the optimiser would else move them below it and split twice. ``documents`` is a table
    read from files, so a task that runs again makes the same chunks; write any other frame first.
    """
    small_batches(spark)
    buckets = buckets or 4 * partitions_for(spark)
    split = split_documents(spark, documents, definition, chunk_words, buckets).repartition("chunk")
    kind = dict(documents.dtypes)["doc_id"]
    found = encode_buckets(split, definition)
    pieces = pieces_of(definition)

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = right.to_pylist()
        numbers = [np.cumsum(unpack_numbers(row["numbers"]), dtype=np.int64) for row in rows]
        sizes = [unpack_numbers(row["sizes"]).astype(np.int64) for row in rows]
        ids = [unpack_numbers(row["ids"]) for row in rows]
        if not rows:
            numbers = sizes = ids = [np.empty(0, np.int64)]
        flat, length = np.concatenate(ids), np.concatenate(sizes)
        order = np.argsort(np.concatenate(numbers))
        begin = (np.cumsum(length) - length)[order]
        length = length[order]
        # ids meet their pieces here, then both are joined to the words by number
        texts = pieces.take(pa.array(flat, pa.int64())).to_pylist()
        texts = [" ".join(texts[a : a + n]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
        marks = list(map(str, flat.tolist()))
        marks = [" ".join(marks[a : a + n]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
        out: list[list] = [[], [], [], []]
        for row in left.filter(left.column("words").is_null()).select(["doc_ids", "sizes", "numbers"]).to_pylist():
            stream = unpack_numbers(row["numbers"]).astype(np.int64)
            ends = np.cumsum(row["sizes"])
            for doc_id, end, size in zip(row["doc_ids"], ends.tolist(), row["sizes"], strict=True):
                at = stream[end - size : end]
                out[0].append(doc_id)
                out[1].append(int(length[at].sum()))
                at = at.tolist()
                out[2].append(" ".join([marks[place] for place in at]))
                out[3].append(" ".join([texts[place] for place in at]))
        id_type = left.schema.field("doc_ids").type.value_type
        return pa.table({
            "doc_id": pa.array(out[0], id_type), "n_tokens": pa.array(out[1], pa.int64()),
            "ids": pa.array(out[2], pa.string()), "decoded": pa.array(out[3], pa.string()),
        })

    return (
        split.groupBy("chunk")
        .cogroup(found.groupBy("chunk"))
        .applyInArrow(join, f"doc_id {kind}, n_tokens bigint, ids string, decoded string")
    )


class KnownWords:
    """Words met so far, numbered, each encoded once when its ids are asked for."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.table: dict[str, int] = defaultdict(itertools.count().__next__)
        self.ids, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.begins, self.used = np.empty(0, np.int64), np.empty(0, np.int64)
        self.chars = 0

    def forget(self, most_words: int, most_chars: int) -> None:
        """Beyond a bound, keep the most used third. Numbers asked for before are no longer valid."""
        if len(self.table) <= most_words and self.chars <= most_chars:
            return
        words = list(self.table)
        order = np.argsort(-self.used, kind="stable")
        length = np.fromiter(map(len, words), np.int64, len(words))
        stays = order[: most_words // 3]
        stays = np.sort(stays[np.cumsum(length[stays]) <= most_chars // 3])
        self.table = defaultdict(itertools.count().__next__)
        self.numbers_of([words[at] for at in stays.tolist()])
        self.ids = gather(self.ids, self.begins[stays], self.sizes[stays])
        self.sizes, self.used, self.chars = self.sizes[stays], self.used[stays] // 2, int(length[stays].sum())
        self.begins = np.cumsum(self.sizes) - self.sizes

    def numbers_of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.table.__getitem__, words), np.int64, len(words))

    def ids_of(self, numbers: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one word after the other, and how many each has.

        With ``times`` the numbers are distinct, and a word counts as used so many times.
        """
        if len(self.sizes) < len(self.table):
            fresh = newest(self.table, len(self.table) - len(self.sizes))
            ids, sizes = self.encode(fresh)
            self.chars += sum(map(len, fresh))
            self.begins = np.concatenate((self.begins, len(self.ids) + np.cumsum(sizes) - sizes))
            self.ids, self.sizes = np.concatenate((self.ids, ids)), np.concatenate((self.sizes, sizes))
            self.used = np.concatenate((self.used, np.zeros(len(fresh), np.int64)))
        if times is None:
            self.used += np.bincount(numbers, minlength=len(self.used))
        else:
            self.used[numbers] += times
        sizes = self.sizes[numbers]
        return gather(self.ids, self.begins[numbers], sizes), sizes


class CachedEncoder:
    """Ids of whole texts; a process remembers what it has met, up to bounds on number and length.

    A plain text is cut at white space first, which is far cheaper than into words; a new piece is cut into
    words, and a new word is encoded. At a bound the most used pieces or words stay. Texts are cut in groups of
    bounded length, so a batch of long ones holds the pieces of a few at a time.
    """

    def __init__(
        self, definition: str, most_pieces: int = 900_000, most_words: int = 100_000, most_chars: int = 16_000_000, group_chars: int = 2_000_000
    ):
        self.split = splitter(definition)
        self.most_pieces, self.most_words, self.most_chars, self.group_chars = most_pieces, most_words, most_chars, group_chars
        self.words = KnownWords(word_encoder(definition))
        self.known = KnownWords(self._pieces)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces by those of their words."""
        self.words.forget(self.most_words, self.most_chars)
        words = [self.split.words_of(piece) for piece in pieces]
        ids, sizes = self.words.ids_of(self.words.numbers_of(list(itertools.chain.from_iterable(words))))
        edges = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum([0, *map(len, words)])]
        return ids, np.diff(edges)

    def __call__(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        held, chars = [], 0
        for text in texts:
            held.append(text)
            chars += len(text)
            if chars >= self.group_chars:
                yield from self._encoded(held)
                held, chars = [], 0
        if held:
            yield from self._encoded(held)

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        self.known.forget(self.most_pieces, self.most_chars)
        order, pieces, place, counts = self.split.distinct_pieces(texts)
        ids, sizes = self.known.ids_of(self.known.numbers_of(pieces), np.bincount(place, minlength=len(pieces)))
        begins, sizes = (np.cumsum(sizes) - sizes)[place], sizes[place]
        ids = gather(ids, begins, sizes)
        edges = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
        found = dict(zip(order, zip(edges[:-1], edges[1:], strict=True), strict=True))
        return [ids[slice(*found[at])] for at in range(len(texts))]


@functools.lru_cache(maxsize=1)
def cached_encoder(definition: str) -> CachedEncoder:
    """The encoder of this process: tasks that a worker runs one after the other share what it remembers."""
    return CachedEncoder(definition)
