"""Chat formatting from an event log: fold the events of each conversation into messages, then render."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, small_batches

START, END = "<|im_start|>", "<|im_end|>"
EVENT_COLUMNS = ("conv_id", "turn", "seq", "op", "role", "text")
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: a backslash is put between, one more where there are some already."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Like ``escape``, and without line breaks, as one ends the role."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int | None, int | None]:
    """A message in the template, and the code points in it that count for the loss."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    loss = (len(head), len(head) + len(body)) if role == "assistant" else (None, None)
    return f"{head}{body}{END}\n", *loss


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a rendered message."""
    role, _, rest = segment.removeprefix(START).partition("\n")
    return unescape_role(role), unescape(rest.removesuffix(f"{END}\n"))


def events_of_rows(conversations: DataFrame) -> DataFrame:
    """Each row of a table of finished turns as one ``message`` event without a sequence: all rows stay."""
    return conversations.select(
        "conv_id", "turn", F.lit(None).cast("long").alias("seq"), F.lit("message").alias("op"), "role", "text"
    )


def _fold(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Messages (conv_id, turn, role, text) from live events sorted by conversation, turn and sequence."""
    key, last, role, parts, reset = None, None, None, [], None
    for row in rows:
        if row == last and row[2] is not None:  # delivered twice
            continue
        conv_id, turn, seq, op, own, text = last = row
        starts = op not in ("delta", "edit", "regenerate")
        beside = starts and reset == ("message", seq)  # another message of that moment
        if key != (conv_id, turn) or beside:
            if key is not None:
                yield (*key, role or "", "".join(parts))
            key, role, parts, reset = (conv_id, turn), None, [], None
        if op != "delta":
            parts, reset = [], ("message" if starts else op, seq)
        parts.append(text or "")
        role = own if own is not None else role
    if key is not None:
        yield (*key, role or "", "".join(parts))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _emit(rows: Iterator[tuple], schema: pa.Schema, most_chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += 64 + sum(len(value) for value in row if isinstance(value, str))
        if chars >= most_chars:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def format_chats(spark: SparkSession, events: DataFrame) -> DataFrame:
    """One row for each final message: conv_id, place, turn, offset, segment, loss_start, loss_end.

    ``events`` has conv_id, turn, seq, op, role, text. In the order of ``seq``, a ``message`` starts or
    replaces a turn, a ``delta`` adds to its text, an ``edit`` replaces the text, and ``regenerate``
    replaces it and discards the later turns written before. Any other or null ``op`` is a message. The
    segments of a conversation, joined in the order of ``place``, are its formatted text; ``offset``
    counts the code points before the segment, the loss bounds count inside it.

    Null texts and roles are empty, null ids are a conversation of their own, null turns and sequences
    come first. Equal events with a known sequence were delivered twice and count once; without a sequence each
    is an event of its own. Different messages of one turn and sequence all stay, in the order of role and text. A turn of deltas alone is their concatenation.

    A conversation is sorted by its task on disk and streams through it; one message is in memory.
    """
    small_batches(spark)
    seq = F.coalesce(F.col("seq"), F.lit(-(1 << 62)).cast("long"))
    turn = F.coalesce(F.col("turn"), F.lit(-(1 << 62)).cast("long"))
    earlier = Window.partitionBy("conv_id").orderBy("turn_key").rangeBetween(Window.unboundedPreceding, -1)
    live = (
        events.select(*EVENT_COLUMNS, seq.alias("seq_key"), turn.alias("turn_key"))
        .withColumn("horizon", F.max(F.when(F.col("op") == "regenerate", F.col("seq_key"))).over(earlier))
        .filter("horizon IS NULL OR seq_key >= horizon")
        .sortWithinPartitions("conv_id", "turn_key", "seq_key", "op", "role", "text")
        .select(*EVENT_COLUMNS)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments() -> Iterator[tuple]:
            current, place, offset = (), 0, 0
            for conv_id, turn, role, text in _fold(_rows(batches)):
                if current != (conv_id,):
                    current, place, offset = (conv_id,), 0, 0
                segment, begin, end = render(role, text)
                yield conv_id, place, turn, offset, segment, begin, end
                place, offset = place + 1, offset + len(segment)

        yield from _emit(segments(), pa.schema([
            ("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("offset", pa.int64()),
            ("segment", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()),
        ]))

    return live.mapInArrow(
        run,
        "conv_id bigint, place bigint, turn bigint, offset bigint, segment string, loss_start bigint, loss_end bigint",
    )


def digests(spark: SparkSession, segments: DataFrame) -> DataFrame:
    """Per conversation, from its written segments alone: turns, digests of turns and of the loss text.

    Digests are fed message by message as a sorted conversation streams by.
    """
    small_batches(spark)
    ordered = (
        segments.select("conv_id", "place", "segment", "loss_start", "loss_end")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "place")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def totals() -> Iterator[tuple]:
            current, state = None, None
            for conv_id, _, segment, begin, end in _rows(batches):
                if current != (conv_id,):
                    if current:
                        yield finish(current, state)
                    current, state = (conv_id,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(segment)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if begin is not None:
                    masked = unescape(segment[begin:end])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(segment)
            if current:
                yield finish(current, state)

        def finish(current: tuple, state: list) -> tuple:
            return current[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        yield from _emit(totals(), pa.schema([
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
        ]))

    return ordered.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )


def write_chats(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The formatted segments, written to the shared folder and read back."""
    return Scratch(spark, "chats").write(format_chats(spark, events))
