"""Strict CSV checks of whole files, split by split: a parallel scan over the quote state."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import astuple, dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Suffix of files that the line reader decompresses and whose first bytes are looked at here.
GZIP = ".gz"


@dataclass
class Part:
    """What one stretch of lines does when it begins outside or inside of a quoted cell.

    ``ended`` counts the records that end in it. ``head`` counts the delimiters up to the first of these ends,
    ``tail`` those of the record that is open at the end. ``wrong``, ``broken`` and ``not_utf8`` are how many records
    ended before the first one of another width, before the first breach of quoting, and before the first line that
    is not UTF-8, or -1. ``inside`` says whether the end is within a quoted cell.
    """

    ended: int = 0
    head: int = 0
    tail: int = 0
    wrong: int = -1
    broken: int = -1
    not_utf8: int = -1
    inside: bool = False


class Machine:
    """Reads lines (without their line feed) from one of the two start states."""

    def __init__(self, inside: bool, width: int, delimiter: bytes, header: bool):
        self.part = Part(inside=inside)
        self.width, self.delimiter = width, delimiter
        #: The width of the first record is not known here (begun before), or not asked (the header).
        self.skips = inside or header
        self.bare = re.compile(b'[^"\\r\\0' + re.escape(delimiter) + b"]*")

    def _end(self, cells: int) -> None:
        part = self.part
        if part.ended == 0:
            part.head = part.tail
        if cells != self.width and part.wrong < 0 and not (self.skips and part.ended == 0):
            part.wrong = part.ended
        part.ended += 1
        part.tail = 0

    def line(self, line: bytes, valid: bool) -> None:
        part = self.part
        if not valid and part.not_utf8 < 0:
            part.not_utf8 = part.ended
        if part.broken >= 0:
            return
        if part.inside:
            if b'"' not in line and b"\0" not in line:
                return
        elif b'"' not in line and b"\0" not in line:
            plain = line.removesuffix(b"\r")
            if b"\r" not in plain:
                part.tail = plain.count(self.delimiter)
                self._end(part.tail + 1 if plain else 0)
                return
        self._marked(line)

    def _marked(self, line: bytes) -> None:
        """A line with quotes, null bytes or carriage returns, cell by cell."""
        part, place, size = self.part, 0, len(line)
        begin = place  # of the record, where it begins in this line
        if b"\0" in line:
            part.broken = part.ended
            return
        while True:
            if part.inside:
                quote = line.find(b'"', place)
                if quote < 0:
                    return
                place = quote + 1
                if line[place : place + 1] == b'"':
                    place += 1
                    continue
                part.inside, quoted = False, True
            elif line[place : place + 1] == b'"':
                part.inside, place = True, place + 1
                continue
            else:
                place, quoted = self.bare.match(line, place).end(), False
            stop = line[place : place + 1]
            if stop == self.delimiter:
                part.tail += 1
                place += 1
            elif stop in (b"", b"\r"):
                empty = part.tail == 0 and not quoted and place == begin
                self._end(0 if empty else part.tail + 1)
                if place + 1 >= size:  # the end of the line, with or without a carriage return
                    return
                place = begin = place + 1
            else:  # a quote in a bare cell, or more behind a closing quote
                part.broken = part.ended
                return


def scan(lines: Iterable[bytes], width: int, delimiter: bytes = b",", first: bool = False) -> tuple[Part, Part]:
    """The stretch of lines from both start states; ``first`` if the header is its first line."""
    machines = Machine(False, width, delimiter, first), Machine(True, width, delimiter, False)
    for line in lines:
        valid = _is_utf8(line)
        for machine in machines:
            machine.line(line, valid)
    return machines[0].part, machines[1].part


def _is_utf8(line: bytes) -> bool:
    if line.isascii():
        return True
    try:
        line.decode("utf-8", "strict")
    except UnicodeDecodeError:
        return False
    return True


def compose(parts: Iterable[tuple[Part, Part]], width: int) -> dict[str, int]:
    """First record of each violation of a file, from its stretches in order: not_utf8, quoting, width."""
    found: dict[str, int] = {}
    records = pending = 0
    inside = False
    for outside_part, inside_part in parts:
        part = inside_part if inside else outside_part
        if part.not_utf8 >= 0:
            found.setdefault("not_utf8", records + (part.not_utf8 if "quoting" not in found else 0))
        if "quoting" in found:
            continue
        if inside and part.ended and records > 0 and pending + part.head + 1 != width:
            found.setdefault("width", records)
        if part.wrong >= 0:
            found.setdefault("width", records + part.wrong)
        if part.broken >= 0:
            found["quoting"] = records + part.broken
            records += part.broken
            continue
        pending = part.tail + (pending if inside and not part.ended else 0)
        records += part.ended
        inside = part.inside
    if inside and "quoting" not in found:
        found["quoting"] = records
    return found


_PARTS = pa.schema([
    ("path", pa.string()), ("size", pa.int64()), ("start", pa.int64()), ("bytes", pa.int64()), ("header", pa.binary()),
    *((f"{side}_{name}", pa.int64()) for side in ("out", "in") for name in Part.__dataclass_fields__),
])


def split_parts(lines: DataFrame, width: int, delimiter: str = ",") -> DataFrame:
    """One row for each split of each file: its bytes, the file's first line, and its two parts.

    ``lines`` is ``files.raw_lines``: the lines of a split come one after the other. A split streams through its
    task; one batch of lines is in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, machines, size, header = None, None, 0, None

        def row() -> pa.RecordBatch:
            values = [*key, size, header, *(int(v) for machine in machines for v in astuple(machine.part))]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _PARTS, strict=True)], schema=_PARTS)

        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for path, length, start, line in zip(*columns, strict=True):
                if key != (path, length, start):
                    if key is not None:
                        yield row()
                    key, size, header = (path, length, start), 0, line if start == 0 else None
                    machines = (
                        Machine(False, width, delimiter.encode(), start == 0),
                        Machine(True, width, delimiter.encode(), False),
                    )
                size += len(line) + 1
                valid = _is_utf8(line)
                for machine in machines:
                    machine.line(line, valid)
        if key is not None:
            yield row()

    kinds = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}
    schema = ", ".join(f"`{field.name}` {kinds[field.type]}" for field in _PARTS)
    return lines.select("path", "size", "start", F.col("line").cast("binary").alias("line")).mapInArrow(run, schema)


def first_lines(lines: DataFrame) -> DataFrame:
    """(path, line) of each file's first line, as bytes; ``lines`` is ``files.raw_lines``, of first splits alone.

    A split streams through its task; one batch of lines is in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column("path"))
            names, begins = runs.values.to_pylist(), [0, *runs.run_ends.to_pylist()[:-1]]
            begun = begins[1:] if names[0] == last else begins
            last = names[-1]
            yield batch.take(pa.array(begun, pa.int64()))

    return lines.select("path", F.col("line").cast("binary").alias("line")).mapInArrow(run, "path string, line binary")


def file_violations(
    lines: DataFrame, listing: DataFrame, names: Sequence[str], delimiter: str = ",", compressed: DataFrame | None = None
) -> DataFrame:
    """(path, violation, record) of files: header, byte_order_mark, not_utf8, quoting and width.

    The first record of each violation is given, the header being record 0. The header must be the names, the
    delimiter between, and nothing else; a file without a line has none. A record ends with a line, or a carriage return,
    outside of quotes; every record has as many cells as there are names, an empty line having none. In a bare cell no
    quote may stand, behind a closing quote only a delimiter or the end of the record; null bytes are never allowed.
    A breach of quoting ends the records that can be told apart in a file, so it is the last one found in it, apart from
    lines that are not UTF-8.

    Each split is read once, for both states it may begin in; a file's splits are then composed in order. So a file
    is read by as many tasks as it has splits, and only a line is never divided. ``listing`` (path) names the files
    that must be there. ``compressed`` (path, content) has the compressed ones among them, as their first bytes do
    not show in the line reader's count, which leaves a byte order mark out.
    """
    expected = delimiter.join(names).encode()
    width = len(names)
    parts = split_parts(lines, width, delimiter)
    schema = pa.schema([("path", pa.string()), ("violation", pa.string()), ("record", pa.int64())])

    def fold(listed: pa.Table, table: pa.Table) -> pa.Table:
        if not table.num_rows:  # no line: no header
            return pa.table([listed.column("path"), ["header"] * listed.num_rows, [0] * listed.num_rows], schema=schema)
        rows = sorted(table.to_pylist(), key=lambda one: one["start"])
        names_of = list(Part.__dataclass_fields__)
        stretches = [
            tuple(Part(**{name: one[f"{side}_{name}"] for name in names_of}) for side in ("out", "in")) for one in rows
        ]
        found = compose(stretches, width)
        if (rows[0]["header"] or b"").removesuffix(b"\r") != expected:
            found["header"] = 0
        # the reader leaves a mark of three bytes out; a last line without its line feed counts one more
        if not rows[0]["path"].endswith(GZIP) and sum(one["bytes"] for one in rows) < rows[0]["size"]:
            found["byte_order_mark"] = 0
        return pa.table([[rows[0]["path"]] * len(found), list(found), list(found.values())], schema=schema)

    listed = listing.select("path").groupBy("path")
    out = listed.cogroup(parts.groupBy("path")).applyInArrow(fold, "path string, violation string, record bigint")
    return out if compressed is None else out.unionByName(_marked_archives(compressed))


def _marked_archives(compressed: DataFrame) -> DataFrame:
    """Compressed files whose first three bytes are a byte order mark; only these bytes are decompressed."""
    schema = pa.schema([("path", pa.string()), ("violation", pa.string()), ("record", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [
                path
                for path, content in zip(*(column.to_pylist() for column in batch.columns), strict=True)
                if zlib.decompressobj(31).decompress(content, 3) == b"\xef\xbb\xbf"
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(["byte_order_mark"] * len(paths)), pa.array([0] * len(paths))], schema=schema
            )

    head = F.substring("content", 1, 1 << 16)
    return compressed.select("path", head.alias("content")).mapInArrow(run, "path string, violation string, record bigint")


def utf8_violations(lines: DataFrame) -> DataFrame:
    """(path, lines): how many lines of a file are not UTF-8, for those that have one.

    No character crosses a line feed, so a file is UTF-8 if each of its lines is. Every split is a task's own work and
    lines are counted before the shuffle, so a file may be of any size.
    """
    return lines.where(~F.is_valid_utf8("line")).groupBy("path").agg(F.count(F.lit(1)).alias("lines"))
