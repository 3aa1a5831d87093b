"""Strict CSV checks against a reading of the whole text, letter by letter, and over many splits."""

import gzip
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidemark.operators import csv_scan, integrity
from tidemark.session import session_settings
from tidemark.sources import files

SMALL_SPLITS = {"spark.sql.files.maxPartitionBytes": 48, "spark.sql.files.openCostInBytes": 0}


def letter_by_letter(data, names):
    """The violations of one file, by the rules, on the whole text at once."""
    found = {}
    if data.startswith(b"\xef\xbb\xbf"):
        found["byte_order_mark"] = 0
        data = data[3:]
    if data.split(b"\n")[0].removesuffix(b"\r") != ",".join(names).encode():
        found["header"] = 0
    record, cells, state, begun, line_ok, line = 0, 1, "start", False, True, b""
    widths = []
    records_of_lines = []
    at = 0
    while at < len(data):
        letter = data[at : at + 1]
        if at == 0 or data[at - 1 : at] == b"\n":
            records_of_lines.append(record)
            nul = b"\0" in data[at:].split(b"\n")[0]
        if nul or (state == "bare" and letter == b'"') or (state == "after" and letter not in b'",\r\n'):
            found["quoting"] = record
            break
        if state == "quoted":
            state = "after" if letter == b'"' else "quoted"
        elif letter == b'"':
            state, begun = "quoted", True
        elif letter == b",":
            cells, state, begun = cells + 1, "start", True
        elif letter in (b"\r", b"\n"):
            widths.append(cells if begun else 0)
            record, cells, state, begun = record + 1, 1, "start", False
            if letter == b"\r" and data[at + 1 : at + 2] == b"\n":
                at += 1
        else:
            state, begun = "bare", True
        at += 1
    else:
        if state == "quoted":
            found["quoting"] = record
        elif data and data[-1:] != b"\n" and (begun or data[-1:] != b"\r"):
            widths.append(cells if begun else 0)
    wrong = [at for at, width in enumerate(widths) if at and width != len(names)]
    if wrong:
        found["width"] = wrong[0]
    records_of_lines += [record] * (data.count(b"\n") + 1 - len(records_of_lines))
    for line, own in zip(data.split(b"\n"), records_of_lines, strict=False):
        try:
            line.decode()
        except UnicodeDecodeError:
            found["not_utf8"] = own
            break
    return found


def random_file(rng):
    pieces = [b"a", b"1", b",", b"\n", b'"', b'""', b'"x,y"', b"\r\n", b"\xc3\xa9", b'"two\nlines"', b"b,c\n", b"1,2\n", b"1,2\n", b"1,2\n"]
    pieces += [b"\xff", b"\r", b"\0"] if rng.random() < 0.2 else []
    head = rng.choice([b"a,b\n", b"a,b\n", b"a,b\r\n", b"b,a\n", b"\xef\xbb\xbfa,b\n", b""])
    return head + b"".join(rng.choice(pieces) for _ in range(rng.randrange(25)))


def lines_of(data):
    lines = data.removeprefix(b"\xef\xbb\xbf").split(b"\n")
    return lines[:-1] if lines[-1] == b"" else lines


def test_composed_parts_are_the_whole_reading():
    rng = random.Random(3)
    for _ in range(6000):
        data = random_file(rng)
        lines = lines_of(data)
        cuts = sorted(rng.sample(range(len(lines) + 1), min(len(lines) + 1, rng.randrange(4))))
        stretches = [lines[a:b] for a, b in zip([0, *cuts], [*cuts, len(lines)], strict=True)]
        stretches = [one for one in stretches if one]
        parts = [csv_scan.scan(one, 2, first=at == 0) for at, one in enumerate(stretches)]
        expected = letter_by_letter(data, ["a", "b"])
        expected = {k: v for k, v in expected.items() if k not in ("header", "byte_order_mark")}
        assert csv_scan.compose(parts, 2) == expected, (data, stretches)


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(9)
    bodies = {f"f{at}.csv": random_file(rng) for at in range(60)}
    bodies |= {
        "two.csv": b'a,b\n1,2\n"3,4\n5,6\n"7,8\n' + b"9,9\n" * 40, "late.csv": b"a,b\n" + b"1,2\n" * 90 + b'1,x"y\n',
        "wide.data": b"a,b\n" + b'"1\n","2"\n' * 30 + b"1,2,3\n", "open.tsv": b"a,b\n" + b"1,2\n" * 20 + b'1,"2\n' * 3 + b"9,9\n" * 40,
        "none": b"", "a b%20é.csv": b"b,a\n", "e m": b"", "bad.txt": b"a,b\n" + b"1,\xc3\xa9\n" * 30 + b"1,\xc3\n", "mark.csv": b"\xef\xbb\xbfa,b\n1,2", "fine.csv": b"a,b\n1,2\n" * 1,
    }
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    for name, body in list(bodies.items())[:20] + [("mark.csv", bodies["mark.csv"])]:
        (tmp_path / f"{name}.gz").write_bytes(gzip.compress(body))
        bodies[f"{name}.gz"] = body
    return tmp_path, bodies


def test_every_file_over_many_splits(spark, folder, rows):
    path, bodies = folder
    with session_settings(spark, SMALL_SPLITS):
        assert files.raw_lines(spark, f"{path}/late.csv").rdd.getNumPartitions() >= 6
        found = files.csv_violations(spark, str(path), ["a", "b"])
        found = rows(found.select(F.regexp_extract("path", "[^/]+$", 0), "violation", "record"))
    expected = [(name, kind, at) for name, body in bodies.items() for kind, at in letter_by_letter(body, ["a", "b"]).items()]
    assert set(found) ^ set(expected) == set()
    assert found == sorted(expected)
    assert ("two.csv", "quoting", 2) in found and ("late.csv", "quoting", 91) in found
    assert ("wide.data", "width", 31) in found and ("open.tsv", "quoting", 21) in found


def test_files_that_are_not_utf8(spark, folder, rows):
    path, bodies = folder
    with session_settings(spark, SMALL_SPLITS):
        found = rows(csv_scan.utf8_violations(files.raw_lines(spark, str(path))).select(F.regexp_extract("path", "[^/]+$", 0), "lines"))
    count = {name: sum(line != line.decode(errors="ignore").encode() for line in body.split(b"\n")) for name, body in bodies.items()}
    assert found == sorted((name, number) for name, number in count.items() if number)


def test_marks_are_found_in_the_bytes_too(spark, folder):
    path, _ = folder
    found = integrity.bom_violations(files.read_bytes(spark, str(path), "mark.csv"))
    assert found.count() == 1


def test_headers_are_picked_without_a_sort(spark, tmp_path, rows):
    bodies = {
        "a.csv": b"id,name\n" + b"1,a\n" * 200, "b.csv": b"id,name\r\n2,b\r\n", "c.csv": b"\xef\xbb\xbfid,name\n", "d.csv": b"\n0,first\n",
        "e.csv": b"id", "f.csv": b"", "z.csv.gz": gzip.compress(b"packed\nid,name\n"),
    }
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    expected = [("a.csv", "id,name"), ("b.csv", "id,name"), ("c.csv", "id,name"), ("d.csv", ""), ("e.csv", "id"), ("f.csv", None), ("z.csv.gz", "packed")]
    for settings in ({}, SMALL_SPLITS, {"spark.sql.execution.arrow.maxRecordsPerBatch": 2}):
        with session_settings(spark, settings):
            headers = files.csv_headers(spark, str(tmp_path))
            assert rows(headers.select(F.regexp_extract("path", "[^/]+$", 0), "header")) == expected
            assert "SortAggregate" not in plan_of(headers)
