"""Run registered queries in Spark and their SQL in DuckDB and compare names, types and rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda index: names[index])
    return sorted(tuple(canonical(row[index]) for index in order) for row in rows)


def compare(frame, connection, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = rows_of(names, result.fetchall())
    actual = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    if sorted(names) != sorted(frame.columns):
        return f"columns differ: {sorted(frame.columns)} vs {sorted(names)}"
    if len(expected) != len(actual):
        return f"rows differ: {len(actual)} vs {len(expected)}"
    for left, right in zip(actual, expected, strict=True):
        if left != right:
            return f"first difference (columns {sorted(names)}):\n  spark {left}\n  sql   {right}"
    kinds = {column[0]: str(column[1]).upper() for column in result.description}
    wanted = {
        "bigint": {"BIGINT", "NUMBER"}, "int": {"INTEGER", "NUMBER"}, "double": {"DOUBLE", "NUMBER"},
        "string": {"VARCHAR", "STRING"}, "boolean": {"BOOLEAN", "BOOL"}, "date": {"DATE"},
        "timestamp_ntz": {"TIMESTAMP", "DATETIME"},
    }
    for name, kind in frame.dtypes:
        allowed = wanted.get(kind, {kind.upper().replace(" ", ""), "NUMBER"})
        if kinds[name].replace(" ", "") not in allowed:
            return f"type of {name}: {kind} vs {kinds[name]}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tidemark import build_session

    folder = os.environ.get("COMPARE_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failures = 0
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        try:
            frame = function(spark, folder)
            sql = entry.oracle_sql().get(name)
            problem = compare(frame, connection, sql) if sql else (None if frame.count() >= 0 else "")
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:26s} {time.time() - begun:6.2f}s {problem or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
