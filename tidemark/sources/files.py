"""File sources: Parquet, CSV, JSON lines, raw bytes and file listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import sha256_state
from tidemark.functions.cells import logical_type
from tidemark.operators import csv_scan, integrity, long_digests
from tidemark.operators.checks import ContractError
from tidemark.operators.cleaning import union_normalised

#: Names of files that Spark's line reader gives the content of, not the bytes.
DECOMPRESSED = r"(?i)\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd|lzo|lzo_deflate|passthrough)$"


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One Parquet frame over an explicit, ordered list of files."""
    return spark.read.parquet(*paths)


def read_parquet_normalised(spark: SparkSession, paths: Sequence[str], casts: Mapping[str, str]) -> DataFrame:
    """Read every file with its own schema, cast the drifting columns, then union by name."""
    return union_normalised([spark.read.parquet(path) for path in paths], casts)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def _uri() -> Column:
    """Paths of the line reader, the byte reader and the index in one form."""
    return F.regexp_replace("path", "^file:/+", "file:/").alias("path")


def raw_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, size, start, line) of all files below a folder: their lines, byte for byte, whatever they hold.

    ``start`` is where the line's split begins; the lines of a split follow each other in the file's order. Only
    line feeds end a line, so a carriage return stays at its end. Compressed files are read as their content, ``size``
    being that of the file. A byte order mark at the beginning of a file is left out by the reader.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    ).withColumn("path", _uri())


def file_paths(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path) of every file below a folder, empty ones too, which no reader gives a row for.

    The paths are those of the driver's own index of the files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    names = [(unquote(name),) for name in reader.load(path).inputFiles()]
    return spark.createDataFrame(names, "path string").select(_uri())


def csv_headers(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, header) for every file that the readers below would read, whatever its name: its first line.

    A byte order mark is skipped by Spark's line reader; ``csv_scan.file_violations`` finds it. The lines of a split come in
    the file's order, so the first of them is picked as they stream by and nothing is sorted. Empty files have no header.
    """
    first = csv_scan.first_lines(raw_lines(spark, path, glob).where(F.col("start") == 0))
    found = first.select("path", F.rtrim(F.col("line").cast("string"), F.lit("\r")).alias("header"))
    return file_paths(spark, path, glob).join(found, "path", "left")


def csv_violations(spark: SparkSession, path: str, names: Sequence[str], delimiter: str = ",") -> DataFrame:
    """(path, violation, record) of all files below a folder, compressed ones too: ``csv_scan.file_violations``."""
    archives = read_bytes(spark, path, f"*{csv_scan.GZIP}").select(_uri(), "content")
    return csv_scan.file_violations(raw_lines(spark, path), file_paths(spark, path), names, delimiter, archives)


def require_csv_header(spark: SparkSession, path: str, names: Sequence[str]) -> None:
    """The first line of every file is exactly the column names: no spaces, quotes or extra columns."""
    expected = ",".join(names)
    headers = csv_headers(spark, path)
    wrong = headers.where(~F.col("header").eqNullSafe(F.lit(expected))).select("path").limit(1).collect()
    if wrong or file_paths(spark, path).isEmpty():
        raise ContractError(f"CSV header is not exactly {expected!r}")


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with an exact header and a declared schema; a malformed row fails the job."""
    require_csv_header(spark, path, schema.fieldNames())
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_csv_text(spark: SparkSession, path: str, names: Sequence[str], corrupt: str = "_corrupt") -> DataFrame:
    """All cells as text, with the raw line kept where the width differs from the header."""
    fields = [T.StructField(name, T.StringType()) for name in (*names, corrupt)]
    return (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .csv(path)
    )


def read_json_inferred(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.json(list(paths))


def read_json_strict(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """JSON lines (gzip too) that fail on the first malformed record."""
    reader = spark.read.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(list(paths))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_bytes(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, modificationTime, length, content) per file; unread columns are not loaded."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def digests(spark: SparkSession, path: str, glob: str | None = None, stretch: int = long_digests.STRETCH) -> DataFrame:
    """(path, bytes, sha256) of the files below a folder that hold a byte, of any size.

    Files of up to ``stretch`` bytes are read whole, larger ones by one task after the other (``long_digests``), when the
    frame is made. Files that the line reader decompresses are always read whole, so they must stay under 2 GB.
    """
    contents = read_bytes(spark, path, glob)
    if not sha256_state.available():
        return integrity.file_digests(contents)
    # conditions on the index of the files alone, so no other file is opened
    large = (F.col("_metadata.file_size") > stretch) & ~F.col("_metadata.file_name").rlike(DECOMPRESSED)
    whole = integrity.file_digests(contents.where(~large))
    listed = contents.where(large).select("path", "length", _uri().alias("uri")).collect()
    if not listed:
        return whole
    sizes = {row["uri"]: row["length"] for row in listed}
    lines = raw_lines(spark, path, glob).where((F.col("size") > stretch) & ~F.col("path").rlike(DECOMPRESSED))
    found = long_digests.long_digests(lines, sizes, stretch)
    rows = [(row["path"], row["length"], found[row["uri"]]) for row in listed]
    return whole.unionByName(spark.createDataFrame(rows, "path string, bytes bigint, sha256 string"))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, bytes, modified_at) per file below a folder; contents are not read."""
    return read_bytes(spark, path, glob).select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at")
    )


def parquet_columns(spark: SparkSession, path: str) -> DataFrame:
    """(position, column_name, logical_type, nullable) of a Parquet file, from its footer schema."""
    rows = [
        (position, field.name, logical_type(field.dataType), field.nullable)
        for position, field in enumerate(spark.read.parquet(path).schema.fields)
    ]
    return spark.createDataFrame(rows, "position int, column_name string, logical_type string, nullable boolean")
