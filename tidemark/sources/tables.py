"""Catalog tables: namespaces, replace, properties, append, streaming-free smoke."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_namespaces(spark: SparkSession, names: Sequence[str], root: str | None = None) -> list[str]:
    """Create missing namespaces; returns those created, in order."""
    created = []
    for name in names:
        if not spark.catalog.databaseExists(name):
            location = f" LOCATION {_text(f'{root}/{name}')}" if root else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}{location}")
            created.append(name)
    return created


def replace_table(
    frame: DataFrame,
    name: str,
    properties: Mapping[str, str] | None = None,
    audit: Callable[[DataFrame, str], None] | None = None,
) -> None:
    """Replace a whole table, its properties set in sorted key order: write, audit, publish.

    The new table is written under another name, with its properties. ``audit`` gets its stored rows and that name and
    raises if they must not be published. Only then it takes the old one's place, so a failed write or audit leaves the
    old table as it was, rows and properties, and a table may be replaced by rows read from it. If the
    new table cannot take the name, the old one gets it back.
    """
    spark = frame.sparkSession
    following, previous = f"{name}__next", f"{name}__previous"
    drop_table(spark, following)
    _clear_location(spark, following)
    try:
        frame.write.format("parquet").saveAsTable(following)
        if properties:
            set_properties(spark, following, properties)
        if audit is not None:
            audit(spark.table(following), following)
    except BaseException:
        drop_table(spark, following)
        raise
    drop_table(spark, previous)
    existed = spark.catalog.tableExists(name)
    if existed:
        _rename(spark, name, previous)
    try:
        _rename(spark, following, name)
    except BaseException:
        if existed:
            _rename(spark, previous, name)
        raise
    drop_table(spark, previous)


def _clear_location(spark: SparkSession, name: str) -> None:
    """Delete what a task of a failed write left, after the table was dropped, where the table of that name will be."""
    if spark.catalog.tableExists(name):
        return
    database, _, table = name.rpartition(".")
    if spark.conf.get("spark.sql.caseSensitive") != "true":
        table = table.lower()
    location = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    path = spark._jvm.org.apache.hadoop.fs.Path(location, table)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _rename(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(name)} RENAME TO {_quoted(to)}")


def create_table_if_absent(frame: DataFrame, name: str) -> None:
    frame.write.mode("ignore").format("parquet").saveAsTable(name)


def create_empty_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
        for field in schema.fields
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet")


def append_rows(frame: DataFrame, name: str) -> None:
    """Append by position, as INSERT INTO does."""
    frame.write.mode("append").insertInto(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def set_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    pairs = ", ".join(f"{_text(key)} = {_text(value)}" for key, value in sorted(properties.items()))
    spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ({pairs})")


def read_properties(spark: SparkSession, name: str, keys: Sequence[str] | None = None) -> DataFrame:
    """(key, value) of a table's properties, limited to ``keys`` when given."""
    shown = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}")
    return shown.where(F.col("key").isin(list(keys))) if keys is not None else shown


def tagged_properties(spark: SparkSession, tables: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """(source_table, key, value) of several tables; ``tables`` maps the tag to the table name."""
    tagged = None
    for tag, name in tables.items():
        branch = read_properties(spark, name, keys).select(F.lit(tag).alias("source_table"), "key", "value")
        tagged = branch if tagged is None else tagged.unionAll(branch)
    return tagged.orderBy("source_table", "key")


def table_columns(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """(table_name, position, column_name, data_type) from the catalog."""
    rows = [
        (name.split(".")[-1], position, column.name, column.dataType)
        for name in tables
        for position, column in enumerate(spark.catalog.listColumns(name), start=1)
    ]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")


def with_temp_view(frame: DataFrame, name: str, statement: str) -> DataFrame:
    """Run one statement against a temporary view of the frame, then drop the view."""
    frame.createOrReplaceTempView(name)
    try:
        return frame.sparkSession.sql(statement)
    finally:
        frame.sparkSession.catalog.dropTempView(name)


def smoke(spark: SparkSession, name: str) -> int:
    """Create a table, insert one row, count it, drop it."""
    drop_table(spark, name)
    create_empty_table(spark, name, T.StructType([T.StructField("id", T.LongType())]))
    try:
        append_rows(spark.range(1, 2), name)
        return spark.table(name).count()
    finally:
        drop_table(spark, name)
