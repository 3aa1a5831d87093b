"""Stream sources, payload decoding and append sinks."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The event payload.
EVENT_PAYLOAD = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)
DISTINCT_USERS = 10


def broker_stream(spark: SparkSession, topic: str, servers: str, **options: str) -> DataFrame:
    """Records of a topic from the earliest offset; needs the broker connector on the classpath."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("startingOffsets", "earliest")
    return reader.options(**options).load()


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, kind: str = "json", glob: str | None = None, **options: str
) -> DataFrame:
    """New files of a folder as they arrive, with a declared schema."""
    reader = spark.readStream.schema(schema).options(**options)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format(kind).load(folder)


def union_streams(streams: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(lambda left, right: left.unionByName(right), streams)


def encode_payload(rows: DataFrame, fields: Mapping[str, str | Column]) -> DataFrame:
    """One JSON text per row in ``value``."""
    columns = [(F.col(source) if isinstance(source, str) else source).alias(name) for name, source in fields.items()]
    return rows.select(F.to_json(F.struct(*columns)).alias("value"))


def click_events(spark: SparkSession, count: int, start: Column) -> DataFrame:
    """Payloads of a synthetic click producer: ten users in turn, one event a second from ``start``."""
    second = F.date_trunc("second", start) + F.make_dt_interval(secs=F.col("id"))
    return encode_payload(
        spark.range(count),
        {
            "user_id": F.concat(F.lit("u"), F.col("id") % DISTINCT_USERS),
            "event": F.lit("click"),
            "ts": F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        },
    )


def decode_payload(records: DataFrame, schema: T.StructType = EVENT_PAYLOAD, value: str = "value") -> DataFrame:
    """Typed columns of JSON payloads, given as text or bytes."""
    return records.select(F.from_json(F.col(value).cast("string"), schema).alias("e")).select("e.*")


def generation_checkpoint(base: str, job: str, scale: str, publication_id: str, manifest_sha256: str) -> str:
    """Checkpoint folder bound to one source generation: a new generation starts afresh."""
    return f"{base.rstrip('/')}/{job}/{scale}/{publication_id}/{manifest_sha256}/"


def drain_to_folder(stream: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """Append everything available to Parquet files, stop, and return the batch view of the sink."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(folder)


def drain_to_table(stream: DataFrame, table: str, checkpoint: str, path: str | None = None) -> DataFrame:
    """As ``drain_to_folder`` into a catalog table."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if path is not None:
        writer = writer.option("path", path)
    writer.trigger(availableNow=True).toTable(table).awaitTermination()
    return stream.sparkSession.table(table)


def drain_batches(stream: DataFrame, handle, checkpoint: str) -> None:
    """Hand every available micro-batch to ``handle(batch, batch_id)``, then stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
