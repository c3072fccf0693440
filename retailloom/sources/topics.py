"""Keyed event topics. The connector is Spark's own Kafka source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Columns the operators need from any topic source.
RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """One topic from its start; later runs resume from the checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().selectExpr("cast(key as string) key", "cast(value as string) value", "partition", "offset")


def read_record_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Topic records kept as files, streamed with the same columns as a topic."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def write_topic(records: DataFrame, servers: str, topic: str) -> None:
    """Publish (key, value) records; equal keys stay ordered on one partition."""
    (
        records.select("key", "value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.enable.idempotence", "true")
        .option("topic", topic)
        .save()
    )
