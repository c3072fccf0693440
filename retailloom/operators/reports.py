"""Validation reports: freshness, referential integrity, row counts and stream health."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailloom.functions import as_timestamp, boundary_diff
from retailloom.operators.joins import orphan_counts, union_all

Tables = Callable[[str], DataFrame]


def last_loaded(tables: Tables, loaded_at: Mapping[str, str]) -> DataFrame:
    """Latest load time per table, reading only that one column."""
    return union_all([
        tables(name).agg(F.max(column).cast("timestamp_ntz").alias("last_loaded_at")).select(
            F.lit(name).alias("table_name"), "last_loaded_at"
        )
        for name, column in loaded_at.items()
    ])


def freshness_report(tables: Tables, sla: Mapping[str, tuple[str, int]], as_of) -> DataFrame:
    """EMPTY, STALE or FRESH per table; ``sla`` maps a table to (load column, hours)."""
    latest = [
        last_loaded(tables, {name: column}).withColumn("sla_hours", F.lit(hours)) for name, (column, hours) in sla.items()
    ]
    hours = F.col("hours_since_last_load")
    return (
        union_all(latest)
        .withColumn("hours_since_last_load", boundary_diff("hour", F.col("last_loaded_at"), as_timestamp(as_of)))
        .withColumn(
            "freshness_status",
            F.when(F.col("last_loaded_at").isNull(), "EMPTY").when(hours > F.col("sla_hours"), "STALE").otherwise("FRESH"),
        )
        .orderBy(hours.desc_nulls_first(), "table_name")
    )


def source_freshness(tables: Tables, limits: Mapping[str, tuple[str, int, int]], as_of) -> DataFrame:
    """pass, warn or error per source from the age of its latest load.

    ``limits`` maps a source to (load column, warn seconds, error seconds). A
    source without rows is an error.
    """
    age = F.col("age_seconds")
    parts = []
    for name, (column, warn, error) in limits.items():
        latest = last_loaded(tables, {name: column})
        parts.append(latest.withColumn("warn_after", F.lit(warn)).withColumn("error_after", F.lit(error)))
    return (
        union_all(parts)
        .withColumn("age_seconds", F.floor(boundary_diff("millisecond", F.col("last_loaded_at"), as_timestamp(as_of)) / 1000))
        .withColumn(
            "status",
            F.when(age.isNull() | (age > F.col("error_after")), "error").when(age > F.col("warn_after"), "warn").otherwise("pass"),
        )
    )


def referential_integrity_report(tables: Tables, references: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """Orphan rows per (check, child, child key, parent, parent key); NULL keys are orphans."""
    return union_all([
        orphan_counts(tables(child), child_key, tables(parent), parent_key, nulls_are_orphans=True).select(
            F.lit(check).alias("check_name"), "offending_rows"
        )
        for check, child, child_key, parent, parent_key in references
    ]).orderBy(F.desc("offending_rows"), "check_name")


def row_count_report(spark: SparkSession, tables: Tables, bounds: Mapping[str, tuple[int, int]]) -> DataFrame:
    expected = spark.createDataFrame(
        [(name, low, high) for name, (low, high) in bounds.items()], "table_name string, min_rows long, max_rows long"
    )
    actual = union_all([
        tables(name).agg(F.count(F.lit(1)).alias("actual_rows")).select(F.lit(name).alias("table_name"), "actual_rows")
        for name in bounds
    ])
    rows = F.col("actual_rows")
    return (
        expected.join(actual, "table_name")
        .select(
            "table_name", "actual_rows", "min_rows", "max_rows",
            F.when(rows < F.col("min_rows"), "UNDER_MIN").when(rows > F.col("max_rows"), "OVER_MAX").otherwise("OK").alias("status"),
        )
        .orderBy("status", "table_name")
    )


def stream_exactly_once_report(stream: DataFrame) -> DataFrame:
    """Number of (partition, offset) pairs that landed more than once."""
    return (
        stream.groupBy("kafka_partition", "kafka_offset")
        .count()
        .where("count > 1")
        .agg(F.count(F.lit(1)).alias("offending_groups"))
        .select(F.lit("stream_duplicate_offsets").alias("check_name"), "offending_groups")
    )


def stream_freshness_report(stream: DataFrame, as_of, sla_minutes: int = 5) -> DataFrame:
    minutes = F.col("minutes_since_last_load")
    return (
        stream.agg(F.max("ingested_at").alias("last_loaded_at"), F.count(F.lit(1)).alias("row_count"))
        .withColumn("minutes_since_last_load", boundary_diff("minute", F.col("last_loaded_at"), as_timestamp(as_of)))
        .select(
            F.lit("stream_sales").alias("table_name"),
            "last_loaded_at",
            F.lit(sla_minutes).alias("sla_minutes"),
            "minutes_since_last_load",
            "row_count",
            F.when(F.col("last_loaded_at").isNull(), "EMPTY").when(minutes > sla_minutes, "STALE").otherwise("FRESH").alias("freshness_status"),
        )
    )


def latency_summary(digits: int) -> list:
    """Average and maximum latency in seconds, the active partitions and the event count."""
    millis = boundary_diff("millisecond", F.col("event_ts"), F.col("ingested_at"))
    return [
        F.count(F.lit(1)).alias("events"),
        F.round(F.avg(millis) / 1000, digits).alias("avg_latency_seconds"),
        F.round(F.max(millis) / 1000, digits).alias("max_latency_seconds"),
        F.count_distinct("kafka_partition").alias("active_partitions"),
    ]


def stream_throughput_report(stream: DataFrame, as_of, minutes: int = 15) -> DataFrame:
    since = as_timestamp(as_of) - F.expr(f"interval {int(minutes)} minutes")
    recent = stream.where(F.col("ingested_at") >= since)
    return recent.agg(*latency_summary(3)).withColumnRenamed("events", f"events_last_{minutes}min")
