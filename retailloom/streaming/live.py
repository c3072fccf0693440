"""Operators over the unbounded stream: dedup, throughput, realtime fact and enrichment."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retailloom.functions import boundary_diff
from retailloom.operators.facts import fct_sales_realtime
from retailloom.operators.joins import left_join
from retailloom.operators.staging import stage

DEFAULT_WATERMARK = "1 hour"


def with_event_time(stream: DataFrame, column: str, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Watermark on a zone-free timestamp; Spark only takes zoned ones as event time."""
    return stream.withColumn("event_time", F.col(column).cast("timestamp")).withWatermark("event_time", watermark)


def dedup_stream(stream: DataFrame, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """First occurrence of each (partition, offset); state is kept for the watermark only."""
    timed = with_event_time(stream, "ingested_at", watermark)
    return timed.dropDuplicatesWithinWatermark(["kafka_partition", "kafka_offset"]).drop("event_time")


def realtime_fact(stream: DataFrame) -> DataFrame:
    """Staging and the realtime fact, the same functions as in batch."""
    return fct_sales_realtime(stage(stream, "stg_stream_sales"))


def minute_partials(stream: DataFrame, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Per minute and partition: events and latency sums, the state behind every trailing window.

    State grows with minutes times partitions, not with events, and events are
    reduced inside each task before they reach it.
    """
    millis = boundary_diff("millisecond", F.col("event_ts"), F.col("ingested_at"))
    return (
        with_event_time(stream, "ingested_at", watermark)
        .groupBy(F.window("event_time", "1 minute").alias("w"), "kafka_partition")
        .agg(F.count(F.lit(1)).alias("events"), F.sum(millis).alias("sum_ms"), F.max(millis).alias("max_ms"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("minute"), "kafka_partition", "events", "sum_ms", "max_ms"
        )
    )


def latest_partials(updates: DataFrame) -> DataFrame:
    """The last state of every minute and partition, from updates written per ``batch``."""
    values = ["events", "sum_ms", "max_ms"]
    latest = updates.groupBy("minute", "kafka_partition").agg(F.max(F.struct("batch", *values)).alias("last"))
    return latest.select("minute", "kafka_partition", *(F.col(f"last.{v}").alias(v) for v in values))


def trailing_windows(partials: DataFrame, minutes: int = 15) -> DataFrame:
    """Throughput and latency of the trailing ``minutes`` for every minute with such a window.

    Only the minute partials are repeated into the windows covering them.
    """
    last = F.explode(F.sequence(F.lit(1), F.lit(minutes))).alias("ahead")
    spread = partials.select("*", last).withColumn(
        "window_end", F.col("minute") + F.make_dt_interval(mins=F.col("ahead"))
    )
    return spread.groupBy("window_end").agg(
        F.sum("events").alias("events"),
        F.round(F.sum("sum_ms") / F.sum("events") / 1000, 3).alias("avg_latency_seconds"),
        F.round(F.max("max_ms") / 1000, 3).alias("max_latency_seconds"),
        F.count_distinct("kafka_partition").alias("active_partitions"),
    )


#: The id of an event that only tells the time: an idle source sends one so that windows close. It is counted nowhere.
HEARTBEAT = "<heartbeat>"


def throughput_windows(stream: DataFrame, minutes: int = 15, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Throughput and latency of the trailing ``minutes`` ending at every minute, all within the stream; for append mode.

    Two chained aggregates: minutes per partition, then sliding windows over the
    minutes. Both keep only what the watermark has not passed, so state grows with minutes times
    partitions and not with events. A window is told once, when the watermark passes its end;
    events later than the watermark are left out of it.
    """
    millis = boundary_diff("millisecond", F.col("event_ts"), F.col("ingested_at"))
    # The condition names the event time, so that it is not moved ahead of the watermark, which heartbeats must reach.
    counted = (F.col("event_id") != HEARTBEAT) | F.col("event_time").isNull()
    timed = with_event_time(stream, "ingested_at", watermark).where(counted)
    per_minute = timed.groupBy(F.window("event_time", "1 minute").alias("w"), "kafka_partition").agg(
        F.count(F.lit(1)).alias("events"), F.sum(millis).alias("sum_ms"), F.max(millis).alias("max_ms"))
    trailing = F.window(F.window_time("w"), f"{minutes} minutes", "1 minute").alias("t")
    return per_minute.groupBy(trailing).agg(
        F.sum("events").alias("events"),
        F.round(F.sum("sum_ms") / F.sum("events") / 1000, 3).alias("avg_latency_seconds"),
        F.round(F.max("max_ms") / 1000, 3).alias("max_latency_seconds"),
        F.size(F.collect_set("kafka_partition")).cast("long").alias("active_partitions"),
    ).select(F.col("t.end").cast("timestamp_ntz").alias("window_end"), "events", "avg_latency_seconds", "max_latency_seconds", "active_partitions")


def enrich_batches(
    fact: DataFrame, dimensions: Callable[[], Mapping[str, DataFrame]], target: str, checkpoint: str,
    hot: Mapping[str, list] | None = None, columns: list[str] | None = None, interval: str | None = None,
) -> StreamingQuery:
    """Enrich a streaming fact with the dimensions as they are when each micro-batch begins.

    ``dimensions`` gives the three tables by name and is asked once per batch, so a
    stream that runs for weeks sees every refresh. A batch is written to a folder of its own,
    which a retry replaces. Joins of a batch are split at run time where a key is crowded.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        now = dimensions()
        rows = enrich(batch, now["dim_customer"], now["dim_product"], now["dim_store"], hot)
        rows.select(*(columns or rows.columns)).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    writer = fact.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def enrich(
    fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_store: DataFrame, hot: Mapping[str, list] | None = None
) -> DataFrame:
    """The realtime fact with its dimensions' attributes; also for a streaming fact.

    ``hot`` lists, by key column, the values that hold much of the events (see
    ``heavy_keys``): a stream's joins are not split at run time, so those are salted.
    """
    hot = hot or {}
    for key, dimension, columns in (
        ("store_sk", dim_store, ["store_name", "region"]),
        ("product_sk", dim_product, ["brand", "category"]),
        ("customer_sk", dim_customer, ["value_tier", "segment"]),
    ):
        fact = left_join(fact, dimension.select(key, *columns), key, hot.get(key))
    return fact
