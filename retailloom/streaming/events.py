"""Sales events on the wire: publishing them and reading them back as typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.schemas import STREAM_SALES
from retailloom.sources.ndjson import LINE, REASON, classify_lines

# Fixed value: event times travel as ISO-8601 in UTC.
WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
EVENT_FIELDS = [c.name for c in STREAM_SALES.on_the_wire]


def publish(
    events: DataFrame, n_partitions: int, key: str = "store_id", partition: Column | None = None, offset: Column | None = None
) -> DataFrame:
    """Keyed records of the events: JSON value, and a partition that is a function of the key.

    A projection without a shuffle. A topic assigns partition and offset by
    itself from the key; records kept as files carry both.
    """
    by_key = F.pmod(F.xxhash64(key), F.lit(n_partitions)).cast("int")
    value = F.to_json(F.struct(*EVENT_FIELDS), {"ignoreNullFields": "false", "timestampNTZFormat": WIRE_TIME})
    return events.select(
        F.col(key).alias("key"),
        value.alias("value"),
        (by_key if partition is None else partition).alias("partition"),
        (F.lit(None) if offset is None else offset).cast("long").alias("offset"),
    )


def parse_events(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Typed stream rows with partition, offset and landing time, and why a record is unusable.

    ``raw_line`` and ``reject_reason`` are NULL for usable records. Works on
    batch and streaming input.
    """
    landed = F.current_timestamp().cast("timestamp_ntz") if ingested_at is None else ingested_at
    rows = classify_lines(records, STREAM_SALES, None, carry=("partition", "offset"))
    return rows.select(
        *EVENT_FIELDS,
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        landed.alias("ingested_at"),
        F.when(F.col(REASON).isNotNull(), F.col(LINE)).alias(LINE),
        REASON,
    )


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNull()).select(*STREAM_SALES.column_names)


def print_events(parsed: DataFrame, checkpoint: str):
    """Dry run: print the rows that would land, write nothing but the checkpoint."""
    return (
        usable(parsed).writeStream.format("console").option("truncate", "false")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
