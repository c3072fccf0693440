"""Land a topic exactly once per (partition, offset), across restarts and replays.

A batch is written to a folder of its own below ``target/data`` and becomes part of
the table by one commit to the log (see ``manifest``), which also notes how far its run
has come. A batch that is retried after its commit is left out, and one that
failed before it is written anew; what it had left is never read. Rejected records land in the same commit, next
to the rows, never lost. What a batch has seen of each topic partition, and how long it took, is
stored in files of its own. Small files are merged now and then, old for new in one commit.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from retailloom.schemas import STREAM_SALES
from retailloom.sources.ndjson import LINE, REASON
from retailloom.sources import manifest
from retailloom.streaming.events import parse_events

OFFSET_KEY = ["kafka_partition", "kafka_offset"]
_LANDED = T.StructType([
    *STREAM_SALES.schema, T.StructField(LINE, T.StringType()), T.StructField(REASON, T.StringType()),
    T.StructField("run", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("rejected", T.BooleanType()),
])


def _live(spark: SparkSession, target: str, kind: str, schema: T.StructType) -> DataFrame:
    files = manifest.read_state(spark, target).of(kind)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{target}/{f}" for f in files))


def _everything(spark: SparkSession, target: str) -> DataFrame:
    return _live(spark, target, "rows", _LANDED)


def landed(spark: SparkSession, target: str) -> DataFrame:
    """The landed stream rows."""
    return _everything(spark, target).where(~F.col("rejected")).select(*STREAM_SALES.column_names)


def dead_letters(spark: SparkSession, target: str) -> DataFrame:
    """Records that could not be parsed or lacked fields, with their origin and reason."""
    return _everything(spark, target).where("rejected").select(*OFFSET_KEY, LINE, REASON)


_SEEN = T.StructType([
    T.StructField("kafka_partition", T.IntegerType()), T.StructField("records", T.LongType()), T.StructField("first_offset", T.LongType()),
    T.StructField("last_offset", T.LongType()), T.StructField("run", T.StringType()), T.StructField("batch", T.LongType()),
    T.StructField("started_at", T.TimestampNTZType()), T.StructField("seconds", T.DoubleType()),
])


def seen(spark: SparkSession, target: str) -> DataFrame:
    """Records and offset range that every landed batch took from each topic partition, when it began and how long it took."""
    return _live(spark, target, "seen", _SEEN)


def committed_offsets(spark: SparkSession, target: str) -> DataFrame:
    """Highest landed and highest seen offset, and landed records, per partition.

    The two offsets differ while the last records seen were repeats.
    """
    landed_so_far = _everything(spark, target).groupBy("kafka_partition").agg(
        F.max("kafka_offset").alias("committed_offset"), F.count(F.lit(1)).alias("records")
    )
    reached = seen(spark, target).groupBy("kafka_partition").agg(F.max("last_offset").alias("seen_offset"))
    return landed_so_far.join(reached, "kafka_partition", "left").select("kafka_partition", "committed_offset", "seen_offset", "records")


def resume_offsets(spark: SparkSession, target: str, topic: str) -> str:
    """``startingOffsets`` that continue a topic after what has landed, for a lost checkpoint.

    One row per topic partition reaches the driver.
    """
    rows = committed_offsets(spark, target).collect()
    return json.dumps({topic: {str(r.kafka_partition): r.committed_offset + 1 for r in rows}})


def append_once(
    records: DataFrame,
    batch_id: int,
    target: str,
    run: str,
    ingested_at: Column | None = None,
    against: Column | None = None,
    repeats: bool = True,
) -> None:
    """Write one micro-batch idempotently.

    Without ``repeats`` the batch is known to hold each offset once, as a topic
    guarantees, and is written without a shuffle. ``against`` selects the landed rows this batch may repeat, by ``run`` and
    ``batch``. Repeats are removed by an anti-join on (partition, offset) that
    reads only landed rows within the batch's own offsets of each partition. These
    ranges, one row per topic partition, are also what is kept of the batch as seen.
    """
    spark, started, clock = records.sparkSession, datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()

    def committed(state: manifest.State) -> bool:
        return state.runs.get(run, {}).get("batch", -1) >= batch_id

    if committed(manifest.read_state(spark, target)):
        return
    # Read once for the offset ranges and once to write.
    records = records.persist(StorageLevel.DISK_ONLY)
    try:
        reach = records.groupBy(F.col("partition").cast("int").alias("kafka_partition")).agg(
            F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")).collect()
        parsed = parse_events(records, ingested_at)
        if repeats:
            parsed = parsed.dropDuplicates(OFFSET_KEY)
        if against is not None and reach:
            inside = reduce(lambda a, b: a | b, (
                (F.col("kafka_partition") == r.kafka_partition) & F.col("kafka_offset").between(r.first_offset, r.last_offset) for r in reach))
            earlier = _everything(spark, target).where(against).where(inside).select(*OFFSET_KEY)
            parsed = parsed.join(earlier, OFFSET_KEY, "left_anti")
        rows = parsed.withColumns({"run": F.lit(run), "batch": F.lit(batch_id).cast("long"), "rejected": F.col(REASON).isNotNull()})
        added = {"rows": _written(rows.select(*_LANDED.names), target)}
    finally:
        records.unpersist()
    taken = [(r.kafka_partition, r.records, r.first_offset, r.last_offset, run, batch_id, started, time.monotonic() - clock) for r in reach]
    added["seen"] = _written(spark.createDataFrame(taken, _SEEN).coalesce(1), target) if taken else {}

    def change(state: manifest.State) -> dict | None:
        if committed(state):
            return None
        before = state.runs.get(run, {}).get("records", 0)
        return {"add": added, "runs": {run: {"batch": batch_id, "records": before + sum(r.records for r in reach)}}}

    manifest.commit(spark, target, change)


def _written(df: DataFrame, target: str) -> dict[str, int]:
    """Write to a new folder below ``target/data``; its files, relative to the target, with their sizes."""
    folder = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{target}/{folder}")
    return {f"{folder}/{name}": size for name, size in manifest.listed(df.sparkSession, f"{target}/{folder}").items()}


def compact(spark: SparkSession, target: str, file_bytes: int = 128 << 20, least: int = 2) -> int:
    """Merge files of less than half of ``file_bytes``, rows by offset, old for new in one commit; returns how many went.

    A file is merged only while it is small, so a row is rewritten a few times
    however long the stream runs. Nothing is deleted here: whoever began to read before
    the commit reads on. If another writer has merged any of the same files meanwhile, nothing changes.
    """
    state = manifest.read_state(spark, target)
    add, drop = {}, {}
    for kind, schema, order in (("rows", _LANDED, OFFSET_KEY), ("seen", _SEEN, ["run", "batch"])):
        small = {f: size for f, size in state.files.get(kind, {}).items() if 2 * size < file_bytes}
        if len(small) < max(2, least):
            continue
        files = max(1, math.ceil(sum(small.values()) / file_bytes))
        held = spark.read.schema(schema).parquet(*(f"{target}/{f}" for f in sorted(small)))
        add[kind] = _written(held.coalesce(files).sortWithinPartitions(*order), target)
        drop[kind] = sorted(small)
    if not drop:
        return 0
    gone: list[int] = []

    def change(now: manifest.State) -> dict | None:
        gone[:] = [len(names) for kind, names in drop.items() if set(names) <= set(now.files.get(kind, {}))]
        return {"add": add, "drop": drop} if len(gone) == len(drop) else None

    manifest.commit(spark, target, change)
    return sum(gone) if len(gone) == len(drop) else 0


def clean(spark: SparkSession, target: str, keep_versions: int = 64) -> int:
    """Delete files that were merged away more than ``keep_versions`` commits ago; returns how many."""
    state = manifest.read_state(spark, target)
    old = sorted(f for f, version in state.dropped.items() if version <= state.version - keep_versions)
    if old:
        manifest.delete(spark, target, old)
        manifest.commit(spark, target, lambda _: {"cleaned": old})
    return len(old)


def sweep(spark: SparkSession, target: str, older_than: float = 86_400) -> int:
    """Delete files that no version names and that are older than ``older_than`` seconds: leftovers of writes that never were committed."""
    state = manifest.read_state(spark, target)
    named = {f for files in state.files.values() for f in files} | set(state.dropped)
    old = manifest.listed(spark, f"{target}/data", older_than)
    lost = [f"data/{name}" for name in old if f"data/{name}" not in named]
    manifest.delete(spark, target, lost)
    return len(lost)


def land_stream(
    records: DataFrame,
    target: str,
    checkpoint: str,
    interval: str | None = None,
    ingested_at: Column | None = None,
    guard: str = "runs",
    compact_every: int | None = 32,
) -> StreamingQuery:
    """Start landing; without an ``interval`` it stops after what is available now.

    ``guard`` names what a batch is compared with. ``runs`` covers a lost
    checkpoint over a source that starts again from its beginning; it costs
    nothing while this run is the only one below ``target``. ``all`` also covers
    a source that repeats records within a run. ``none`` is enough for a topic
    started at :func:`resume_offsets`, and then landing needs no shuffle.
    Every ``compact_every`` batches small files are merged and files merged away long before deleted.
    """
    if guard not in ("runs", "all", "none"):
        raise ValueError(f"guard must be runs, all or none, not {guard!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        against = None
        landed_runs = set(manifest.read_state(batch.sparkSession, target).runs)
        if guard == "all" and landed_runs:
            against = (F.col("run") != run) | (F.col("batch") != batch_id)
        elif guard == "runs" and landed_runs - {run}:
            against = F.col("run") != run
        append_once(batch, batch_id, target, run, ingested_at, against, repeats=guard != "none")
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, target)
            clean(batch.sparkSession, target)

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def run_bounded(spark: SparkSession, start: Callable[[], StreamingQuery], target: str, max_records: int, poll_seconds: float = 0.5) -> int:
    """Run until at least ``max_records`` were landed or the source is drained, then stop.

    Whole micro-batches are committed, so nothing consumed is left unflushed. The
    counts are those stored with the batches, so none can be forgotten, and include
    what earlier starts from the same checkpoint landed.
    """
    query, reached = start(), 0
    try:
        while query.isActive and (reached := consumed(spark, target, query.id)) < max_records:
            time.sleep(poll_seconds)
    finally:
        query.stop()
    return max(reached, consumed(spark, target, query.id))


def consumed(spark: SparkSession, target: str, run: str) -> int:
    """Records that all batches of a run took from the topic, as the log says."""
    return manifest.read_state(spark, target).runs.get(run, {}).get("records", 0)


def progress(spark: SparkSession, target: str) -> DataFrame:
    """Per run and micro-batch: records taken, when it began, how long reading and writing took, and records per second."""
    batches = seen(spark, target).groupBy("run", "batch").agg(
        F.sum("records").alias("input_rows"), F.min("started_at").alias("started_at"), F.max("seconds").alias("seconds"))
    return batches.withColumn("rows_per_second", F.round(F.try_divide("input_rows", "seconds"), 1))


def run_progress(spark: SparkSession, target: str) -> DataFrame:
    """Per run: batches, records, and records per second from its first batch's begin to its last one's end."""
    ended = F.unix_micros(F.col("started_at").cast("timestamp")) / 1e6 + F.col("seconds")
    began = F.unix_micros(F.col("started_at").cast("timestamp")) / 1e6
    runs = progress(spark, target).groupBy("run").agg(
        F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"), (F.max(ended) - F.min(began)).alias("seconds"))
    return runs.withColumn("rows_per_second", F.round(F.try_divide("input_rows", "seconds"), 1))
