import json

import pytest
from pyspark.sql import functions as F
from rows import event, raw

from retailloom.operators.facts import fct_sales_realtime
from retailloom.operators.staging import stage
from retailloom.sources import topics
from retailloom.streaming import events, landing, live


def some_events(spark, n, start=0):
    return raw(spark, "stream_sales", *(
        event(event_id=f"e{i}", store_id=f"ST{i % 5}", kafka_partition=i % 3, kafka_offset=i // 3, ingested_at=f"2025-03-02 10:{i % 60:02d}:01.500")
        for i in range(start, start + n)))


def records(df):
    return events.publish(df, 3, partition=F.col("kafka_partition"), offset=F.col("kafka_offset"))


def land(spark, source, target, checkpoint, **options):
    query = landing.land_stream(topics.read_record_files(spark, source), target, checkpoint, **options)
    query.awaitTermination()
    return query


def pairs(df):
    return sorted((r.kafka_partition, r.kafka_offset) for r in df.collect())


def test_published_value_has_all_fields_and_round_trips(spark):
    df = some_events(spark, 6)
    value = json.loads(records(df).first().value)
    assert list(value) == events.EVENT_FIELDS and len(value) == 13
    assert value["event_ts"] == "2025-03-02T10:00:00.000000+00:00"
    back = events.usable(events.parse_events(records(df), F.col("event_ts") + F.expr("interval 1 second")))
    same = [c for c in df.columns if c != "ingested_at"]
    assert back.select(same).exceptAll(df.select(same)).count() == 0 and back.count() == 6


def test_a_key_stays_on_one_partition_without_a_shuffle(spark):
    published = events.publish(some_events(spark, 30), 3)
    assert published.groupBy("key").agg(F.count_distinct("partition").alias("n")).where("n > 1").count() == 0
    assert "Exchange" not in published._jdf.queryExecution().executedPlan().toString()


def test_event_times_with_offset_are_read(spark):
    value = {f: "1" for f in events.EVENT_FIELDS} | {"event_ts": "2025-03-02T10:00:00+00:00", "sale_date": "2025-03-02"}
    df = spark.createDataFrame([("k", json.dumps(value), 1, 810)], topics.RECORD_SCHEMA)
    row = events.parse_events(df).first()
    assert str(row.event_ts) == "2025-03-02 10:00:00" and (row.kafka_partition, row.kafka_offset) == (1, 810)
    assert row.ingested_at is not None and row.reject_reason is None


def test_restart_with_the_checkpoint_lands_only_news(spark, path):
    source, target, checkpoint = path("topic"), path("landing"), path("checkpoint")
    records(some_events(spark, 90)).write.parquet(source)
    land(spark, source, target, checkpoint)
    records(some_events(spark, 60, start=90)).write.mode("append").parquet(source)
    query = land(spark, source, target, checkpoint)
    assert landing.consumed(spark, target, query.id) == 150
    assert landing.progress(spark, target).where("input_rows = 60").count() == 1
    got = pairs(landing.landed(spark, target))
    assert len(got) == 150 == len(set(got))
    assert {(r.kafka_partition, r.committed_offset, r.seen_offset) for r in landing.committed_offsets(spark, target).collect()} == {(0, 49, 49), (1, 49, 49), (2, 49, 49)}


def test_lost_checkpoint_replays_without_duplicates(spark, path):
    source, target = path("topic"), path("landing")
    records(some_events(spark, 90)).write.parquet(source)
    land(spark, source, target, path("checkpoint1"))
    records(some_events(spark, 30, start=90)).write.mode("append").parquet(source)
    land(spark, source, target, path("checkpoint2"))
    got = pairs(landing.landed(spark, target))
    assert len(got) == 120 == len(set(got))


def test_repeats_within_a_run(spark, path):
    source, target, checkpoint = path("topic"), path("landing"), path("checkpoint")
    records(some_events(spark, 30)).write.parquet(source)
    land(spark, source, target, checkpoint, guard="all")
    records(some_events(spark, 40)).write.mode("append").parquet(source)
    land(spark, source, target, checkpoint, guard="all")
    assert len(pairs(landing.landed(spark, target))) == 40
    with pytest.raises(ValueError):
        land(spark, source, target, checkpoint, guard="some")


def test_a_retried_batch_replaces_itself(spark, path):
    df = records(some_events(spark, 12))
    for _ in range(2):
        landing.append_once(df, 0, path("landing"), "run-a")
    assert landing.landed(spark, path("landing")).count() == 12


def test_resume_offsets_continue_after_what_landed(spark, path):
    landing.append_once(records(some_events(spark, 9)), 0, path("landing"), "run-a")
    assert json.loads(landing.resume_offsets(spark, path("landing"), "sales")) == {"sales": {"0": 3, "1": 3, "2": 3}}


def test_malformed_records_become_dead_letters(spark, path):
    good = records(some_events(spark, 3))
    bad = spark.createDataFrame([("k", "{oops", 0, 100), ("k", None, 1, 101), ("k", '{"event_id": "x"}', 2, 102)], topics.RECORD_SCHEMA)
    good.unionByName(bad).write.parquet(path("topic"))
    land(spark, path("topic"), path("landing"), path("checkpoint"))
    assert landing.landed(spark, path("landing")).count() == 3
    dead = {r.kafka_offset: r for r in landing.dead_letters(spark, path("landing")).collect()}
    assert dead[100].reject_reason == "malformed" and dead[100].raw_line == "{oops"
    assert dead[101].reject_reason == "malformed" and dead[102].reject_reason.startswith("missing:sale_id")


def test_bounded_run_and_progress(spark, path):
    for start in range(0, 40, 10):
        records(some_events(spark, 10, start=start)).coalesce(1).write.mode("append").parquet(path("topic"))

    def start():
        return landing.land_stream(topics.read_record_files(spark, path("topic"), 1), path("landing"), path("checkpoint"), interval="0 seconds")

    reached = landing.run_bounded(spark, start, path("landing"), 20, 0.1)
    assert reached >= 20 and landing.landed(spark, path("landing")).count() >= 20
    assert landing.progress(spark, path("landing")).agg(F.sum("input_rows")).first()[0] == landing.landed(spark, path("landing")).count()


def test_counts_outlive_the_retained_reports(spark, path):
    one = records(some_events(spark, 1)).collect()[0]
    for batch in range(104):  # Spark retains 100 reports
        landing.append_once(spark.createDataFrame([(*one[:3], batch)], topics.RECORD_SCHEMA), batch, path("landing"), "run-a", repeats=False)
    assert landing.consumed(spark, path("landing"), "run-a") == 104 == landing.progress(spark, path("landing")).count()


def test_repeats_are_seen_but_not_landed(spark, path):
    df = records(some_events(spark, 6))
    landing.append_once(df, 0, path("landing"), "run-a")
    landing.append_once(df, 0, path("landing"), "run-b", against=F.col("run") != "run-b")
    assert landing.landed(spark, path("landing")).count() == 6
    assert landing.consumed(spark, path("landing"), "run-b") == 6


def test_landing_an_empty_target_reads_as_empty(spark, path):
    assert landing.landed(spark, path("nothing")).count() == 0
    assert landing.dead_letters(spark, path("nothing")).count() == 0


def run_to_files(spark, df, out, checkpoint):
    query = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def test_watermark_dedup_across_restarts(spark, path):
    rows = some_events(spark, 60)
    rows.write.parquet(path("stream"))
    for _ in range(2):
        stream = spark.readStream.schema(rows.schema).parquet(path("stream"))
        out = run_to_files(spark, live.dedup_stream(stream, "2 hours"), path("out"), path("checkpoint"))
        rows.limit(20).write.mode("append").parquet(path("stream"))
    got = pairs(out)
    assert len(got) == 60 == len(set(got))


def test_streaming_fact_equals_batch_fact(spark, path):
    rows = some_events(spark, 30).unionByName(raw(spark, "stream_sales", event(event_id="zero", quantity=0)))
    rows.write.parquet(path("stream"))
    fact = live.realtime_fact(spark.readStream.schema(rows.schema).parquet(path("stream")))
    streamed = run_to_files(spark, fact, path("out"), path("checkpoint"))
    batch = fct_sales_realtime(stage(rows, "stg_stream_sales"))
    assert streamed.exceptAll(batch).count() == 0 and streamed.count() == batch.count() == 30


def test_late_events_beyond_the_watermark_are_dropped_from_live_metrics_only(spark, path):
    rows = some_events(spark, 60)
    rows.coalesce(1).write.parquet(path("stream"))

    def minutes():
        stream = spark.readStream.schema(rows.schema).parquet(path("stream"))
        return run_to_files(spark, live.minute_partials(stream, "5 minutes"), path("out"), path("checkpoint"))

    first = minutes().count()
    raw(spark, "stream_sales", event(event_id="late", ingested_at="2025-03-02 01:00:00")).write.mode("append").parquet(path("stream"))
    assert minutes().where("minute < '2025-03-02 09:00:00'").count() == 0 and first > 0


def test_trailing_windows_from_partials(spark):
    partials = spark.createDataFrame(
        [("2025-03-02 10:00:00", 0, 2, 3000, 2000), ("2025-03-02 10:01:00", 1, 1, 600, 600)],
        "minute string, kafka_partition int, events long, sum_ms long, max_ms long",
    ).withColumn("minute", F.col("minute").cast("timestamp_ntz"))
    got = {str(r.window_end): r for r in live.trailing_windows(partials, 2).collect()}
    assert {k: (r.events, r.avg_latency_seconds, r.active_partitions) for k, r in got.items()} == {
        "2025-03-02 10:01:00": (2, 1.5, 1), "2025-03-02 10:02:00": (3, 1.2, 2), "2025-03-02 10:03:00": (1, 0.6, 1)}


def test_enrichment_keeps_unmatched_events(spark):
    fact = fct_sales_realtime(stage(some_events(spark, 3), "stg_stream_sales"))
    none = "string"
    enriched = live.enrich(
        fact, spark.createDataFrame([], f"customer_sk {none}, value_tier {none}, segment {none}"),
        spark.createDataFrame([], f"product_sk {none}, brand {none}, category {none}"),
        fact.select("store_sk", F.lit("Maison").alias("store_name"), F.lit("Europe").alias("region")).limit(1))
    assert enriched.count() == 3 and enriched.where("store_name = 'Maison'").count() == 1


def windows_of(spark, path, rounds):
    """What the stream itself tells after each round of new events, 5 minutes of lateness allowed."""
    out, told = path("windows"), []
    for rows in rounds:
        rows.coalesce(1).write.mode("append").parquet(path("stream"))
        stream = spark.readStream.schema(rows.schema).parquet(path("stream"))
        told.append({str(r.window_end)[11:16]: (r.events, r.active_partitions) for r in run_to_files(spark, live.throughput_windows(stream, 2, "5 minutes"), out, path("checkpoint")).collect()})
    return told


def test_windows_close_with_the_watermark_and_late_events_stay_out(spark, path):
    def at(*times, **fields):
        return raw(spark, "stream_sales", *(event(event_id=fields.get("id", f"e{t}{i}"), kafka_partition=i % 2, ingested_at=f"2025-03-02 {t}") for i, t in enumerate(times)))

    first, second, third = windows_of(spark, path, [
        at("10:00:10", "10:00:20", "10:01:30", "10:09:00"),
        at("10:00:30", "10:06:10", "10:30:00"),  # the first one is too late, the second within the watermark
        at("12:00:00", id=live.HEARTBEAT),
    ])
    assert first == {"10:01": (2, 2), "10:02": (3, 2), "10:03": (1, 1)}
    # 10:04 to 10:06 are idle; the minute of 10:06 came late enough to be told after the first round.
    assert second == first | {"10:07": (1, 1), "10:08": (1, 1), "10:10": (1, 1), "10:11": (1, 1)}
    assert third == second | {"10:31": (1, 1), "10:32": (1, 1)}


def test_state_of_the_windows_is_bounded_by_the_watermark(spark, path):
    many = spark.range(4000).selectExpr("concat('e', id) as event_id", "cast(id % 3 as int) as kafka_partition", "id")
    start = raw(spark, "stream_sales", event())
    moved = start.drop("event_id", "kafka_partition", "ingested_at").crossJoin(many).withColumn(
        "ingested_at", F.expr("timestamp_ntz'2025-03-02 00:00:00' + make_dt_interval(0, 0, 0, id * 15)")).select(*start.columns)
    for n in range(4):
        moved.where(f"event_id in (select concat('e', id) from range({n * 1000}, {n * 1000 + 1000}))").coalesce(1).write.mode("append").parquet(path("stream"))
        stream = spark.readStream.schema(start.schema).parquet(path("stream"))
        query = live.throughput_windows(stream, 15, "5 minutes").writeStream.format("parquet").option("path", path("out")).option(
            "checkpointLocation", path("checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
        held = sum(o["numRowsTotal"] for o in query.recentProgress[-1]["stateOperators"])
        assert held < 3 * (5 + 2) + 15 + 5 + 2 + 10


def test_each_batch_is_enriched_with_the_newest_dimensions(spark, path):
    rows = some_events(spark, 20)
    fact = fct_sales_realtime(stage(rows, "stg_stream_sales"))
    none = "string"
    customers = spark.createDataFrame([], f"customer_sk {none}, value_tier {none}, segment {none}")
    products = spark.createDataFrame([], f"product_sk {none}, brand {none}, category {none}")

    def stores(name):
        fact.select("store_sk", F.lit(name).alias("store_name"), F.lit("Europe").alias("region")).distinct().write.mode("overwrite").parquet(path(f"stores-{name}"))
        return path(f"stores-{name}")

    newest = [stores("old")]
    for start in (0, 10):
        rows.where(f"cast(substr(event_id, 2) as int) between {start} and {start + 9}").coalesce(1).write.mode("append").parquet(path("stream"))
    asked = []

    def dimensions():
        asked.append(newest[-1])
        found = spark.read.parquet(newest[-1])
        if len(newest) == 1:
            newest.append(stores("new"))  # replaced while the stream runs
        return {"dim_customer": customers, "dim_product": products, "dim_store": found}

    stream = live.realtime_fact(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path("stream")))
    live.enrich_batches(stream, dimensions, path("out"), path("checkpoint")).awaitTermination()
    assert len(asked) == 2
    got = {(r.batch, r.store_name): r["count"] for r in spark.read.parquet(path("out")).groupBy("batch", "store_name").count().collect()}
    assert got == {(0, "old"): 10, (1, "new"): 10}


def test_dry_run_prints_and_stops(spark, path):
    records(some_events(spark, 3)).write.parquet(path("topic"))
    query = events.print_events(events.parse_events(topics.read_record_files(spark, path("topic"))), path("checkpoint"))
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3


def test_topic_source_needs_the_connector(spark):
    try:
        df = topics.read_topic(spark, "localhost:1", "sales", max_per_trigger=100)
    except Exception as e:
        assert "kafka" in str(e).lower()
    else:
        assert df.isStreaming and df.columns == ["key", "value", "partition", "offset"]
