"""Time the headline work over the tables in $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from retailloom.operators import facts, history, quality, reports  # noqa: E402
from retailloom.plans import checks, registry, serving  # noqa: E402
from retailloom.plans.warehouse import warehouse_for  # noqa: E402
from retailloom.schemas import RAW_TABLES, raw_table  # noqa: E402
from retailloom.session import local_session, scratch_path  # noqa: E402
from retailloom.sources import ndjson, topics, writers  # noqa: E402
from retailloom.streaming import events, landing  # noqa: E402


def drain(df) -> None:
    """Run a query completely without bringing its rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    spark = local_session(cpus, shuffle_partitions=2 * cpus)
    wh = warehouse_for(spark, sf_dir, registry.AS_OF)
    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()  # JVM and codegen warm-up
    timed("land_raw_tables", lambda: wh.build(RAW_TABLES))
    timed("build_star", lambda: wh.build(wh.MARTS))
    timed("all_110_checks", lambda: quality.run_checks(spark, wh.table, checks.ALL_CHECKS).collect())
    timed("validation_reports", lambda: [
        reports.freshness_report(wh.table, checks.FRESHNESS_SLA, registry.AS_OF).collect(),
        reports.referential_integrity_report(wh.table, checks.REFERENCES).collect(),
        reports.row_count_report(spark, wh.table, checks.ROW_BOUNDS).collect(),
    ])
    timed("scd2_customers", lambda: registry.customer_history(wh))
    timed("point_in_time_sales", lambda: drain(
        history.point_in_time(wh.mart("fact_sales"), registry.customer_history(wh), "sale_date")))
    timed("fact_sales", lambda: drain(facts.fact_sales(wh.staged("stg_sales"), wh.staged("stg_returns"))))
    timed("fact_returns", lambda: drain(facts.fact_returns(wh.staged("stg_returns"), wh.staged("stg_sales"))))

    fact, store, product = wh.mart("fact_sales"), wh.mart("dim_store"), wh.mart("dim_product")
    for name, query in {
        "kpi_sales": serving.kpi_sales(fact),
        "revenue_by_channel": serving.revenue_by_channel(fact),
        "revenue_by_store_country": serving.revenue_by_store_country(fact, store),
        "monthly_revenue": serving.monthly_revenue(fact),
        "top_brands": serving.top_brands(fact, product),
        "value_tiers": serving.value_tiers(wh.mart("dim_customer")),
    }.items():
        timed(name, query.collect)

    # Loads: NDJSON into typed Parquet, strictly and by column name.
    sales_json, suppliers_json = scratch_path(spark, "sales-ndjson"), scratch_path(spark, "customers-ndjson")
    sales = wh.raw("sales").select(*(c.name for c in raw_table("sales").on_the_wire))
    ndjson.write_ndjson(sales, sales_json)
    ndjson.write_ndjson(wh.raw("customers"), suppliers_json)
    strict_rows = timed("load_ndjson_strict", lambda: writers.load_replace(
        ndjson.read_ndjson(spark, sales_json, "sales", "strict", registry.LOADED_AT, registry.WIDE_IDS), scratch_path(spark, "sales")))
    append_rows = timed("load_ndjson_append", lambda: writers.load_append(
        ndjson.read_ndjson(spark, suppliers_json, "customers", "strict"), scratch_path(spark, "customers"), raw_table("customers").schema))

    # Stream: land every event once, then lose the checkpoint and replay it all.
    topic, target = scratch_path(spark, "topic"), scratch_path(spark, "landing")
    stream = wh.raw("stream_sales")
    events.publish(stream, 3, partition=F.col("kafka_partition"), offset=F.col("kafka_offset")).write.parquet(topic)

    def land():
        landing.land_stream(topics.read_record_files(spark, topic), target, scratch_path(spark, "checkpoint")).awaitTermination()

    timed("stream_landing", land)
    timed("stream_replay", land)
    duplicates = reports.stream_exactly_once_report(landing.landed(spark, target)).first().offending_groups

    n_sales = wh.staged("stg_sales").count()
    build = seconds["build_star"] + seconds["all_110_checks"]
    print(json.dumps({
        "metric": "retail star schema, checks, history, loads and stream",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "staged_sales": n_sales,
        "build_and_checks_sec_per_100k_sales": round(build / n_sales * 100_000, 3),
        "strict_load_rows_per_sec": round(strict_rows / seconds["load_ndjson_strict"]),
        "append_load_rows_per_sec": round(append_rows / seconds["load_ndjson_append"]),
        "stream_events_per_sec": round(stream.count() / seconds["stream_landing"]),
        "duplicates_after_replay": duplicates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
