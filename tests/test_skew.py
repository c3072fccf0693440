"""One key holding a third of the rows or more: same results, split work."""

import pytest
from pyspark.sql import functions as F
from rows import plan_of

from retailloom.operators import dimensions, facts, history, joins, quality
from retailloom.sources import writers

N = 30_000


@pytest.fixture
def hot(spark):
    """Half of the rows belong to one key, many as exact copies."""
    ids = spark.range(0, N, 1, 6)
    return ids.select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("k"),
                      (F.col("id") % 10).alias("v"))


@pytest.fixture
def parents(spark):
    return spark.range(0, 900).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("p")).unionByName(
        spark.createDataFrame([("hot", -1), ("hot", -2)], "k string, p long"))


def test_heavy_keys_are_found_and_bounded(hot):
    assert joins.heavy_keys(hot, "k") == ["hot"]
    assert joins.heavy_keys(hot.where("k <> 'hot'"), "k") == []


def test_salted_join_equals_plain_join(hot, parents):
    plain, salted = joins.left_join(hot, parents, "k"), joins.left_join(hot, parents, "k", ["hot"])
    assert plain.columns == salted.columns
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_salt_spreads_exact_copies(spark, hot, parents):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        # Copies of one row differ in nothing but the task they are in.
        copies = spark.range(0, N, 1, 6).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
        salts = copies.select(F.pmod(F.xxhash64("k", "v") + F.spark_partition_id(), F.lit(joins.SALT_BUCKETS)).alias("s"))
        assert salts.distinct().count() == 6
        assert joins.left_join(copies, parents, "k", ["hot"]).count() == 2 * N
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def eager_splitting(spark):
    """Thresholds scaled down to the test data; no side is small enough to broadcast."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k in small:
        spark.conf.unset(k)


def executed_plan(df):
    df.collect()
    return plan_of(df)


def test_adaptive_execution_splits_a_plain_skewed_join(eager_splitting, hot, parents):
    assert "skewed" in executed_plan(joins.left_join(hot, parents, "k"))


def sales_of(spark, **columns):
    """Stored sales, half of them sharing the values in ``columns``."""
    hot = F.col("id") % 2 == 0
    base = spark.range(0, N, 1, 6).select(
        F.concat(F.lit("S"), "id").alias("sale_id"), F.concat(F.lit("C"), F.col("id") % 500).alias("customer_id"), F.lit("P1").alias("product_id"),
        F.lit("ST1").alias("store_id"), F.lit("online").alias("channel"), F.lit("France").alias("country"),
        F.lit("2024-01-01").cast("date").alias("sale_date"), F.lit(1).alias("quantity"), F.lit(10).cast("decimal(10,2)").alias("unit_price"),
        F.lit(10).cast("decimal(10,2)").alias("total_amount"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ingested_at"), "id")
    return base.withColumns({c: F.when(hot, F.lit(v)).otherwise(F.col(c)) for c, v in columns.items()}).drop("id")


def test_fact_sales_splits_a_repeated_sale(spark, eager_splitting):
    returns = spark.range(2000).select(F.concat(F.lit("S"), F.col("id") * 2 + 1).alias("sale_id"), F.lit(1).cast("decimal(10,2)").alias("refund_amount"))
    fact = facts.fact_sales(sales_of(spark, sale_id="S1"), returns)
    assert "skewed" in executed_plan(fact)
    assert fact.count() == N and fact.where("sale_id = 'S1'").agg(F.sum("return_count")).first()[0] == N / 2 + 1


def test_point_in_time_splits_a_hot_customer(spark, eager_splitting, path):
    customers = spark.range(500).select(*(F.concat(F.lit("C"), "id").alias(c) if c == "customer_id" else F.lit(None).cast("string").alias(c)
                                          for c in history.CUSTOMER_COLUMNS))
    history.record_snapshot(spark, path("history"), customers, "2023-01-01 00:00:00")
    joined = history.point_in_time(sales_of(spark, customer_id="C7"), history.read_history(spark, path("history"), history.history_schema(types=customers.schema)), "sale_date")
    assert "skewed" in executed_plan(joined)
    assert joined.count() == N


def test_customer_aggregate_of_a_hot_customer(spark):
    got = {r.customer_id: r for r in dimensions.customer_sales_agg(sales_of(spark, customer_id="C7")).collect()}
    assert got["C7"].observed_orders == N / 2 + N / 500 and sum(r.observed_orders for r in got.values()) == N


def test_orphans_are_counted_after_reducing_to_keys(hot, parents):
    counted = joins.orphan_counts(hot, "k", parents.where("k <> 'hot'"), "k", nulls_are_orphans=True)
    assert counted.first().offending_rows == hot.join(parents.where("k <> 'hot'"), "k", "left_anti").count() > N / 2
    plan = plan_of(counted)
    assert plan.index("partial_count") > 0


def test_duplicate_check_on_a_hot_value(spark, hot):
    row = quality.run_checks(spark, lambda _: hot, quality.unique("t", "k")).first()
    assert row.failing_rows == hot.groupBy("k").count().where("count > 1").count()


def test_latest_per_key_needs_no_window(hot):
    latest = writers.latest_per_key(hot, "k", "v")
    assert "Window" not in plan_of(latest)
    assert latest.count() == hot.select("k").distinct().count()
    assert latest.where("k = 'hot'").first().v == 8


def test_a_crowded_day_is_cut_into_several_files(spark, path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(0, 40_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 != 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date").alias("day"), F.md5(F.col("id").cast("string")).alias("pad"))
        assert writers.write_clustered(rows, path("clustered"), "day") == 40_000
        back = spark.read.parquet(path("clustered"))
        assert back.count() == 40_000
        assert back.where("day = '2024-01-01'").select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
