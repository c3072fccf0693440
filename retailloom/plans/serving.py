"""Dashboard queries over the star schema and the landed stream.

Joins to a dimension happen after the fact has been reduced to one row per
dimension key, so their size follows the dimension, not the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.functions import as_timestamp, boundary_diff
from retailloom.operators.reports import latency_summary


def kpi_sales(fact_sales: DataFrame) -> DataFrame:
    """Sales, revenue, average order value, returns and the return rate in percent."""
    totals = fact_sales.agg(
        F.count(F.lit(1)).alias("sales"),
        F.sum("gross_amount").alias("revenue"),
        F.sum("return_count").alias("returns"),
    )
    average = F.col("revenue").cast("double") / F.nullif(F.col("sales"), F.lit(0))
    rate = F.col("returns") / F.greatest(F.lit(1), F.col("sales")) * 100
    return totals.select("sales", "revenue", average.alias("avg_order_value"), "returns", rate.alias("return_rate"))


def revenue_by_channel(fact_sales: DataFrame) -> DataFrame:
    return fact_sales.groupBy("channel").agg(F.sum("gross_amount").alias("revenue")).orderBy(F.desc("revenue"), "channel")


def revenue_by_store_country(fact_sales: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Revenue by the country of the store, not of the sale."""
    per_store = fact_sales.groupBy("store_sk").agg(F.sum("gross_amount").alias("revenue"))
    return (
        per_store.join(dim_store.select("store_sk", "country"), "store_sk")
        .groupBy("country")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "country")
    )


def monthly_revenue(fact_sales: DataFrame) -> DataFrame:
    return (
        fact_sales.groupBy(F.trunc("sale_date", "month").alias("month"))
        .agg(F.sum("gross_amount").alias("revenue"))
        .orderBy("month")
    )


def top_brands(fact_sales: DataFrame, dim_product: DataFrame, n: int = 10) -> DataFrame:
    per_product = fact_sales.groupBy("product_sk").agg(
        F.sum("gross_amount").alias("revenue"), F.sum("quantity").alias("units")
    )
    return (
        per_product.join(dim_product.select("product_sk", "brand"), "product_sk")
        .groupBy("brand")
        .agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units"))
        .orderBy(F.desc("revenue"), "brand")
        .limit(n)
    )


def value_tiers(dim_customer: DataFrame) -> DataFrame:
    return (
        dim_customer.groupBy("value_tier")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("observed_revenue").alias("revenue"))
        .orderBy(F.desc("customers"), "value_tier")
    )


def stream_kpis(stream: DataFrame, as_of, fresh_seconds: int = 60) -> DataFrame:
    """Events, latency, partitions and whether the last event is recent enough."""
    seconds = F.col("seconds_since_last")
    return (
        stream.agg(*latency_summary(2), F.max("ingested_at").alias("last_ingested"))
        .withColumn("seconds_since_last", boundary_diff("second", F.col("last_ingested"), as_timestamp(as_of)))
        .select(
            "events", "avg_latency_seconds", "max_latency_seconds", "active_partitions", "seconds_since_last",
            freshness_status(seconds, fresh_seconds).alias("freshness_status"),
        )
    )


def freshness_status(seconds, fresh_seconds: int = 60):
    return F.when(seconds <= fresh_seconds, "FRESH").otherwise("STALE")


def events_per_partition(stream: DataFrame) -> DataFrame:
    return stream.groupBy("kafka_partition").agg(F.count(F.lit(1)).alias("events")).orderBy("kafka_partition")


def latest_events(stream: DataFrame, n: int = 20) -> DataFrame:
    return (
        stream.orderBy(F.desc("ingested_at"), "kafka_partition", "kafka_offset")
        .limit(n)
        .select("event_ts", "store_id", "channel", "product_name", "total_amount", "kafka_partition", "kafka_offset")
    )
