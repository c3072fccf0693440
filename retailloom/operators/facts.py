"""Fact tables. Dimension keys are hashed from natural keys, never looked up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.functions import date_key, percent_of, surrogate_key
from retailloom.operators.joins import left_join, per_key


def returns_agg(returns: DataFrame, statuses: list[str] | None = None, dealt_by: str | None = None) -> DataFrame:
    """Return count and refunds per sale, and per ``dealt_by`` if given. All statuses count unless some are named."""
    if statuses is not None:
        returns = returns.where(F.col("status").isin(statuses))
    sums = F.count(F.lit(1)).alias("return_count"), F.sum("refund_amount").alias("total_refund_amount")
    return returns.groupBy(dealt_by, "sale_id").agg(*sums) if dealt_by else per_key(returns, "sale_id", *sums)


def fact_sales(sales: DataFrame, returns: DataFrame, statuses: list[str] | None = None, dealt_by: str | None = None) -> DataFrame:
    """One row per sale, net of its returns."""
    return fact_sales_rows(sales, returns, statuses, dealt_by).select(*fact_sales_columns())


def fact_sales_rows(sales: DataFrame, returns: DataFrame, statuses: list[str] | None = None, dealt_by: str | None = None) -> DataFrame:
    """Sales with the sums of their returns, before keys are hashed.

    The many side is aggregated first, so the join cannot multiply sales.
    ``dealt_by`` names a column of both by which their rows are dealt to tasks already, and which is
    equal and not NULL wherever sale ids are equal: they are then joined where they are, without another shuffle.
    """
    needed = [c for c in sales.columns if c != "product_name"]
    on = [dealt_by, "sale_id"] if dealt_by else "sale_id"
    return sales.select(*needed).join(returns_agg(returns, statuses, dealt_by), on, "left").drop(*[dealt_by] * bool(dealt_by))


def fact_sales_columns() -> list[Column | str]:
    returned = F.coalesce("return_count", F.lit(0))
    refunded = F.coalesce("total_refund_amount", F.lit(0))
    return [
        surrogate_key("sale_id").alias("sale_sk"),
        "sale_id",
        date_key(F.col("sale_date")).alias("date_sk"),
        surrogate_key("customer_id").alias("customer_sk"),
        surrogate_key("product_id").alias("product_sk"),
        surrogate_key("store_id").alias("store_sk"),
        "sale_date", "customer_id", "product_id", "store_id", "channel", "country",
        "quantity", "unit_price",
        F.col("total_amount").alias("gross_amount"),
        returned.alias("return_count"),
        refunded.alias("refund_amount"),
        (F.col("total_amount") - refunded).alias("net_amount"),
        (returned > 0).alias("has_return"),
        "ingested_at",
    ]


#: The columns of the sales fact that hang on returns; all others are known from the sale alone.
OF_RETURNS = ("return_count", "refund_amount", "net_amount", "has_return")


def fact_sales_apart(sales: DataFrame) -> DataFrame:
    """The sales fact without what hangs on returns, and so without the join.

    Returns are joined as one row per sale, so they neither add nor drop a sale.
    """
    unknown = {"return_count": F.lit(0), "total_refund_amount": F.lit(0)}
    return sales.withColumns(unknown).select(*fact_sales_columns()).drop(*OF_RETURNS)


def fact_returns(returns: DataFrame, sales: DataFrame, hot_sales: list[str] | None = None) -> DataFrame:
    """One row per return with its sale's context; orphans keep NULL sale columns.

    ``hot_sales`` names sale ids holding an outsized share of the returns, see
    :func:`retailloom.operators.joins.heavy_keys`.
    """
    return fact_returns_rows(returns, sales, hot_sales).select(*fact_returns_columns())


def fact_returns_rows(returns: DataFrame, sales: DataFrame, hot_sales: list[str] | None = None) -> DataFrame:
    """Returns with their sale's context, before keys are hashed."""
    sale_context = sales.select(
        "sale_id", "sale_date", "store_id", "channel", F.col("total_amount").alias("original_sale_amount")
    )
    return left_join(returns.drop("processed_by"), sale_context, "sale_id", hot_sales)


def fact_returns_columns() -> list[Column | str]:
    return [
        surrogate_key("return_id").alias("return_sk"),
        "return_id",
        "sale_id",
        surrogate_key("sale_id").alias("sale_sk"),
        date_key(F.col("return_date")).alias("date_sk"),
        surrogate_key("customer_id").alias("customer_sk"),
        surrogate_key("product_id").alias("product_sk"),
        surrogate_key("store_id").alias("store_sk"),
        "return_date", "sale_date",
        F.datediff("return_date", "sale_date").alias("days_to_return"),
        "customer_id", "product_id", "store_id", "channel",
        "return_reason", "item_condition", "status", "refund_method", "refund_amount",
        "original_sale_amount",
        percent_of(F.col("refund_amount"), F.col("original_sale_amount")).alias("refund_pct"),
        "notes", "ingested_at",
    ]


def fct_sales_realtime(stream: DataFrame) -> DataFrame:
    """One row per streamed sale; a pure projection, so it also runs on a stream."""
    return stream.select(*fct_sales_realtime_columns())


def fct_sales_realtime_columns() -> list[Column | str]:
    return [
        surrogate_key("event_id").alias("event_sk"),
        "event_id", "sale_id",
        date_key(F.col("sale_date")).alias("date_sk"),
        surrogate_key("customer_id").alias("customer_sk"),
        surrogate_key("product_id").alias("product_sk"),
        surrogate_key("store_id").alias("store_sk"),
        "event_ts", "sale_date", "customer_id", "product_id", "store_id", "channel", "country",
        "quantity", "unit_price",
        F.col("total_amount").alias("gross_amount"),
        "kafka_partition", "kafka_offset", "ingested_at", "latency_seconds",
    ]


def stamp_build(mart: DataFrame) -> DataFrame:
    """Add the build time; kept out of the marts themselves so they stay reproducible."""
    return mart.withColumn("loaded_at", F.current_timestamp())
