"""Conformed dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.functions import (
    as_timestamp,
    boundary_diff,
    date_key,
    percent_of,
    region_of,
    surrogate_key,
    value_tier,
)
from retailloom.functions.measures import STORE_REGIONS
from retailloom.operators.joins import per_key


def customer_sales_agg(sales: DataFrame) -> DataFrame:
    """Observed behaviour per customer, one row each.

    Only algebraic aggregates: every task reduces its own rows before the
    shuffle, so a customer owning a third of all sales costs each task one row
    per active month.
    """
    monthly = sales.groupBy("customer_id", F.trunc("sale_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_amount").alias("revenue"),
        F.min("sale_date").alias("first_day"),
        F.max("sale_date").alias("last_day"),
    )
    return per_key(
        monthly,
        "customer_id",
        F.sum("orders").alias("observed_orders"),
        F.sum("revenue").alias("observed_revenue"),
        F.min("first_day").alias("first_order_date"),
        F.max("last_day").alias("last_order_date"),
        F.count("month").alias("active_months"),
    )


def dim_customer(customers: DataFrame, sales: DataFrame, as_of) -> DataFrame:
    """One row per customer with sales-derived attributes, also for those without sales."""
    return customers.join(customer_sales_agg(sales), "customer_id", "left").select(
        surrogate_key("customer_id").alias("customer_sk"),
        "customer_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "phone",
        "date_of_birth",
        boundary_diff("year", F.col("date_of_birth"), as_timestamp(as_of)).alias("age"),
        "gender",
        "segment",
        "preferred_channel",
        "marketing_consent",
        "registration_date",
        "last_purchase_date",
        F.col("total_orders").alias("crm_orders"),
        F.col("lifetime_value").alias("crm_lifetime_value"),
        F.coalesce("observed_orders", F.lit(0)).alias("observed_orders"),
        F.coalesce("observed_revenue", F.lit(0)).alias("observed_revenue"),
        "first_order_date",
        "last_order_date",
        "active_months",
        value_tier(F.col("observed_revenue"), F.col("observed_orders")).alias("value_tier"),
    )


def dim_product(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Products with their supplier's attributes; products without one keep NULLs."""
    supplier_attributes = suppliers.select(
        "supplier_id",
        "supplier_name",
        F.col("specialty").alias("supplier_specialty"),
        F.col("quality_rating").alias("supplier_quality_rating"),
        F.col("lead_time_days").alias("supplier_lead_time_days"),
    )
    return products.join(supplier_attributes, "supplier_id", "left").select(
        surrogate_key("product_id").alias("product_sk"),
        "product_id", "product_name", "category", "subcategory", "brand", "material", "color", "sku",
        "price", "cost", "gross_margin",
        percent_of(F.col("gross_margin"), F.col("price")).alias("margin_pct"),
        "weight_kg", "dimensions_cm",
        "supplier_id", "supplier_name", "supplier_specialty", "supplier_quality_rating", "supplier_lead_time_days",
        "created_date", "last_updated", "is_active",
    )


def dim_store(stores: DataFrame, as_of, regions: Mapping[str, str] = STORE_REGIONS) -> DataFrame:
    return stores.select(
        surrogate_key("store_id").alias("store_sk"),
        "store_id", "store_name", "manager_name", "address", "city", "country",
        region_of(F.col("country"), regions).alias("region"),
        "phone", "email", "opening_date",
        boundary_diff("year", F.col("opening_date"), as_timestamp(as_of)).alias("years_open"),
        "store_size_sqm", "is_active",
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar days from ``start_date`` up to but excluding ``end_date``.

    ``bounds`` has one row with those two dates, given or derived from the facts.
    """
    days = bounds.where("start_date < end_date").select(
        F.explode(F.sequence("start_date", F.date_sub("end_date", 1))).alias("full_date")
    )
    day = F.col("full_date")
    weekday = F.dayofweek(day) - 1
    return days.select(
        date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.trunc(day, "quarter").alias("quarter_start_date"),
        F.trunc(day, "year").alias("year_start_date"),
    )


def calendar_bounds(spark, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """Fixed calendar range, the end exclusive."""
    return spark.range(1).select(F.lit(start).cast("date").alias("start_date"), F.lit(end).cast("date").alias("end_date"))


def calendar_bounds_of(*dated: tuple[DataFrame, str]) -> DataFrame:
    """Whole calendar years covering every date found in the given columns."""
    spans = [df.agg(F.min(c).cast("date").alias("lo"), F.max(c).cast("date").alias("hi")) for df, c in dated]
    merged = spans[0]
    for span in spans[1:]:
        merged = merged.unionByName(span)
    return merged.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(
        F.trunc("lo", "year").alias("start_date"),
        F.add_months(F.trunc("hi", "year"), 12).alias("end_date"),
    )
