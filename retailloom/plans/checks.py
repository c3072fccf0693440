"""The declared checks of every layer, their severities and limits, as data."""

from __future__ import annotations

from retailloom.operators.quality import (
    accepted_values,
    at_least,
    between,
    not_null,
    relationship,
    shaped,
    unique,
    unique_combination,
)

# Accepted channel names, customer tiers and store regions.
CHANNELS = ("online", "offline", "mobile", "in-store", "wholesale", "retail")
TIERS = ("VIP", "High Value", "Regular", "Occasional", "Inactive")
REGIONS = ("Europe", "Americas", "Asia-Pacific", "Other")

# The checks declared per layer.
RAW_CHECKS = [
    *not_null("sales", "sale_id", "customer_id", "product_id", "total_amount"), *unique("sales", "sale_id"),
    *not_null("returns", "return_id", "sale_id"), *unique("returns", "return_id"),
    *not_null("reviews", "review_id"), *unique("reviews", "review_id"),
    *not_null("inventory", "inventory_id"), *unique("inventory", "inventory_id"),
    unique_combination("stream_sales", "kafka_partition", "kafka_offset"),
    *not_null("stream_sales", "event_id", "customer_id", "product_id", "total_amount"), *unique("stream_sales", "event_id"),
    *not_null("products", "product_id"), *unique("products", "product_id"),
    *not_null("customers", "customer_id"), *unique("customers", "customer_id"),
    *not_null("stores", "store_id"), *unique("stores", "store_id"),
    *not_null("suppliers", "supplier_id"), *unique("suppliers", "supplier_id"),
    *not_null("promotions", "promotion_id"), *unique("promotions", "promotion_id"),
]


def staging_checks(channels=CHANNELS) -> list:
    return [
        *not_null("stg_sales", "sale_id", "customer_id", "product_id"), *unique("stg_sales", "sale_id"),
        accepted_values("stg_sales", "channel", channels, severity="warn"),
        between("stg_sales", "quantity", 1, 1000),
        between("stg_sales", "total_amount", 0),
        *not_null("stg_returns", "return_id", "sale_id"), *unique("stg_returns", "return_id"),
        relationship("stg_returns", "sale_id", "stg_sales", "sale_id", severity="warn"),
        *not_null("stg_reviews", "review_id"), *unique("stg_reviews", "review_id"),
        between("stg_reviews", "rating", 1, 5),
        *not_null("stg_inventory", "inventory_id"), *unique("stg_inventory", "inventory_id"),
        between("stg_inventory", "available_stock", 0),
        *not_null("stg_customers", "customer_id"), *unique("stg_customers", "customer_id"),
        *not_null("stg_products", "product_id"), *unique("stg_products", "product_id"),
        between("stg_products", "price", 0),
        between("stg_products", "gross_margin", 0, severity="warn"),
        *not_null("stg_stores", "store_id"), *unique("stg_stores", "store_id"),
        *not_null("stg_suppliers", "supplier_id"), *unique("stg_suppliers", "supplier_id"),
        between("stg_suppliers", "quality_rating", 0, 5),
        *not_null("stg_stream_sales", "event_id", "customer_id", "product_id"), *unique("stg_stream_sales", "event_id"),
        between("stg_stream_sales", "total_amount", 0),
        between("stg_stream_sales", "latency_seconds", 0, 3600, severity="warn"),
    ]


STAGING_CHECKS = staging_checks()

MART_CHECKS = [
    *not_null("dim_customer", "customer_sk", "customer_id"), *unique("dim_customer", "customer_sk", "customer_id"),
    accepted_values("dim_customer", "value_tier", TIERS),
    *not_null("dim_product", "product_sk", "product_id"), *unique("dim_product", "product_sk", "product_id"),
    between("dim_product", "gross_margin", 0, severity="warn"),
    *not_null("dim_store", "store_sk"), *unique("dim_store", "store_sk"),
    accepted_values("dim_store", "region", REGIONS),
    *not_null("dim_date", "date_sk", "full_date"), *unique("dim_date", "date_sk", "full_date"),
    *not_null("fact_sales", "sale_sk", "sale_id", "customer_sk", "product_sk", "store_sk", "date_sk"),
    *unique("fact_sales", "sale_sk", "sale_id"),
    relationship("fact_sales", "customer_sk", "dim_customer", "customer_sk"),
    relationship("fact_sales", "product_sk", "dim_product", "product_sk"),
    relationship("fact_sales", "store_sk", "dim_store", "store_sk", severity="warn"),
    relationship("fact_sales", "date_sk", "dim_date", "date_sk"),
    between("fact_sales", "gross_amount", 0),
    *not_null("fact_returns", "return_sk", "return_id", "sale_id"), *unique("fact_returns", "return_sk", "return_id"),
    relationship("fact_returns", "sale_id", "fact_sales", "sale_id", severity="warn"),
    between("fact_returns", "refund_pct", 0, 100, severity="warn"),
    *not_null("fct_sales_realtime", "event_sk", "event_id", "customer_sk", "product_sk"),
    *unique("fct_sales_realtime", "event_sk", "event_id"),
    relationship("fct_sales_realtime", "customer_sk", "dim_customer", "customer_sk", severity="warn"),
    relationship("fct_sales_realtime", "product_sk", "dim_product", "product_sk", severity="warn"),
    relationship("fct_sales_realtime", "store_sk", "dim_store", "store_sk", severity="warn"),
    between("fct_sales_realtime", "gross_amount", 0),
    between("fct_sales_realtime", "latency_seconds", 0, severity="warn"),
]

ALL_CHECKS = [*RAW_CHECKS, *STAGING_CHECKS, *MART_CHECKS]

# Invariants of a delivery, checked on the raw tables before anything is built from them.
PRE_LOAD_CHECKS = [
    *not_null("suppliers", "supplier_id"), *not_null("products", "product_id"), *not_null("customers", "customer_id"),
    *not_null("stores", "store_id"), *not_null("sales", "sale_id"), *not_null("returns", "return_id", "sale_id"),
    *not_null("reviews", "review_id"), *not_null("inventory", "inventory_id"), *not_null("promotions", "promotion_id"),
    *unique("suppliers", "supplier_id"), *unique("products", "product_id"), *unique("customers", "customer_id"),
    *unique("stores", "store_id"), *unique("sales", "sale_id"),
    between("sales", "quantity", 1), between("sales", "unit_price", 0.01), between("sales", "total_amount", 0),
    between("products_margin", "gross_margin", 0),
    between("reviews", "rating", 1, 5),
    *(at_least(t, 1) for t in ("suppliers", "products", "customers", "stores", "sales")),
    shaped("returns", "sale_id", "S"),
]

# Hours a table may go without a load before it counts as stale.
FRESHNESS_SLA = {
    "sales": ("created_at", 6),
    "returns": ("created_at", 6),
    "reviews": ("created_at", 24),
    "inventory": ("created_at", 12),
    "products": ("last_updated", 168),
    "customers": ("registration_date", 168),
}

_MINUTE, _HOUR, _DAY = 60, 3600, 86400
# Fixed values: (load column, warn after, error after) per source, in seconds.
SOURCE_FRESHNESS = {
    "sales": ("created_at", 6 * _HOUR, 24 * _HOUR),
    "returns": ("created_at", 6 * _HOUR, 24 * _HOUR),
    "reviews": ("created_at", 6 * _HOUR, 24 * _HOUR),
    "inventory": ("created_at", 6 * _HOUR, 24 * _HOUR),
    "stream_sales": ("ingested_at", 10 * _MINUTE, 30 * _MINUTE),
    "products": ("last_updated", 7 * _DAY, 30 * _DAY),
    "customers": ("registration_date", 7 * _DAY, 30 * _DAY),
    "stores": ("opening_date", 30 * _DAY, 365 * _DAY),
    "suppliers": ("established_date", 6 * _HOUR, 24 * _HOUR),
    "promotions": ("created_date", 6 * _HOUR, 24 * _HOUR),
}

# Accepted row counts per table.
ROW_BOUNDS = {
    "sales": (50_000, 1_000_000),
    "returns": (1_000, 100_000),
    "reviews": (5_000, 200_000),
    "inventory": (1_000, 100_000),
    "products": (100, 50_000),
    "customers": (1_000, 500_000),
    "stores": (5, 500),
    "suppliers": (5, 1_000),
    "promotions": (10, 2_000),
}

# (check, child, child key, parent, parent key)
REFERENCES = [
    ("returns_without_sale", "returns", "sale_id", "sales", "sale_id"),
    ("reviews_without_product", "reviews", "product_id", "products", "product_id"),
    ("sales_without_customer", "sales", "customer_id", "customers", "customer_id"),
    ("sales_without_product", "sales", "product_id", "products", "product_id"),
]
