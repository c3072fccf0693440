"""Staging views: cast, rename and filter one raw table each.

A view is a predicate plus a list of output columns, applied lazily, so the
predicate and the column list reach the Parquet scan of the raw table. SQL
three-valued logic applies: a NULL in a compared column drops the row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.functions import boundary_diff
from retailloom.schemas import raw_table


@dataclass(frozen=True)
class StagingView:
    raw: str
    keep: str
    rename: dict[str, str] = field(default_factory=dict)
    derived: dict[str, tuple[str, object]] = field(default_factory=dict)  # name -> (after, expression)


def _latency_seconds() -> Column:
    millis = boundary_diff("millisecond", F.col("event_ts"), F.col("ingested_at"))
    return (millis / F.lit(1000).cast("decimal(4,0)")).cast("decimal(18,3)")


VIEWS = {
    "stg_sales": StagingView(
        "sales",
        keep="sale_id is not null and customer_id is not null and product_id is not null"
        " and quantity > 0 and total_amount >= 0",
        rename={"created_at": "ingested_at"},
    ),
    "stg_returns": StagingView(
        "returns",
        keep="return_id is not null and sale_id is not null and refund_amount >= 0",
        rename={"reason": "return_reason", "condition": "item_condition", "created_at": "ingested_at"},
    ),
    "stg_reviews": StagingView(
        "reviews",
        keep="review_id is not null and rating between 1 and 5",
        rename={"verified_purchase": "is_verified_purchase", "created_at": "ingested_at"},
    ),
    "stg_inventory": StagingView(
        "inventory",
        keep="inventory_id is not null and current_stock >= 0 and reserved_stock >= 0",
        rename={"created_at": "ingested_at"},
        derived={"available_stock": ("warehouse_location", lambda: F.col("current_stock") - F.col("reserved_stock"))},
    ),
    "stg_customers": StagingView("customers", keep="customer_id is not null"),
    "stg_products": StagingView(
        "products",
        keep="product_id is not null and price > 0",
        rename={"name": "product_name"},
        derived={"gross_margin": ("cost", lambda: F.col("price") - F.col("cost"))},
    ),
    "stg_stores": StagingView("stores", keep="store_id is not null"),
    "stg_suppliers": StagingView(
        "suppliers", keep="supplier_id is not null", rename={"name": "supplier_name"}
    ),
    "stg_stream_sales": StagingView(
        "stream_sales",
        keep="event_id is not null and customer_id is not null and product_id is not null"
        " and quantity > 0 and total_amount >= 0",
        derived={"latency_seconds": ("ingested_at", _latency_seconds)},
    ),
}


def stage(raw: DataFrame, view: str, beside: Sequence[str] = ()) -> DataFrame:
    """Apply one staging view; works on batch and streaming DataFrames alike. Columns ``beside`` the raw table's stay as they are."""
    spec = VIEWS[view]
    columns = []
    for column in raw_table(spec.raw).columns:
        columns.append(F.col(column.name).cast(column.spark_type).alias(spec.rename.get(column.name, column.name)))
        for name, (after, expression) in spec.derived.items():
            if after == column.name:
                columns.append(expression().alias(name))
    return raw.where(spec.keep).select(*columns, *beside)
