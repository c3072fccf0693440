"""Declared raw tables: column types, text widths and load rules. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_SIMPLE = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _spark_type(name: str) -> T.DataType:
    if name.startswith("decimal"):
        precision, scale = name[8:-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _SIMPLE[name]


@dataclass(frozen=True)
class Column:
    """One raw column.

    ``wire`` lists the JSON names it may arrive under, best first. ``optional``
    columns may be absent from a record. ``filled`` columns are added on landing
    and never read from the record. ``nullable`` is what the table enforces.
    """

    name: str
    type: str
    width: int | None = None
    optional: bool = False
    nullable: bool = True
    filled: bool = False
    wire: tuple[str, ...] = ()

    @property
    def wire_names(self) -> tuple[str, ...]:
        return self.wire or (self.name,)

    @property
    def spark_type(self) -> T.DataType:
        return _spark_type(self.type)


@dataclass(frozen=True)
class RawTable:
    name: str
    key: str
    loaded_at: str
    columns: tuple[Column, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, True) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def on_the_wire(self) -> tuple[Column, ...]:
        return tuple(c for c in self.columns if not c.filled)


# Names, types, widths and wire names of the raw tables.
C = Column
_CREATED = C("created_at", "timestamp_ntz", filled=True)

SALES = RawTable("sales", "sale_id", "created_at", (
    C("sale_id", "string", 10), C("sale_date", "date"),
    C("customer_id", "string", 10), C("product_id", "string", 10),
    C("product_name", "string", 100), C("quantity", "int"),
    C("unit_price", "decimal(10,2)"), C("total_amount", "decimal(10,2)"),
    C("channel", "string", 20), C("store_id", "string", 10),
    C("country", "string", 50), _CREATED,
))

RETURNS = RawTable("returns", "return_id", "created_at", (
    C("return_id", "string", 10), C("sale_id", "string", 10),
    C("customer_id", "string", 10), C("product_id", "string", 10),
    C("return_date", "date"), C("reason", "string", 50),
    C("condition", "string", 20), C("refund_amount", "decimal(10,2)"),
    C("refund_method", "string", 30), C("processed_by", "string", 100),
    C("status", "string", 20), C("notes", "string", 500, optional=True), _CREATED,
))

REVIEWS = RawTable("reviews", "review_id", "created_at", (
    C("review_id", "string", 10), C("product_id", "string", 10),
    C("customer_id", "string", 10), C("rating", "int"),
    C("title", "string", 100), C("comment", "string", 1000, optional=True),
    C("review_date", "date"), C("verified_purchase", "boolean"),
    C("helpful_votes", "int"), C("status", "string", 20), _CREATED,
))

INVENTORY = RawTable("inventory", "inventory_id", "created_at", (
    C("inventory_id", "string", 10), C("product_id", "string", 10),
    C("store_id", "string", 10), C("current_stock", "int"),
    C("reserved_stock", "int"), C("reorder_level", "int"),
    C("max_stock_level", "int"), C("last_restocked", "date"),
    C("next_delivery_date", "date"), C("warehouse_location", "string", 50), _CREATED,
))

PRODUCTS = RawTable("products", "product_id", "last_updated", (
    C("product_id", "string", 20, nullable=False), C("name", "string", 255, nullable=False),
    C("category", "string", 100), C("subcategory", "string", 100),
    C("brand", "string", 100), C("material", "string", 100),
    C("color", "string", 50), C("price", "decimal(10,2)"),
    C("cost", "decimal(10,2)"), C("weight_kg", "decimal(8,2)"),
    C("dimensions_cm", "string", 50), C("supplier_id", "string", 20),
    C("created_date", "date"), C("last_updated", "date"),
    C("is_active", "boolean"), C("sku", "string", 50),
))

CUSTOMERS = RawTable("customers", "customer_id", "registration_date", (
    C("customer_id", "string", 20, nullable=False), C("first_name", "string", 100, nullable=False),
    C("last_name", "string", 100, nullable=False), C("email", "string", 255),
    C("phone", "string", 50), C("date_of_birth", "date"),
    C("gender", "string", 10), C("address", "string", 500),
    C("segment", "string", 50), C("registration_date", "date"),
    C("last_purchase_date", "date"), C("total_orders", "int"),
    C("lifetime_value", "decimal(12,2)"), C("preferred_channel", "string", 50),
    C("marketing_consent", "boolean"),
))

SUPPLIERS = RawTable("suppliers", "supplier_id", "established_date", (
    C("supplier_id", "string", 20, nullable=False), C("name", "string", 255, nullable=False),
    C("contact_person", "string", 255), C("email", "string", 255),
    C("phone", "string", 50), C("address", "string", 500),
    C("specialty", "string", 255), C("lead_time_days", "int"),
    C("minimum_order", "decimal(10,2)"), C("payment_terms", "string", 100),
    C("quality_rating", "decimal(3,2)"), C("established_date", "date"),
    C("is_active", "boolean"),
))

STORES = RawTable("stores", "store_id", "opening_date", (
    C("store_id", "string", 20, nullable=False),
    C("store_name", "string", 255, nullable=False, optional=True, wire=("store_name", "name")),
    C("manager_name", "string", 255), C("address", "string", 500, optional=True),
    C("city", "string", 100), C("country", "string", 100),
    C("phone", "string", 50), C("email", "string", 255), C("opening_date", "date"),
    C("store_size_sqm", "decimal(10,2)", optional=True, wire=("store_size_sqm", "square_meters")),
    C("is_active", "boolean"),
))

PROMOTIONS = RawTable("promotions", "promotion_id", "created_date", (
    C("promotion_id", "string", 20, nullable=False), C("name", "string", 255, nullable=False),
    C("description", "string", 500),
    C("discount_type", "string", 50, optional=True, wire=("discount_type", "type")),
    C("discount_value", "decimal(8,2)"), C("start_date", "date"), C("end_date", "date"),
    C("minimum_purchase", "decimal(10,2)"), C("is_active", "boolean"),
    C("created_date", "date", optional=True, wire=("created_date", "start_date")),
))

STREAM_SALES = RawTable("stream_sales", "event_id", "ingested_at", (
    C("event_id", "string", 36), C("sale_id", "string", 20),
    C("event_ts", "timestamp_ntz"), C("sale_date", "date"),
    C("customer_id", "string", 20), C("product_id", "string", 20),
    C("product_name", "string", 200), C("quantity", "int"),
    C("unit_price", "decimal(12,2)"), C("total_amount", "decimal(14,2)"),
    C("channel", "string", 30), C("store_id", "string", 20), C("country", "string", 50),
    C("kafka_partition", "int", filled=True), C("kafka_offset", "long", filled=True),
    C("ingested_at", "timestamp_ntz", filled=True),
))

TRANSACTIONAL = (SALES, RETURNS, REVIEWS, INVENTORY)
REFERENCE = (PRODUCTS, CUSTOMERS, SUPPLIERS, STORES, PROMOTIONS)
RAW_TABLES = {t.name: t for t in (*TRANSACTIONAL, *REFERENCE, STREAM_SALES)}


def raw_table(name: str) -> RawTable:
    if name not in RAW_TABLES:
        raise ValueError(f"unknown entity {name!r}; supported: {', '.join(RAW_TABLES)}")
    return RAW_TABLES[name]
