"""Raw retail tables derived from an order-management schema (orders, line items, parts, ...).

Plain projections, equi-joins and min/max aggregates only, so every step
reduces inside the tasks first and no group's rows are ever gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.operators.joins import per_key, streamed
from retailloom.schemas import raw_table

Source = Callable[[str], DataFrame]

COUNTRIES = ["France", "Italy", "United Kingdom", "Spain", "Germany", "United States", "Japan", "Belgium"]
STREAM_STORES, STREAM_PARTITIONS = 25, 3


def _id(prefix: str, *parts: str | Column) -> Column:
    pieces = [F.lit(prefix)]
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("-"))
        pieces.append((F.col(part) if isinstance(part, str) else part).cast("string"))
    return F.concat(*pieces)


def _choose(index: Column, *options: str) -> Column:
    return F.element_at(F.array(*(F.lit(o) for o in options)), (index + 1).cast("int"))


def _money(column: str, type_: str = "decimal(10,2)") -> Column:
    return F.col(column).cast(type_)


def _days_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def _hours_after(moment: Column, hours: int) -> Column:
    return moment.cast("timestamp_ntz") + F.expr(f"interval {hours} hours")


def _seconds(amount: Column) -> Column:
    return F.make_dt_interval(secs=amount.cast("decimal(18,6)"))


def sale_lines(source: Source) -> DataFrame:
    """Order lines as sale ids that leave the part out, so that some repeat."""
    return source("lineitem").select(_id("S", "l_orderkey", "l_linenumber").alias("sale_id"), "l_orderkey", "l_partkey")


# A line item is told apart by these; should one be repeated, its quantities and amounts add up.
_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def sales(source: Source) -> DataFrame:
    """One sale per line item: all quantities and amounts of the line items are kept."""
    # By order, as the join needs them: the lines are shuffled once.
    lines = streamed(source("lineitem").select(*_LINE, "l_quantity", "l_extendedprice"), _LINE, ["l_orderkey"]).groupBy(*_LINE).agg(
        F.sum("l_quantity").cast("int").alias("quantity"),
        F.sum(_money("l_extendedprice")).cast("decimal(10,2)").alias("total_amount"),
    )
    orders = source("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customers = source("customer").select("c_custkey", "c_nationkey")
    nations = source("nation").select("n_nationkey", "n_name")
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    sold = F.col("quantity")
    return lines.join(placed, lines.l_orderkey == placed.o_orderkey).select(
        _id("S", *_LINE).alias("sale_id"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        _id("C", "o_custkey").alias("customer_id"),
        _id("P", "l_partkey").alias("product_id"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("product_name"),
        sold.alias("quantity"),
        F.coalesce(F.round(F.col("total_amount") / F.nullif(sold, F.lit(0)), 2), F.col("total_amount"))
        .cast("decimal(10,2)").alias("unit_price"),
        "total_amount",
        F.col("o_orderpriority").alias("channel"),
        # Low-priority orders are placed online and belong to no store.
        F.when(F.col("o_orderpriority") != "5-LOW", _id("ST", "c_nationkey")).alias("store_id"),
        F.col("n_name").alias("country"),
        _hours_after(F.col("o_orderdate"), 1).alias("created_at"),
        "l_orderkey",
    )


def _dated(moment: str) -> Column:
    """The moment in a struct; NULL if it is NULL, so a minimum passes over it."""
    return F.when(F.col(moment).isNotNull(), F.struct(moment))


def returns(source: Source) -> DataFrame:
    """One return per returned line item and line status; open lines refund above the price."""
    price = _money("l_extendedprice", "decimal(12,2)")
    rate = F.col("l_discount").cast("decimal(4,2)")
    refund = price * F.when(F.col("l_linestatus") == "F", rate).otherwise(rate + F.lit(1).cast("decimal(1,0)"))
    returned = source("lineitem").where("l_returnflag = 'R'").select(
        *_LINE, "l_linestatus", _dated("l_shipdate").alias("shipped"), F.round(refund, 2).alias("refund"))
    # A maximum over structs is taken from sorted rows, so no table of all groups is held in memory.
    lines = returned.repartition("l_orderkey").groupBy(*_LINE, "l_linestatus").agg(
        F.max("shipped")["l_shipdate"].alias("shipped"),
        F.sum("refund").cast("decimal(10,2)").alias("refund_amount"),
    )
    orders = source("orders").select("o_orderkey", "o_custkey")
    status = F.col("l_linestatus")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat(_id("R", *_LINE), status).alias("return_id"),
        _id("S", *_LINE).alias("sale_id"),
        _id("C", "o_custkey").alias("customer_id"),
        _id("P", "l_partkey").alias("product_id"),
        F.col("shipped").cast("date").alias("return_date"),
        F.concat(F.lit("line status "), status).alias("reason"),
        F.concat(F.lit("as shipped, "), status).alias("condition"),
        "refund_amount",
        F.concat(F.lit("method "), status).alias("refund_method"),
        _id("STAFF", F.col("l_suppkey") % 20).alias("processed_by"),
        F.when(status == "F", "Approved").otherwise("Pending").alias("status"),
        F.lit(None).cast("string").alias("notes"),
        _hours_after(F.col("shipped"), 6).alias("created_at"),
        "l_orderkey",
    )


def customers(source: Source) -> DataFrame:
    key, name = F.col("c_custkey"), F.split("c_name", "#")
    return source("customer").select(
        _id("C", "c_custkey").alias("customer_id"),
        name[0].alias("first_name"),
        name[1].alias("last_name"),
        F.concat(F.lower(name[0]), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+33"), key.cast("string")).alias("phone"),
        _days_after("1950-01-01", key * 37 % 20000).alias("date_of_birth"),
        _choose(key % 3, "F", "M", "X").alias("gender"),
        F.concat(F.lit('{"nation": '), F.col("c_nationkey").cast("string"), F.lit("}")).alias("address"),
        F.col("c_mktsegment").alias("segment"),
        _days_after("1994-01-01", key * 13 % 2500).alias("registration_date"),
        F.when(F.col("c_acctbal") >= 0, _days_after("1999-01-01", key * 7 % 900)).alias("last_purchase_date"),
        (key % 50).cast("int").alias("total_orders"),
        _money("c_acctbal", "decimal(12,2)").alias("lifetime_value"),
        F.concat(F.lit("desk "), F.lower("c_mktsegment")).alias("preferred_channel"),
        (key % 3 == 0).alias("marketing_consent"),
    )


def products(source: Source) -> DataFrame:
    """Parts as products; size 1 is given away, sizes from 40 cost more than they sell for."""
    supplied = per_key(source("lineitem"), "l_partkey", F.min("l_suppkey").alias("suppkey"))
    parts = source("part")
    size, listed = F.col("p_size"), _money("p_retailprice")
    factor = F.when(size >= 40, F.lit("1.10")).otherwise(F.lit("0.60")).cast("decimal(3,2)")
    created = _days_after("1993-01-01", F.col("p_partkey") % 1000)
    return parts.join(supplied, parts.p_partkey == supplied.l_partkey, "left").select(
        _id("P", "p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.concat("p_type", F.lit(" "), "p_brand").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.split("p_name", " ")[1].alias("material"),
        F.split("p_name", " ")[0].alias("color"),
        F.when(size == 1, F.lit(0)).otherwise(listed).cast("decimal(10,2)").alias("price"),
        F.round(listed * factor, 2).cast("decimal(10,2)").alias("cost"),
        (size.cast("decimal(8,2)") / 10).cast("decimal(8,2)").alias("weight_kg"),
        F.concat(size.cast("string"), F.lit("x"), size.cast("string")).alias("dimensions_cm"),
        _id("SUP", "suppkey").alias("supplier_id"),
        created.alias("created_date"),
        F.date_add(created, size * 60).alias("last_updated"),
        (size > 5).alias("is_active"),
        _id("SKU", "p_partkey").alias("sku"),
    )


def suppliers(source: Source) -> DataFrame:
    """Suppliers; one rating in ten lies above the allowed maximum of five."""
    key = F.col("s_suppkey")
    return source("supplier").select(
        _id("SUP", "s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("Contact "), key.cast("string")).alias("contact_person"),
        F.concat(F.lit("contact"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+39"), key.cast("string")).alias("phone"),
        F.concat(F.lit('{"nation": '), F.col("s_nationkey").cast("string"), F.lit("}")).alias("address"),
        _choose(key % 3, "Leather", "Silk", "Jewellery").alias("specialty"),
        (key % 39 + 7).cast("int").alias("lead_time_days"),
        _money("s_acctbal").alias("minimum_order"),
        F.concat(F.lit("terms of nation "), F.col("s_nationkey").cast("string")).alias("payment_terms"),
        ((key % 50 + 5).cast("decimal(4,0)") / 10).cast("decimal(3,2)").alias("quality_rating"),
        _days_after("1990-01-01", key * 11 % 4000).alias("established_date"),
        (key % 20 != 0).alias("is_active"),
    )


def stores(source: Source) -> DataFrame:
    nations, regions = source("nation"), source("region")
    key = F.col("n_nationkey")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        _id("ST", "n_nationkey").alias("store_id"),
        F.concat(F.lit("Maison "), F.col("n_name")).alias("store_name"),
        F.concat(F.lit("Manager "), key.cast("string")).alias("manager_name"),
        F.concat(F.lit("1 Main St, "), F.col("r_name")).alias("address"),
        F.col("r_name").alias("city"),
        _choose(key % len(COUNTRIES), *COUNTRIES).alias("country"),
        F.concat(F.lit("+1"), key.cast("string")).alias("phone"),
        F.concat(F.lit("store"), key.cast("string"), F.lit("@example.com")).alias("email"),
        _days_after("1985-12-31", key * 366).alias("opening_date"),
        (key * 10 + 80).cast("decimal(10,2)").alias("store_size_sqm"),
        (key % 12 != 0).alias("is_active"),
    )


def inventory(source: Source) -> DataFrame:
    """One stock record per (part, supplier) that was ever sold; some counts are negative."""
    shipped = source("lineitem").select("l_partkey", "l_suppkey", _dated("l_shipdate").alias("shipped"))
    # Pairs hardly repeat; extremes over structs are taken from sorted rows, without a table of all pairs in memory.
    pairs = shipped.repartition("l_partkey", "l_suppkey").groupBy("l_partkey", "l_suppkey").agg(
        F.min("shipped")["l_shipdate"].alias("first_shipped"), F.max("shipped")["l_shipdate"].alias("last_shipped")
    )
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    return pairs.select(
        _id("INV", "l_partkey", "l_suppkey").alias("inventory_id"),
        _id("P", "l_partkey").alias("product_id"),
        _id("ST", part % 25).alias("store_id"),
        ((part * 7 + supplier) % 100 - 2).cast("int").alias("current_stock"),
        ((part + supplier * 3) % 40).cast("int").alias("reserved_stock"),
        (part % 15 + 5).cast("int").alias("reorder_level"),
        (part % 50 + 100).cast("int").alias("max_stock_level"),
        F.col("first_shipped").cast("date").alias("last_restocked"),
        F.date_add(F.col("last_shipped").cast("date"), 30).alias("next_delivery_date"),
        _id("W", supplier % 9).alias("warehouse_location"),
        _hours_after(F.col("last_shipped"), 2).alias("created_at"),
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def reviews(source: Source) -> DataFrame:
    """Every event as a review; ratings run from 0 to 6, so some are out of range."""
    return source("events").select(
        _id("REV", "event_id").alias("review_id"),
        _id("P", F.col("user_id") * 20).alias("product_id"),
        _id("C", "user_id").alias("customer_id"),
        (_k() % 7).alias("rating"),
        F.concat(F.lit("On "), "event_type").alias("title"),
        F.when(F.col("value") > 5, F.concat(F.lit("value "), F.col("props"))).alias("comment"),
        F.col("ts").cast("date").alias("review_date"),
        (F.col("value") > 10).alias("verified_purchase"),
        _k().alias("helpful_votes"),
        F.when(F.col("event_type") == "error", "Pending").otherwise("Approved").alias("status"),
        _hours_after(F.col("ts"), 1).alias("created_at"),
    )


def promotions(source: Source) -> DataFrame:
    """One promotion per part type and brand."""
    grouped = source("part").groupBy("p_type", "p_brand").agg(
        F.min("p_size").alias("low"), F.max("p_size").alias("high"), F.max(_money("p_retailprice")).alias("price")
    )
    starts = _days_after("2001-01-01", F.col("low"))
    return grouped.select(
        F.concat(F.lit("PROMO "), F.col("p_type"), F.lit(" "), F.element_at(F.split("p_brand", "#"), -1)).alias("promotion_id"),
        F.concat("p_type", F.lit(" on "), "p_brand").alias("name"),
        F.lit("Seasonal offer").alias("description"),
        F.when(F.col("high") > 45, "PERCENTAGE").otherwise("FIXED").alias("discount_type"),
        F.col("high").cast("decimal(8,2)").alias("discount_value"),
        starts.alias("start_date"),
        F.date_add(starts, F.col("high")).alias("end_date"),
        F.col("price").alias("minimum_purchase"),
        (F.col("low") % 2 == 0).alias("is_active"),
        F.date_sub(starts, 30).alias("created_date"),
    )


def stream_sales(source: Source) -> DataFrame:
    """Purchase events as landed stream rows.

    The event id serves as offset: unique and rising within a partition, and
    known to each row without numbering a whole partition in one task.
    """
    store = F.col("user_id") % STREAM_STORES
    price, quantity = _money("value", "decimal(12,2)"), _k() % 4
    return source("events").where("event_type = 'purchase'").select(
        _id("E", "event_id").alias("event_id"),
        _id("SX", "event_id").alias("sale_id"),
        F.col("ts").alias("event_ts"),
        F.col("ts").cast("date").alias("sale_date"),
        _id("C", "user_id").alias("customer_id"),
        _id("P", F.col("user_id") * 7 % 2000).alias("product_id"),
        F.concat(F.lit("Part "), (F.col("user_id") * 7 % 2000).cast("string")).alias("product_name"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        (price * quantity).cast("decimal(14,2)").alias("total_amount"),
        F.concat("event_type", F.lit(" "), (F.col("event_id") % 4).cast("string")).alias("channel"),
        _id("ST", store).alias("store_id"),
        _choose(store % len(COUNTRIES), *COUNTRIES).alias("country"),
        (store % STREAM_PARTITIONS).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        (F.col("ts") + _seconds(_money("value", "decimal(12,2)") * F.lit("0.01").cast("decimal(3,2)"))).alias("ingested_at"),
    )


def load_audit(source: Source) -> DataFrame:
    """Events read as load records: purchases copy sales, errors are failed loads."""
    kind = F.col("event_type")
    return source("events").select(
        F.col("event_id").cast("string").alias("load_id"),
        kind.alias("table_name"),
        F.concat(kind, F.lit("-"), F.col("event_id").cast("string"), F.lit(".json")).alias("file_name"),
        _id("user", "user_id").alias("actor"),
        F.when(F.col("user_id") % 2 == 0, "ingest").otherwise("adhoc").alias("pool"),
        F.when(kind == "error", "FAIL").otherwise("LOADED").alias("status"),
        _k().cast("long").alias("row_count"),
        F.when(kind == "error", F.lit(1)).otherwise(F.lit(0)).cast("long").alias("error_count"),
        F.when(kind == "error", "E100").alias("error_code"),
        F.when(kind == "error", F.concat(F.lit("bad record in "), F.col("props"))).alias("error_message"),
        F.col("ts").alias("received_at"),
        (F.col("ts") + _seconds(_money("value", "decimal(12,2)"))).alias("loaded_at"),
        F.when(kind == "view", F.lit("SELECT 1")).otherwise(
            F.concat(F.lit("COPY INTO "), F.upper(kind), F.lit(" FROM @stage"))
        ).alias("statement"),
    )


BUILDERS = {
    "sales": sales, "returns": returns, "reviews": reviews, "inventory": inventory,
    "products": products, "customers": customers, "suppliers": suppliers, "stores": stores,
    "promotions": promotions, "stream_sales": stream_sales,
}


#: What sales and returns are dealt by while they are built. A sale id holds it, so equal sale ids mean equal order keys.
DEALT_BY = "l_orderkey"


def build(entity: str, source: Source, beside: Sequence[str] = ()) -> DataFrame:
    """The raw table with its declared column order and types, and further columns ``beside`` it."""
    table = raw_table(entity)
    rows = BUILDERS[entity](source)
    return rows.select(*(F.col(c.name).cast(c.spark_type).alias(c.name) for c in table.columns), *beside)
