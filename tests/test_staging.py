from decimal import Decimal

import pytest
from rows import event, plan_of, raw, returned, sale

from retailloom.operators.staging import stage


def ids(df, column):
    return sorted(r[0] for r in df.select(column).collect())


def test_sales_filter_is_three_valued(spark):
    df = raw(spark, "sales",
             sale(), sale(sale_id="S2", store_id=None, sale_date=None), sale(sale_id=None), sale(sale_id="S3", customer_id=None),
             sale(sale_id="S4", product_id=None), sale(sale_id="S5", quantity=0), sale(sale_id="S6", quantity=None),
             sale(sale_id="S7", total_amount=-1), sale(sale_id="S8", total_amount=None), sale(sale_id="S9", total_amount=0))
    staged = stage(df, "stg_sales")
    assert ids(staged, "sale_id") == ["S1", "S2", "S9"]
    assert "ingested_at" in staged.columns and "created_at" not in staged.columns


def test_returns_filter_and_renames(spark):
    df = raw(spark, "returns", returned(), returned(return_id="R2", sale_id=None), returned(return_id="R3", refund_amount=-1),
             returned(return_id="R4", refund_amount=None), returned(return_id=None))
    staged = stage(df, "stg_returns")
    assert ids(staged, "return_id") == ["R1"]
    assert {"return_reason", "item_condition"} <= set(staged.columns)


@pytest.mark.parametrize("rating,kept", [(0, 0), (1, 1), (5, 1), (6, 0), (None, 0)])
def test_reviews_rating_range(spark, rating, kept):
    assert stage(raw(spark, "reviews", dict(review_id="REV1", rating=rating)), "stg_reviews").count() == kept


def test_available_stock_may_be_negative(spark):
    df = raw(spark, "inventory", dict(inventory_id="I1", current_stock=3, reserved_stock=5),
             dict(inventory_id="I2", current_stock=-1, reserved_stock=0), dict(inventory_id="I3", current_stock=None, reserved_stock=0))
    assert [(r.inventory_id, r.available_stock) for r in stage(df, "stg_inventory").collect()] == [("I1", -2)]


def test_products_margin_and_price_filter(spark):
    df = raw(spark, "products", dict(product_id="P1", name="a", price=10, cost=12), dict(product_id="P2", price=0, cost=1),
             dict(product_id="P3", price=None), dict(product_id="P4", price=5))
    rows = {r.product_id: r for r in stage(df, "stg_products").collect()}
    assert set(rows) == {"P1", "P4"}
    assert rows["P1"].gross_margin == Decimal("-2.00") and rows["P1"].product_name == "a"
    assert rows["P4"].gross_margin is None


def test_stream_latency_counts_millisecond_boundaries(spark):
    df = raw(spark, "stream_sales", event(), event(event_id="e2", event_ts="2025-03-02 10:00:00.000900", ingested_at="2025-03-02 10:00:00.001100"))
    got = {r.event_id: r.latency_seconds for r in stage(df, "stg_stream_sales").collect()}
    assert got == {"ev1": Decimal("1.500"), "e2": Decimal("0.001")}


def test_filter_and_columns_reach_the_scan(spark, path):
    raw(spark, "sales", sale()).write.parquet(path("sales"))
    plan = plan_of(stage(spark.read.parquet(path("sales")), "stg_sales").select("sale_id", "total_amount"))
    assert "GreaterThan(quantity,0)" in plan and "IsNotNull(sale_id)" in plan
    assert "country" not in plan.split("ReadSchema")[-1]
