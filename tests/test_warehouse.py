"""The order-management adapter keeps every line item, and a warehouse writes each table once."""

import pytest
from pyspark.sql import functions as F

from retailloom.plans import warehouse as plans
from retailloom.session import scratch_path
from retailloom.sources import orders_model

SF_DIR = "/root/testdata/sf0.01"


def source(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_sales_keep_all_line_items_and_their_value(spark):
    lines, sales = source(spark)("lineitem"), orders_model.build("sales", source(spark))
    value = lines.agg(F.count("*"), F.sum(F.col("l_extendedprice").cast("decimal(10,2)")), F.sum("l_quantity").cast("long")).first()
    assert tuple(sales.agg(F.count("*"), F.sum("total_amount"), F.sum("quantity")).first()) == tuple(value)
    assert value[0] == 60_000 and sales.select("sale_id").distinct().count() == 60_000 and sales.where("quantity = 0").count() == 0


def test_returns_keep_all_returned_line_items(spark):
    returned = source(spark)("lineitem").where("l_returnflag = 'R'").count()
    assert orders_model.build("returns", source(spark)).select("return_id").distinct().count() == returned


def test_promotions_of_types_with_one_beginning_stay_apart(spark):
    parts = spark.createDataFrame([("PROMO A", "Brand#1", 1, 2.0), ("PROMO B", "Brand#1", 1, 2.0)], "p_type string, p_brand string, p_size int, p_retailprice double")
    assert orders_model.promotions(lambda _: parts).select("promotion_id").distinct().count() == 2


def fresh(spark, as_of="2001-12-31"):
    return plans.Warehouse(spark, lambda e: orders_model.build(e, lambda n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet")),
                           scratch_path(spark, "warehouse"), as_of, plans.ORDERS_CALENDAR)


def test_marts_can_be_built_first_and_side_by_side(spark):
    wh = fresh(spark)
    wh.build(wh.MARTS, threads=7)
    assert wh.mart("fact_sales").count() == wh.raw("sales").count() > 0


def test_a_failed_table_can_be_tried_again(spark):
    wh = fresh(spark)
    good, wh.build_raw = wh.build_raw, lambda _: 1 / 0
    with pytest.raises(ZeroDivisionError):
        wh.raw("stores")
    wh.build_raw = good
    assert wh.raw("stores").count() == 25


def test_callers_with_other_dates_get_other_warehouses(spark):
    first, second = (plans.warehouse_for(spark, "/root/testdata/sf0.001", day) for day in ("2001-12-31", "2011-12-31"))
    assert first is not second and first is plans.warehouse_for(spark, "/root/testdata/sf0.001", "2001-12-31")
