from datetime import date
from decimal import Decimal
from hashlib import md5

from rows import customer, event, raw, returned, sale

from retailloom.functions import NULL_KEY_PLACEHOLDER
from retailloom.operators import dimensions, facts
from retailloom.operators.staging import stage

AS_OF = "2024-01-01 00:00:00"


def hashed(text):
    return md5(text.encode()).hexdigest()


def staged(spark, view, entity, *rows):
    return stage(raw(spark, entity, *rows), view)


def test_customer_tiers_and_null_handling(spark):
    amounts = {"C1": 5000, "C2": 1000, "C3": 100, "C4": 99.99, "C5": 0}
    sales = staged(spark, "stg_sales", "sales", *(sale(sale_id=f"S{c}", customer_id=c, total_amount=a) for c, a in amounts.items()))
    customers = staged(spark, "stg_customers", "customers", *(customer(customer_id=c) for c in [*amounts, "C6"]))
    got = {r.customer_id: r for r in dimensions.dim_customer(customers, sales, AS_OF).collect()}
    assert [got[f"C{i}"].value_tier for i in range(1, 7)] == ["VIP", "High Value", "Regular", "Occasional", "Occasional", "Inactive"]
    assert got["C6"].observed_orders == 0 and got["C6"].observed_revenue == 0
    assert got["C6"].first_order_date is None and got["C6"].active_months is None
    assert got["C1"].age == 24  # a year boundary, not a completed year
    assert got["C1"].customer_sk == hashed("C1")


def test_full_name_is_null_when_a_part_is(spark):
    df = staged(spark, "stg_customers", "customers", customer(last_name=None))
    assert dimensions.dim_customer(df, staged(spark, "stg_sales", "sales", sale()), AS_OF).first().full_name is None


def test_active_months_are_distinct(spark):
    days = ["2024-01-01", "2024-01-31", "2024-02-01", "2023-01-15"]
    sales = staged(spark, "stg_sales", "sales", *(sale(sale_id=f"S{i}", sale_date=d) for i, d in enumerate(days)), sale(sale_id="S9", sale_date=None))
    row = dimensions.customer_sales_agg(sales).first()
    assert (row.observed_orders, row.active_months, row.observed_revenue) == (5, 3, Decimal("50.00"))


def test_dim_product_margin(spark):
    products = staged(spark, "stg_products", "products", dict(product_id="P1", price=30, cost=20, supplier_id="X"), dict(product_id="P2", price=8, cost=9))
    suppliers = staged(spark, "stg_suppliers", "suppliers", dict(supplier_id="X", name="Silk House", quality_rating=4.5))
    got = {r.product_id: r for r in dimensions.dim_product(products, suppliers).collect()}
    assert got["P1"].margin_pct == Decimal("33.33") and got["P1"].supplier_name == "Silk House"
    assert got["P2"].margin_pct == Decimal("-12.50") and got["P2"].supplier_name is None


def test_regions_and_years_open(spark):
    countries = ["France", "United States", "Japan", "Belgium", None]
    df = staged(spark, "stg_stores", "stores", *(dict(store_id=f"ST{i}", country=c, opening_date="2023-12-31") for i, c in enumerate(countries)))
    rows = sorted(dimensions.dim_store(df, AS_OF).collect(), key=lambda r: r.store_id)
    assert [r.region for r in rows] == ["Europe", "Americas", "Asia-Pacific", "Other", "Other"]
    assert {r.years_open for r in rows} == {1}


def test_calendar_end_is_exclusive(spark):
    df = dimensions.dim_date(dimensions.calendar_bounds(spark))
    assert df.count() == 4017
    days = {r.full_date: r for r in df.where("full_date >= '2020-12-26' and full_date <= '2021-01-04'").collect()}
    assert date(2030, 12, 31) not in [r[0] for r in df.selectExpr("max(full_date)").collect()]
    saturday, sunday, friday = days[date(2020, 12, 26)], days[date(2021, 1, 3)], days[date(2021, 1, 1)]
    assert (saturday.day_of_week, saturday.is_weekend, saturday.day_name) == (6, True, "Sat")
    assert (sunday.day_of_week, sunday.is_weekend, sunday.week_of_year) == (0, True, 53)
    assert (friday.date_sk, friday.week_of_year, friday.month_name, friday.is_weekend) == (20210101, 53, "January", False)
    assert friday.quarter_start_date == date(2021, 1, 1) and saturday.quarter_start_date == date(2020, 10, 1)


def test_fact_sales_counts_all_return_statuses(spark):
    sales = staged(spark, "stg_sales", "sales", sale(), sale(sale_id="S2", store_id=None))
    returns = staged(spark, "stg_returns", "returns", returned(), returned(return_id="R2", refund_amount=9, status="Rejected"))
    got = {r.sale_id: r for r in facts.fact_sales(sales, returns).collect()}
    assert (got["S1"].return_count, got["S1"].refund_amount, got["S1"].net_amount, got["S1"].has_return) == (2, 13, -3, True)
    assert (got["S2"].return_count, got["S2"].refund_amount, got["S2"].net_amount, got["S2"].has_return) == (0, 0, 10, False)
    assert got["S2"].store_sk == hashed(NULL_KEY_PLACEHOLDER) and got["S1"].date_sk == 20240101
    only_approved = {r.sale_id: r for r in facts.fact_sales(sales, returns, ["Approved"]).collect()}
    assert only_approved["S1"].net_amount == 6


def test_fact_returns_orphans_and_percent(spark):
    sales = staged(spark, "stg_sales", "sales", sale(), sale(sale_id="S0", total_amount=0))
    returns = staged(spark, "stg_returns", "returns", returned(), returned(return_id="R2", sale_id="S404"),
                     returned(return_id="R3", return_date="2023-12-30"), returned(return_id="R4", sale_id="S0"))
    got = {r.return_id: r for r in facts.fact_returns(returns, sales).collect()}
    assert len(got) == 4
    assert (got["R1"].days_to_return, got["R1"].refund_pct, got["R1"].channel) == (4, 40, "online")
    assert got["R2"].store_id is None and got["R2"].store_sk == hashed(NULL_KEY_PLACEHOLDER) and got["R2"].refund_pct is None
    assert got["R3"].days_to_return == -2
    assert got["R4"].refund_pct is None  # a free sale


def test_realtime_fact_is_a_projection(spark):
    fact = facts.fct_sales_realtime(staged(spark, "stg_stream_sales", "stream_sales", event()))
    assert "Exchange" not in fact._jdf.queryExecution().executedPlan().toString()
    assert fact.first().event_sk == hashed("ev1")


def test_build_time_is_added_on_request(spark):
    fact = facts.fct_sales_realtime(staged(spark, "stg_stream_sales", "stream_sales", event()))
    assert facts.stamp_build(fact).columns == [*fact.columns, "loaded_at"]
