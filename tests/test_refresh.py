"""A whole refresh from a tiny delivery, twice."""

import json

import pytest
from pyspark.errors import PySparkException

from retailloom.operators import history
from retailloom.operators.quality import QualityGateError
from retailloom.plans.refresh import latest_mart, load_deliveries, open_warehouse, refresh


def deliver(folder, segment="VIP"):
    folder.mkdir(exist_ok=True)
    records = {
        "sales": [dict(sale_id=f"S{i}", sale_date="2024-01-01", customer_id=f"C{i % 15}", product_id=f"P{i % 10}", product_name="Item", quantity=1,
                       unit_price=10.0, total_amount=10.0, channel="online", store_id=f"ST{i % 2}", country="France", size="M") for i in range(20)],
        "returns": [dict(return_id=f"R{i}", sale_id=f"S{i * 9}", customer_id="C1", product_id="P1", return_date="2024-01-05", reason="torn",
                         condition="New", refund_amount=5, refund_method="Exchange", processed_by="STAFF001", status="Pending", notes=None) for i in range(3)],
        "reviews": [dict(review_id=f"REV{i}", product_id=f"P{i}", customer_id="C1", rating=i + 1, title="t", review_date="2024-01-02",
                         verified_purchase=True, helpful_votes=1, status="Approved") for i in range(5)],
        "inventory": [dict(inventory_id=f"INV{i}", product_id=f"P{i}", store_id="ST0", current_stock=9, reserved_stock=1, reorder_level=2,
                           max_stock_level=20, last_restocked="2024-01-01", next_delivery_date="2024-02-01", warehouse_location="W") for i in range(4)],
        "products": [dict(product_id=f"P{i}", name="n", category="c", subcategory="s", brand=f"B{i % 3}", material="m", color="c", price=100, cost=60,
                          weight_kg=1, dimensions_cm="1x1", supplier_id=f"SUP{i % 3}", created_date="2023-01-01", last_updated="2024-01-01",
                          is_active=True, sku="k", vintage_era="1970s") for i in range(10)],
        "customers": [dict(customer_id=f"C{i}", first_name="A", last_name="B", email="e", phone="p", date_of_birth="1990-01-01", gender="F",
                           address='{"city": "Paris"}', segment=segment if i == 0 else "VIP", registration_date="2024-01-01", last_purchase_date=None,
                           total_orders=1, lifetime_value=10, preferred_channel="desk", marketing_consent=False) for i in range(15)],
        "suppliers": [dict(supplier_id=f"SUP{i}", name="n", contact_person="c", email="e", phone="p", address="a", specialty="Silk", lead_time_days=7,
                           minimum_order=100, payment_terms="30 days", quality_rating=4.5, established_date="2010-01-01", is_active=True) for i in range(3)],
        "stores": [dict(store_id=f"ST{i}", name="Shop", manager_name="m", address={"street": "1 Rue", "city": "Paris", "country": "France"}, city="Paris",
                        country="France", phone="p", email="e", opening_date="2015-01-01", square_meters=80, is_active=True) for i in range(2)],
        "promotions": [dict(promotion_id=f"PROMO{i}", name="n", description="d", type="FIXED", discount_value=10, start_date="2024-01-01",
                            end_date="2024-02-01", minimum_purchase=100, is_active=True) for i in range(2)],
    }
    for entity, rows in records.items():
        (folder / f"{entity}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(folder)


def statuses(result):
    return {(r.check_name, r.table_name, r.column_name): r.status for r in result.check_results.collect()}


def test_refresh_from_deliveries(spark, tmp_path, path):
    first = refresh(spark, deliver(tmp_path / "d1"), path("root"), "2024-01-06 00:00:00", gates=False)
    assert first.row_counts == dict(sales=20, returns=3, reviews=5, inventory=4, products=10, customers=15, suppliers=3, stores=2, promotions=2)
    assert set(statuses(first).values()) == {"pass"}
    fact = first.warehouse.mart("fact_sales")
    assert fact.count() == 20 and fact.where("has_return").count() == 3
    assert first.warehouse.mart("dim_date").count() == 4017
    assert first.warehouse.mart("dim_store").first().address == "1 Rue, Paris, France"
    assert latest_mart(spark, path("root"), "fact_sales").exceptAll(fact).count() == 0
    assert spark.read.parquet(path("root/load_audit")).where("status = 'LOADED'").count() == 9


def test_appended_reference_rows_repeat(spark, tmp_path, path):
    folder = deliver(tmp_path / "d1")
    refresh(spark, folder, path("root"), "2024-01-06 00:00:00", gates=False)
    second = refresh(spark, folder, path("root"), "2024-01-07 00:00:00", gates=False)
    assert second.warehouse.raw("sales").count() == 20 and second.warehouse.raw("products").count() == 20
    got = statuses(second)
    assert got[("unique", "products", "product_id")] == "fail" and got[("unique", "sales", "sale_id")] == "pass"
    assert history.read_history(spark, path("root/customer_history")).count() == 15  # equal repeats are one customer


def test_upserted_reference_rows_version_customers(spark, tmp_path, path):
    refresh(spark, deliver(tmp_path / "d1"), path("root"), "2024-01-06 00:00:00", reference="upsert", gates=False)
    second = refresh(spark, deliver(tmp_path / "d2", "Gold"), path("root"), "2024-01-07 00:00:00", reference="upsert", gates=False)
    assert second.warehouse.raw("products").count() == 10
    assert set(statuses(second).values()) == {"pass"}
    versions = history.read_history(spark, path("root/customer_history"))
    assert versions.count() == 16
    assert {(r.segment, r.valid_to is None) for r in versions.where("customer_id = 'C0'").collect()} == {("VIP", False), ("Gold", True)}


def test_gates_report_small_row_counts(spark, tmp_path, path):
    with pytest.raises(QualityGateError) as breach:
        refresh(spark, deliver(tmp_path / "d1"), path("root"), "2024-01-06 00:00:00")
    assert "table sales holds 20 rows: UNDER_MIN" in breach.value.breaches
    assert not any("without a match" in b for b in breach.value.breaches)


def test_nothing_transactional_stops_the_refresh(spark, tmp_path, path):
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "sales.json").write_text("")
    with pytest.raises(QualityGateError, match="nothing was loaded"):
        refresh(spark, str(folder), path("root"), "2024-01-06 00:00:00")


def test_a_failed_load_leaves_the_tables_as_they_were(spark, tmp_path, path):
    with pytest.raises(ValueError):
        latest_mart(spark, path("root"), "fact_sales")
    refresh(spark, deliver(tmp_path / "d1"), path("root"), "2024-01-06 00:00:00", gates=False)
    broken = tmp_path / "d2"
    deliver(broken)
    (broken / "sales.json").write_text('{"sale_id": "S1"}\n')
    with pytest.raises(PySparkException, match="missing:sale_date"):
        refresh(spark, str(broken), path("root"), "2024-01-07 00:00:00", gates=False)
    assert open_warehouse(spark, path("root"), "2024-01-07 00:00:00").raw("sales").count() == 20
    assert latest_mart(spark, path("root"), "fact_sales").count() == 20
    failed = spark.read.parquet(path("root/load_audit")).where("status = 'FAIL'").collect()
    assert [r.table_name for r in failed] == ["sales"] and "missing:sale_date" in failed[0].error_message


def test_append_and_upsert_may_alternate(spark, tmp_path, path):
    for i, how in enumerate(("append", "upsert", "append")):
        folder = tmp_path / f"d{i}"
        deliver(folder)
        store = dict(store_id=f"ST{i}", name="Shop", manager_name="m", address="a", city="Paris", country="France", phone="p", email="e",
                     opening_date="2015-01-01", square_meters=80, is_active=True)
        (folder / "stores.json").write_text(json.dumps(store) + "\n")
        load_deliveries(spark, str(folder), path("root"), f"2024-01-0{i + 1} 00:00:00", how)
        stores = open_warehouse(spark, path("root"), "2024-01-09 00:00:00").raw("stores")
        assert sorted(r.store_id for r in stores.collect()) == [f"ST{k}" for k in range(i + 1)]
    with pytest.raises(ValueError, match="loaded after"):
        load_deliveries(spark, str(folder), path("root"), "2024-01-02 00:00:00", "append")
