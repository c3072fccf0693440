import json
import os
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T
from rows import SALE, plan_of, raw, sale

from retailloom.operators import monitoring
from retailloom.schemas import RAW_TABLES, raw_table
from retailloom.sources import ndjson, writers

AS_OF = "2024-06-01 12:00:00"
WIRE = {k: v for k, v in SALE.items() if k != "created_at"}


def lines(path, *records):
    with open(path, "w", encoding="utf-8") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
    return path


def without(name):
    return {k: v for k, v in WIRE.items() if k != name}


def test_strict_reads_typed_rows_and_skips_blank_lines(spark, path):
    file = lines(path("sales.json"), {**WIRE, "tax_amount": 2}, "", "   \t", {**WIRE, "sale_id": "S2", "unit_price": 12345678.9, "store_id": None})
    got = {r.sale_id: r for r in ndjson.read_ndjson(spark, file, "sales", as_of=AS_OF).collect()}
    assert set(got) == {"S1", "S2"}
    assert got["S2"].unit_price == Decimal("12345678.90") and got["S2"].store_id is None
    assert str(got["S1"].created_at) == AS_OF and str(got["S1"].sale_date) == "2024-01-01"


@pytest.mark.parametrize("bad,reason", [
    ('{"sale_id": "S1"', "malformed"), ("[1, 2]", "malformed"), (without("store_id"), "missing:store_id"),
    ({**WIRE, "quantity": "many"}, "bad_value:quantity"), ({**WIRE, "sale_date": "2024-13-01"}, "bad_value:sale_date"),
    ({**WIRE, "sale_id": "S1234567890"}, "too_long:sale_id"),
])
def test_strict_fails_and_quarantine_names_the_reason(spark, path, bad, reason):
    file = lines(path("sales.json"), WIRE, bad)
    with pytest.raises(PySparkException, match=reason):
        ndjson.read_ndjson(spark, file, "sales").collect()
    good, rejected = ndjson.quarantine_split(spark, file, "sales")
    assert [r.sale_id for r in good.collect()] == ["S1"]
    assert [r.reject_reason for r in rejected.collect()] == [reason]


def test_optional_field_may_be_absent(spark, path):
    record = dict(return_id="R1", sale_id="S1", customer_id="C1", product_id="P1", return_date="2024-01-01", reason="x", condition="New",
                  refund_amount=1.005, refund_method="Card", processed_by="A", status="Approved")
    row = ndjson.read_ndjson(spark, lines(path("r.json"), record), "returns").first()
    assert row.notes is None and row.refund_amount == Decimal("1.01")


def test_enforced_not_null(spark, path):
    record = dict.fromkeys((c.name for c in raw_table("suppliers").columns), None)
    _, bad = ndjson.quarantine_split(spark, lines(path("s.json"), {**record, "supplier_id": "SUP1"}), "suppliers")
    assert bad.first().reject_reason == "null:name"


def test_lenient_skips_malformed_and_missing_paths(spark, path):
    file = lines(path("sales.json"), WIRE, "{oops", without("store_id"))
    assert ndjson.read_ndjson(spark, file, "sales", "lenient").count() == 2
    assert ndjson.read_ndjson(spark, path("nowhere.json"), "sales", "lenient").count() == 0


def test_empty_file_loads_no_rows(spark, path):
    file = lines(path("empty.json"))
    assert writers.load_replace(ndjson.read_ndjson(spark, file, "sales"), path("t")) == 0


def test_unknown_entity_is_refused(spark, path):
    with pytest.raises(ValueError, match="supported: sales"):
        ndjson.read_ndjson(spark, path("x.json"), "gadgets")


@pytest.mark.parametrize("entity", ["sales", "stores"])
def test_a_line_is_parsed_once(spark, path, entity):
    file = lines(path("rows.json"), WIRE)
    plan = ndjson.read_ndjson(spark, file, entity)._jdf.queryExecution().optimizedPlan().toString()
    parsers = ("from_json(", "parse_json(", "json_object_keys(", "get_json_object(", "json_tuple(")
    assert sum(plan.count(p) for p in parsers) == 1


STORE = dict(store_id="ST1", manager_name="M", city="Paris", country="France", phone="1", email="e", opening_date="2020-01-01", is_active=True)


@pytest.mark.parametrize("extra,address", [
    ({"address": "12 rue X"}, "12 rue X"), ({"address": '{"street": "a"}'}, '{"street": "a"}'),
    ({"address": {"street": "1 Main", "city": "Paris", "country": "France"}}, "1 Main, Paris, France"),
    ({"address": {"city": "Paris"}}, "Paris"), ({"address": {}}, ""), ({"address": None}, ""), ({"address": 5}, ""), ({}, ""),
])
def test_store_address_shapes(spark, path, extra, address):
    assert ndjson.read_ndjson(spark, lines(path("s.json"), {**STORE, **extra}), "stores").first().address == address


@pytest.mark.parametrize("extra,name,size", [
    ({"store_name": "A", "name": "B", "store_size_sqm": 10, "square_meters": 20}, "A", 10),
    ({"store_name": "", "name": "B", "store_size_sqm": 0, "square_meters": 20}, "B", 20),
    ({"store_name": None, "name": "B", "square_meters": 20.5}, "B", Decimal("20.50")), ({}, "", 0),
])
def test_store_field_variants(spark, path, extra, name, size):
    row = ndjson.read_ndjson(spark, lines(path("s.json"), {**STORE, **extra}), "stores").first()
    assert (row.store_name, row.store_size_sqm) == (name, size)


@pytest.mark.parametrize("extra,kind,created", [
    ({"discount_type": "FIXED", "created_date": "2023-01-01"}, "FIXED", "2023-01-01"),
    ({"type": "PERCENTAGE"}, "PERCENTAGE", "2024-02-01"), ({"discount_type": "", "type": "BOGO", "created_date": ""}, "BOGO", "2024-02-01"),
    ({}, "", "2024-02-01"),
])
def test_promotion_field_variants(spark, path, extra, kind, created):
    record = dict(promotion_id="PROMO1", name="n", description="d", discount_value=10, start_date="2024-02-01", end_date="2024-03-01",
                  minimum_purchase=100, is_active=True)
    row = ndjson.read_ndjson(spark, lines(path("p.json"), {**record, **extra}), "promotions").first()
    assert (row.discount_type, str(row.created_date)) == (kind, created)


def test_quarantine_load_and_tolerance(spark, path):
    file = lines(path("sales.json"), WIRE, "{oops", without("country"))
    assert ndjson.load_with_quarantine(spark, file, "sales", path("t"), path("bad"), tolerance=3) == (1, 2)
    assert spark.read.json(path("bad")).count() == 2
    with pytest.raises(ndjson.QuarantineToleranceError, match="2 rejected"):
        ndjson.load_with_quarantine(spark, file, "sales", path("t"), path("bad"), tolerance=2)
    assert spark.read.parquet(path("t")).count() == 1  # the failed load appended nothing


def test_replace_is_repeatable_and_append_is_not(spark, path):
    df = raw(spark, "sales", sale(), sale(sale_id="S2"))
    for _ in range(2):
        assert writers.load_replace(df, path("replaced")) == 2
        assert writers.load_append(df, path("appended"), df.schema) == 2
    assert spark.read.parquet(path("replaced")).count() == 2
    assert spark.read.parquet(path("appended")).count() == 4


def test_align_by_name_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, "x", "y", 9)], "b int, A string, a string, extra int")
    target = spark.createDataFrame([], "a string, b long, c string, B int").schema
    assert writers.align_by_name(df, target).collect() == [("y", 1, None, None)]


def test_upsert_replaces_by_key_and_is_repeatable(spark, path):
    old = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "k string, at int, v int")
    new = spark.createDataFrame([("b", 2, 21), ("b", 3, 22), ("c", 1, 30)], "k string, at int, v int")
    once = writers.upsert(old, new, "k", "at")
    assert sorted(map(tuple, once.collect())) == [("a", 1, 10), ("b", 3, 22), ("c", 1, 30)]
    assert sorted(map(tuple, writers.upsert(once, new, "k", "at").collect())) == sorted(map(tuple, once.collect()))
    writers.load_upsert(spark, new, path("none"), path("v1"), "k", "at")
    assert spark.read.parquet(path("v1")).count() == 2
    with pytest.raises(ValueError):
        writers.load_upsert(spark, new, path("v1"), path("v1"), "k", "at")


def by_key(spark, parts):
    return {r.k: (r.at, r.v) for r in writers.read_parts(spark, parts, T.StructType.fromDDL("k string, at int, v int")).collect()}


def test_upsert_rewrites_only_files_that_hold_a_delivered_key(spark, path):
    rows = spark.range(2000).selectExpr("concat('K', id) as k", "1 as at", "cast(id as int) as v")
    rows.repartition(100, "k").write.parquet(path("v1"))
    files = set(writers.part_files(spark, path("v1")))
    assert len(files) == 100
    delivery = spark.createDataFrame([(f"K{i * 17}", at, -i) for i in range(9) for at in (2, 3)] + [("NEW", 2, 7)], "k string, at int, v int")
    assert writers.load_upsert(spark, delivery, path("v1"), path("v2"), "k", "at") <= 10 + 9 * 60
    after = set(writers.part_files(spark, path("v2")))
    assert len(files & after) >= 91 and not any(f.startswith(path("v1")) for f in after - files)
    expected = {f"K{i}": (1, i) for i in range(2000)} | {f"K{i * 17}": (3, -i) for i in range(9)} | {"NEW": (2, 7)}
    assert by_key(spark, [path("v2")]) == expected
    assert by_key(spark, [path("v1")])["K17"] == (1, 17)  # the version before stays as it was
    # Files kept twice in a row, and a repeated load.
    more = spark.createDataFrame([("K1", 5, 5), (None, 5, 6)], "k string, at int, v int")
    for _ in range(2):
        writers.load_upsert(spark, more, path("v2"), path("v3"), "k", "at")
    assert by_key(spark, [path("v3")]) == expected | {"K1": (5, 5), None: (5, 6)}
    assert len(files & set(writers.part_files(spark, path("v3")))) >= 90


def test_an_upsert_that_fails_is_not_a_part(spark, path, monkeypatch):
    rows = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "k string, at int, v int")
    rows.write.parquet(path("v1"))
    monkeypatch.setattr(writers, "counted_write", lambda *a: (_ for _ in ()).throw(OSError("crashed")))
    with pytest.raises(OSError):
        writers.load_upsert(spark, rows, path("v1"), path("v2"), "k", "at")
    assert not os.path.exists(path("v2") + "/_SUCCESS")
    monkeypatch.undo()
    writers.load_upsert(spark, rows.where("k = 'a'").selectExpr("k", "2 as at", "9 as v"), path("v1"), path("v2"), "k", "at")
    assert by_key(spark, [path("v2")]) == {"a": (2, 9), "b": (1, 2)}


def test_an_upsert_of_nothing_keeps_every_file(spark, path):
    rows = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "k string, at int, v int")
    rows.write.parquet(path("v1"))
    writers.load_upsert(spark, rows.limit(0), path("v1"), path("v2"), "k", "at")
    assert by_key(spark, [path("v2")]) == {"a": (1, 1), "b": (1, 2)} and set(writers.part_files(spark, path("v1"))) <= set(writers.part_files(spark, path("v2")))


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in ("bucketed_sales", "bucketed_returns"):
            writers.write_bucketed(spark.range(1000).selectExpr("cast(id as string) as sale_id", "id as n"), name, "sale_id", 4)
        joined = spark.table("bucketed_sales").join(spark.table("bucketed_returns"), "sale_id", "left")
        assert joined.count() == 1000
        assert "Exchange" not in plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_sales", "bucketed_returns"):
            spark.sql(f"drop table if exists {name}")


def test_audit_records_success_and_failure(spark, path):
    audit = path("audit")
    writers.audited_load(spark, "sales", "sales.json", "COPY INTO sales FROM @s", lambda: 5, audit)
    with pytest.raises(RuntimeError):
        writers.audited_load(spark, "returns", "returns.json", "COPY INTO returns FROM @s", _fail, audit)
    rows = {r.table_name: r for r in spark.read.parquet(audit).collect()}
    assert (rows["sales"].status, rows["sales"].row_count) == ("LOADED", 5)
    assert (rows["returns"].status, rows["returns"].error_code, rows["returns"].error_message) == ("FAIL", "RuntimeError", "no disk")


def _fail():
    raise RuntimeError("no disk")


def test_monitoring_windows_and_limits(spark):
    def row(i, status="LOADED", at="2024-01-01 10:00:00", statement="COPY INTO sales FROM @s"):
        return (str(i), "sales", f"f{i}", "me", "ingest", status, None, None, None, None, at, "2024-01-01 12:00:30", statement)

    raw_rows = [row(1), row(2, "FAIL", "2024-01-01 11:59:59"), row(3, at="2023-12-31 11:59:59"), row(4, statement="select 1"), row(5, statement="copy into")]
    text = spark.createDataFrame(raw_rows, monitoring.AUDIT_SCHEMA.replace("timestamp_ntz", "string"))
    audit = text.selectExpr("* except (received_at, loaded_at)", "cast(received_at as timestamp_ntz) received_at", "cast(loaded_at as timestamp_ntz) loaded_at")
    now = "2024-01-01 12:00:00"
    history = monitoring.load_history(audit, now).collect()
    assert [r.file_name for r in history] == ["f2", "f1", "f4", "f5"]
    assert (history[0].load_minutes, history[0].row_count) == (1, 0)
    assert monitoring.load_history(audit, now, hours=1).count() == 1
    assert monitoring.load_history(audit, now, limit=2).count() == 2
    assert [r.load_id for r in monitoring.recent_failures(audit, now).collect()] == ["2"]
    assert monitoring.recent_failures(audit, now, pool="other").count() == 0
    assert {r.load_id: r.target_table for r in monitoring.recent_copies(audit, now).collect()} == {"2": "sales", "1": "sales", "5": "Unknown"}


def test_table_profile_isolates_errors(spark, path):
    def table(name):
        return {"full": spark.range(3), "empty": spark.range(0)}[name] if name != "gone" else spark.read.parquet(path("gone"))

    got = {r.table_name: (r.row_count, r.column_count, r.status) for r in monitoring.table_profile(spark, table, ["full", "empty", "gone"]).collect()}
    assert got == {"full": (3, 1, "OK"), "empty": (0, 1, "EMPTY"), "gone": (None, None, "ERROR")}
    assert monitoring.sample_rows(spark.range(10)).count() == 3


def test_every_raw_table_is_declared():
    assert len(RAW_TABLES) == 10
    assert [len(RAW_TABLES[t].columns) for t in ("sales", "returns", "products", "customers", "stream_sales")] == [12, 13, 16, 15, 16]
