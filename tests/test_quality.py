from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import event, raw, returned, sale

from retailloom.operators import quality, reports
from retailloom.operators.quality import QualityGateError
from retailloom.plans import checks

AS_OF = "2024-01-01 11:01:00"


def results(spark, tables, specs):
    got = quality.run_checks(spark, tables.__getitem__, specs).collect()
    return {(r.check_name, r.column_name): (r.failing_rows, r.status) for r in got}


def test_declared_checks_are_complete():
    assert [len(c) for c in (checks.RAW_CHECKS, checks.STAGING_CHECKS, checks.MART_CHECKS, checks.ALL_CHECKS)] == [28, 34, 48, 110]


def test_check_kinds_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 5, "y"), (None, None, None), (None, 9, "z"), ("b", 0, "x")], "k string, n int, v string"
    )
    parent = spark.createDataFrame([("a",), (None,)], "id string")
    got = results(spark, {"t": df, "p": parent}, [
        *quality.not_null("t", "k"), *quality.unique("t", "k"), quality.accepted_values("t", "v", ["x", "y"], severity="warn"),
        quality.between("t", "n", 1, 5), quality.relationship("t", "k", "p", "id"), quality.unique_combination("t", "k", "v"),
        quality.between("t", "n", 0, severity="warn"),
    ])
    assert got[("not_null", "k")] == (2, "fail")
    assert got[("unique", "k")] == (1, "fail")  # repeated NULLs are not duplicates
    assert got[("accepted_values", "v")] == (1, "warn")  # NULL passes
    assert got[("relationships", "k")] == (1, "fail")  # NULL keys are ignored
    assert got[("unique_combination", "k,v")] == (0, "pass")
    assert got[("between", "n")] == (0, "pass")


def test_unique_combination_counts_null_as_value(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert results(spark, {"t": df}, [quality.unique_combination("t", "a", "b")])[("unique_combination", "a,b")] == (1, "fail")


def test_checks_on_an_empty_table_pass(spark):
    df = spark.createDataFrame([], "k string, n int")
    got = results(spark, {"t": df}, [*quality.not_null("t", "k"), *quality.unique("t", "k"), quality.relationship("t", "k", "t", "k")])
    assert set(got.values()) == {(0, "pass")}


def test_report_counts_null_keys_as_orphans(spark):
    tables = {"returns": raw(spark, "returns", returned(), returned(sale_id=None), returned(sale_id="S9"), returned(sale_id="S9")),
              "sales": raw(spark, "sales", sale())}
    df = reports.referential_integrity_report(tables.__getitem__, [("returns_without_sale", "returns", "sale_id", "sales", "sale_id")])
    assert df.first().offending_rows == 3


def test_check_gate_ignores_warnings(spark):
    df = spark.createDataFrame([(None,)], "k string")
    quality.check_gate(quality.run_checks(spark, lambda _: df, quality.not_null("t", "k", severity="warn")))
    with pytest.raises(QualityGateError, match="not_null on t.k: 1"):
        quality.check_gate(quality.run_checks(spark, lambda _: df, quality.not_null("t", "k")))


def stamped(spark, entity, *moments):
    return raw(spark, entity, *(dict(created_at=m) for m in moments))


def test_freshness_counts_hour_boundaries(spark):
    tables = {"sales": stamped(spark, "sales", "2024-01-01 10:59:00"), "returns": stamped(spark, "returns"),
              "reviews": stamped(spark, "reviews", "2023-12-31 08:00:00")}
    sla = {"sales": ("created_at", 0), "returns": ("created_at", 6), "reviews": ("created_at", 27)}
    rows = reports.freshness_report(tables.__getitem__, sla, AS_OF).collect()
    assert [r.table_name for r in rows] == ["returns", "reviews", "sales"]  # never loaded first, then oldest
    assert {r.table_name: (r.hours_since_last_load, r.freshness_status) for r in rows} == {
        "returns": (None, "EMPTY"), "reviews": (27, "FRESH"), "sales": (1, "STALE")}


@pytest.mark.parametrize("loaded,status", [("2024-01-01 10:02:00", "pass"), ("2024-01-01 10:00:00", "warn"), ("2023-12-30 11:00:00", "error"), (None, "error")])
def test_source_freshness(spark, loaded, status):
    df = stamped(spark, "sales", *([loaded] if loaded else []))
    assert reports.source_freshness(lambda _: df, {"sales": ("created_at", 3600, 86400)}, AS_OF).first().status == status


def test_row_count_bounds(spark):
    tables = {n: spark.range(c) for n, c in {"a": 1, "b": 5, "c": 9}.items()}
    got = reports.row_count_report(spark, tables.__getitem__, {n: (2, 8) for n in tables}).collect()
    assert [(r.table_name, r.status) for r in got] == [("b", "OK"), ("c", "OVER_MAX"), ("a", "UNDER_MIN")]


def test_batch_gate_lists_every_breach(spark):
    freshness = spark.createDataFrame([("a", "STALE"), ("b", "EMPTY"), ("c", "FRESH")], "table_name string, freshness_status string")
    integrity = spark.createDataFrame([("x", 0), ("y", 2)], "check_name string, offending_rows long")
    counts = spark.createDataFrame([("a", 1, "UNDER_MIN"), ("b", 5, "OK")], "table_name string, actual_rows long, status string")
    with pytest.raises(QualityGateError) as breach:
        quality.batch_gate(freshness, integrity, counts)
    assert len(breach.value.breaches) == 4
    quality.batch_gate(freshness.limit(0), integrity.where("offending_rows = 0"), counts.where("status = 'OK'"))


def stream_gate(spark, as_of, *rows):
    df = raw(spark, "stream_sales", *rows)
    quality.stream_gate(reports.stream_freshness_report(df, as_of), reports.stream_exactly_once_report(df))


def test_stream_gate_rules(spark):
    stream_gate(spark, datetime(2025, 3, 2, 10, 5, 59))  # empty passes
    stream_gate(spark, datetime(2025, 3, 2, 10, 5, 59), event())
    with pytest.raises(QualityGateError, match="last grew 6 minutes ago"):
        stream_gate(spark, datetime(2025, 3, 2, 10, 6, 0), event())
    with pytest.raises(QualityGateError, match="1 offsets landed more than once"):
        stream_gate(spark, datetime(2025, 3, 2, 10, 1, 0), event(), event(event_id="e2"))


def test_empty_load_gate():
    assert quality.empty_load_gate({"sales": 0, "returns": 3}) == 3
    with pytest.raises(QualityGateError):
        quality.empty_load_gate({"sales": 0, "returns": 0})


def test_throughput_window(spark):
    df = raw(spark, "stream_sales", event(), event(event_id="e2", kafka_partition=2, event_ts="2025-03-02 10:00:01"),
             event(event_id="e3", ingested_at="2025-03-02 09:00:00"))
    row = reports.stream_throughput_report(df, "2025-03-02 10:10:00").first()
    assert (row.events_last_15min, row.avg_latency_seconds, row.max_latency_seconds, row.active_partitions) == (2, 1.0, 1.5, 2)


def test_uniqueness_shares_one_shuffle_across_tables(spark):
    df = spark.range(10).withColumn("v", F.col("id") % 3)
    plan = quality.run_checks(spark, lambda _: df, [*quality.unique("a", "id"), *quality.unique("b", "v"), *quality.unique("c", "id", "v")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(check_id") == 2  # (check, value), then check


def test_minimum_counts_and_shapes(spark):
    df = spark.createDataFrame([("S1",), ("X2",), (None,)], "k string")
    got = results(spark, {"t": df}, [quality.shaped("t", "k", "S"), quality.at_least("t", 5), quality.at_least("t", 3, severity="warn")])
    assert got[("shaped", "k")] == (1, "fail")
    rows = quality.run_checks(spark, lambda _: df, [quality.at_least("t", 5), quality.at_least("t", 3)]).orderBy("check_id").collect()
    assert [(r.failing_rows, r.status) for r in rows] == [(2, "fail"), (0, "pass")]


def damaged(spark):
    """Repeated and colliding keys: text, numbers and combinations, with NULLs."""
    t = spark.createDataFrame(
        [("a", 1, None), ("a", 2, None), ("b", 3, "x"), ("c", 3, "x"), (None, 4, "y"), (None, 4, "y"), ("d", 5, None)], "k string, n int, v string")
    other = spark.createDataFrame([("a", 1.5), ("z", 1.5), ("q", None)], "k string, w double")
    specs = [*quality.unique("t", "k", "n"), quality.unique_combination("t", "n", "v"), quality.unique_combination("t", "k", "v"), *quality.unique("o", "k", "w")]
    return {"t": t, "o": other}, specs


EXPECTED_REPEATS = {0: 1, 1: 2, 2: 2, 3: 2, 5: 1}


@pytest.mark.parametrize("mark", [quality.fingerprint, lambda columns: "7L", lambda columns: f"pmod(xxhash64(`{columns[0]}`), 2L)"])
def test_colliding_fingerprints_are_settled_by_value(spark, mark):
    tables, specs = damaged(spark)
    checks_of = {}
    for i, c in enumerate(specs):
        checks_of.setdefault(c.table, []).append((i, c))
    found = quality._duplicate_metrics(spark, tables.__getitem__, checks_of, mark)
    assert {r.check_id: r.failing_rows for r in found.collect() if r.failing_rows} == EXPECTED_REPEATS


def test_sound_keys_are_not_looked_at_again(spark):
    tables = {"t": spark.range(100).selectExpr("id as k", "cast(id as string) as s")}
    checks_of = {"t": list(enumerate([*quality.unique("t", "k", "s"), quality.unique_combination("t", "k", "s")]))}
    assert quality._duplicate_metrics(spark, tables.__getitem__, checks_of) is None


def shuffled_bytes(spark, work):
    """Bytes that the stages of ``work`` wrote to shuffles."""
    store = spark._jsc.sc().statusStore()

    def total():
        stages = store.stageList(None, False, False, spark._sc._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = total()
    work()
    return total() - before


def test_fingerprints_at_least_halve_what_is_shuffled(spark):
    rows = spark.range(60_000).selectExpr(
        "md5(cast(id as string)) as sale_sk", "concat('SALE-', lpad(cast(pmod(xxhash64(id), 1000000007) as string), 12, '0'), '-', id) as sale_id",
        "md5(cast(id % 977 as string)) as customer_sk").cache()
    rows.count()
    tables = {"t": rows}
    specs = [*quality.unique("t", "sale_sk", "sale_id"), quality.unique_combination("t", "sale_sk", "customer_sk")]

    def as_text():
        single = rows.selectExpr("stack(2, 0, sale_sk, 1, sale_id) as (check_id, value)").groupBy("check_id", "value").count().where("count > 1")
        both = rows.selectExpr("2 as check_id", "array(sale_sk, customer_sk) as value").groupBy("check_id", "value").count().where("count > 1")
        assert single.count() == both.count() == 0

    old = shuffled_bytes(spark, as_text)
    new = shuffled_bytes(spark, lambda: quality.run_checks(spark, tables.__getitem__, specs).collect())
    assert 0 < 2 * new <= old, (new, old)
