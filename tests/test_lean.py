"""What is shuffled and held in memory: each row once, narrow, and no table of groups that hold one row."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from rows import plan_of

from retailloom.operators import facts, quality
from retailloom.plans import registry
from retailloom.plans.warehouse import Warehouse
from retailloom.session import prepare_tables
from retailloom.sources import ndjson, orders_model, writers


@pytest.fixture
def no_broadcast(spark):
    prepare_tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def orders(spark):
    """Ten orders of three lines, one line delivered twice, one with null keys."""
    line = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    rows = [(o, o * 3 + n, n, n, 2.0, 10.0, 0.1, "R" if n == 1 else "N", "F", None) for o in range(10) for n in range(3)]
    rows += [rows[1], (None, None, None, None, 1.0, 1.0, 0.0, "R", "F", None)]
    tables = {
        "lineitem": spark.createDataFrame(rows, line),
        "orders": spark.range(10).selectExpr("id as o_orderkey", "id % 4 as o_custkey", "timestamp'1995-01-01' as o_orderdate", "'1-URGENT' as o_orderpriority"),
        "customer": spark.range(4).selectExpr("id as c_custkey", "id % 2 as c_nationkey"),
        "nation": spark.range(2).selectExpr("id as n_nationkey", "concat('N', id) as n_name", "id as n_regionkey"),
    }
    return lambda name: tables[name]


def test_lines_are_shuffled_once_and_grouped_in_order(spark, no_broadcast):
    sales = orders_model.sales(orders(spark))
    got = {r.sale_id: (r.quantity, r.total_amount) for r in sales.collect()}
    assert len(got) == 30 and got["S0-1-1-1"] == (4, 20) and got["S0-0-0-0"] == (2, 10)
    plan = plan_of(orders_model.sales(orders(spark)))
    assert plan.count("hashpartitioning(l_orderkey") == 1
    assert "SortAggregate" in plan and "HashAggregate" not in plan


def test_returns_and_stock_are_grouped_in_order(spark, no_broadcast):
    returns, stock = orders_model.returns(orders(spark)), orders_model.inventory(orders(spark))
    assert returns.count() == 10 and returns.where("sale_id = 'S0-1-1-1'").first().refund_amount == 2
    assert stock.count() == 31
    for df in (returns, stock):
        assert "HashAggregate" not in plan_of(df)


def test_repeated_keys_are_counted_from_sorted_rows(spark, no_broadcast):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    check = quality.unique("t", "k")
    assert quality.run_checks(spark, lambda _: rows, check).first().failing_rows == 1
    plan = plan_of(quality._repeated(lambda _: rows, {"t": list(enumerate(check))}, quality.fingerprint))
    assert "HashAggregate" not in plan and "SortAggregate" in plan


def test_stock_passes_over_missing_dates(spark):
    lines = spark.createDataFrame([(1, 1, None), (1, 1, "1995-01-02"), (1, 1, "1995-03-04"), (2, 1, None)], "l_partkey long, l_suppkey long, d string")
    lines = lines.selectExpr("l_partkey", "l_suppkey", "cast(d as timestamp) as l_shipdate")
    got = {r.product_id: (str(r.last_restocked), str(r.next_delivery_date)) for r in orders_model.inventory(lambda _: lines).collect()}
    assert got == {"P1": ("1995-01-02", "1995-04-03"), "P2": ("None", "None")}


def test_keys_that_may_and_may_not_be_null_are_checked_together(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", None), ("b", None), ("b", None)], "k string, l string").withColumn("sk", F.md5(F.coalesce("k", F.lit("-"))))
    checks = [*quality.unique("t", "sk", "l", "k"), quality.unique_combination("t", "k", "l")]
    assert [r.failing_rows for r in quality.run_checks(spark, lambda _: rows, checks).orderBy("check_id").collect()] == [2, 0, 2, 1]


def test_hashed_keys_are_not_shuffled(spark, path):
    rows = spark.range(100).selectExpr("id", "date_add(date'2024-01-01', cast(id as int)) as day", "'x' as pad")
    wide = [F.md5(F.col("id").cast("string")).alias("sk"), "id", "day"]
    assert writers.write_clustered(rows, path("t"), "day", ("day", "id"), wide) == 100
    want = rows.select(*wide)
    back = writers.read_clustered(spark, path("t"), want.schema, "day")
    assert back.exceptAll(want).count() == 0 and back.count() == 100
    plan = plan_of(writers._by_month(rows, "day", ("day", "id"), wide))
    steps = {part.split("\n")[0].rsplit(" ", 1)[-1]: part for part in plan.split("\n\n") if part.startswith("(")}
    assert "md5" not in steps["Exchange"] + steps["Sort"] and "sk#" not in steps["Exchange"] and "sk#" in steps["AdaptiveSparkPlan"]


def test_a_fact_is_asked_without_being_stored(spark, path):
    wh = Warehouse(spark, lambda entity: orders_model.build(entity, orders(spark)), path("wh"), "2002-01-01 00:00:00")
    asked = sorted(map(str, wh.asked("fact_sales").collect()))
    assert not os.path.exists(f"{wh.root}/fact_sales")
    assert asked == sorted(map(str, wh.mart("fact_sales").collect())) and len(asked) == 30
    assert os.path.exists(f"{wh.root}/fact_sales") and str(wh.root) in wh.asked("fact_sales").inputFiles()[0]
    assert wh.mart("fact_sales").columns == facts.fact_sales(wh.staged("stg_sales"), wh.staged("stg_returns")).columns


def test_a_value_is_cast_once_and_reasons_stay(spark, path):
    good = '{"sale_id":"S1","sale_date":"2024-01-01","customer_id":"C1","product_id":"P1","product_name":"p","quantity":2,' \
        '"unit_price":1.5,"total_amount":3.0,"channel":"online","store_id":null,"country":"France"}'
    lines = [good, good.replace('"quantity":2,', ""), good.replace('"quantity":2', '"quantity":"x"'), "{", "null", "{}"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path("in"))
    fit, bad = ndjson.quarantine_split(spark, path("in"), "sales", "2024-01-01 00:00:00")
    reasons = {r.raw_line: r.reject_reason for r in bad.collect()}
    assert fit.count() == 1 and reasons[lines[1]] == "missing:quantity" and reasons[lines[2]] == "bad_value:quantity"
    assert reasons["{"] == "malformed" and reasons["{}"].startswith("missing:sale_id,sale_date,")
    assert sum(line.endswith("Generate") or "Generate [" in line for line in plan_of(bad).splitlines() if line.startswith("(")) == 2


def test_lines_are_stored_packed(spark, path):
    df = spark.range(10).selectExpr("cast(id as string) as a")
    ndjson.write_ndjson(df, path("out"))
    assert {n.rsplit(".", 1)[1] for n in os.listdir(path("out")) if n.startswith("part-")} == {"lz4"}
    assert ndjson.read_lines(spark, path("out")).count() == 10


def test_questions_about_sales_alone_do_not_join_returns(spark, path, no_broadcast):
    wh = Warehouse(spark, lambda entity: orders_model.build(entity, orders(spark)), path("wh"), "2002-01-01 00:00:00")
    asked = wh.asked("fact_sales", {"sale_sk", "sale_id", "gross_amount"})
    plan = plan_of(asked)
    assert "Join" not in plan and "Exchange" not in plan
    whole = wh.asked("fact_sales", {"sale_id", "net_amount"})
    assert "return_count" in whole.columns and "Join" in plan_of(whole)
    assert sorted(map(str, asked.collect())) == sorted(map(str, whole.select(*asked.columns).collect())) and asked.count() == 30
    assert wh.asked("fact_sales", {"*"}).count() == 30


def test_the_columns_of_checks_are_named_for_children_and_parents():
    checks = [quality.relationship("c", "k", "p", "sk"), *quality.unique("p", "id"), quality.unique_combination("c", "a", "b")]
    assert quality.columns_of(checks) == {"c": {"k", "a", "b"}, "p": {"sk", "id"}}


def test_both_halves_of_a_wide_mark_hash_the_key(spark):
    """Keys that share the first number must not share the second for that reason alone."""
    keys = spark.range(5).selectExpr("cast(id as string) as k")
    marks = keys.selectExpr(f"stack(1, {quality._wide_mark('k')}) as (one, two)", "xxhash64(k, 'second') as of_the_first")
    assert marks.where("two = of_the_first").count() == 0 and marks.select("one", "two").distinct().count() == 5


def test_damaged_unique_tables_are_worked_out_once(spark, monkeypatch):
    rows = spark.createDataFrame([("S3", 1), ("S13", 2), ("S13", 2), ("S4", 3), (None, 4)], "sale_id string, n int")
    seen = []
    monkeypatch.setattr(registry.checks, "ALL_CHECKS", quality.unique("sales", "sale_id"))

    def run(spark, table, checks):
        seen.append(table("sales"))
        return spark.createDataFrame([], "check_name int, table_name int, column_name int, severity int, failing_rows int, status int")

    monkeypatch.setattr(registry.quality, "run_checks", run)
    registry.damaged("unique")(SimpleNamespace(spark=spark, asked=lambda name, columns: rows))
    assert "Union" not in plan_of(seen[0])
    assert sorted(map(str, seen[0].collect())) == sorted(map(str, rows.unionByName(rows.where("sale_id like '%3'")).collect()))


def test_a_months_refresh_tells_late_sales_apart_without_a_join(spark, path, no_broadcast, monkeypatch):
    wh = Warehouse(spark, lambda entity: orders_model.build(entity, orders(spark)), path("wh"), "2002-01-01 00:00:00")
    first, write = [], writers.write_clustered
    monkeypatch.setattr(writers, "write_clustered", lambda df, *args: (first.append(df), write(df, *args)))
    got = registry.clustered_month_refresh(wh)
    want = facts.fact_sales(wh.staged("stg_sales"), wh.staged("stg_returns"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == 30
    assert first[0].count() == 0 and "LeftAnti" not in plan_of(first[0])


def test_many_repeated_keys_are_counted_by_value_in_one_shuffle(spark, no_broadcast, monkeypatch):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("c", None), (None, None), (None, None)], "k string, n int")
    checks = {"t": list(enumerate([*quality.unique("t", "k", "n"), quality.unique_combination("t", "k", "n")]))}
    for weak in (quality.fingerprint, lambda _: "7L"):  # all keys collide under the second mark
        results = []
        for few in (quality.FEW, 1, 0):
            monkeypatch.setattr(quality, "FEW", few)
            counted = quality._duplicate_metrics(spark, lambda _: rows, checks, weak)
            results.append({r.check_id: r.failing_rows for r in counted.collect() if r.failing_rows})
            assert few or "Join" not in plan_of(counted)
        assert results == [{0: 1, 1: 1, 2: 2}] * 3
        monkeypatch.undo()


def test_sales_not_stored_yet_meet_their_returns_where_they_are_built(spark, path, no_broadcast):
    tables = {name: orders(spark)(name) for name in ("lineitem", "orders", "customer", "nation")}
    # An order known twice; a line below zero, and one returned in two states.
    tables["orders"] = tables["orders"].union(tables["orders"].where("o_orderkey = 3"))
    one = tables["lineitem"].where("l_orderkey = 3 and l_linenumber = 1")
    again = one.withColumns({"l_linestatus": F.lit("O"), "l_linenumber": F.lit(-1)})
    tables["lineitem"] = tables["lineitem"].union(one.withColumn("l_linestatus", F.lit("O"))).union(again)

    def warehouse(name, *dealt):
        return Warehouse(spark, lambda e: orders_model.build(e, tables.get), path(name), "2002-01-01 00:00:00", None, None, *dealt)

    dealt = warehouse("dealt", lambda e: orders_model.build(e, tables.get, [orders_model.DEALT_BY]), orders_model.DEALT_BY)
    fact = dealt.net_sales(facts.fact_sales)
    plan = plan_of(fact)
    assert "hashpartitioning(sale_id" not in plan and "sale_id#" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    assert not os.path.exists(path("dealt"))
    plain = warehouse("plain").net_sales(facts.fact_sales)
    assert fact.columns == plain.columns and plain.count() == 35
    assert fact.exceptAll(plain).count() == plain.exceptAll(fact).count() == 0
    assert sorted(r.return_count for r in fact.where("return_count > 0 and sale_id like 'S3-%'").collect()) == [2, 2, 4, 4]
    dealt.raw("sales")
    assert dealt.net_sales(facts.fact_sales).exceptAll(plain).count() == 0


def test_a_months_refresh_joins_sales_and_returns_where_they_are_built(spark, path, no_broadcast):
    tables = {name: orders(spark)(name) for name in ("lineitem", "orders", "customer", "nation")}
    tables["orders"] = tables["orders"].withColumn("o_orderdate", F.expr("timestamp'1995-01-28' + make_interval(0, 0, 0, cast(o_orderkey as int))"))
    wh = Warehouse(
        spark, lambda e: orders_model.build(e, tables.get), path("dealt"), "2002-01-01 00:00:00", None, None,
        lambda e: orders_model.build(e, tables.get, [orders_model.DEALT_BY]), orders_model.DEALT_BY)
    got = registry.clustered_month_refresh(wh)
    assert not os.path.exists(path("dealt"))
    want = facts.fact_sales(wh.staged("stg_sales"), wh.staged("stg_returns"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == 30
    assert got.select(F.month("sale_date")).distinct().count() == 2
