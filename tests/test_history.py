from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from rows import customer, plan_of, raw, sale

from retailloom.operators import history
from retailloom.operators.staging import stage

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def customers(spark, *rows):
    return stage(raw(spark, "customers", *rows), "stg_customers")


def versions(df):
    return sorted((r.customer_id, str(r.valid_from)[:10], str(r.valid_to)[:10], r.segment) for r in df.collect())


@pytest.fixture
def first(spark):
    return history.scd2(None, customers(spark, customer(), customer(customer_id="C2", last_purchase_date=None), customer(customer_id="C3")), T1)


def test_no_change_adds_nothing(spark, first):
    same = customers(spark, customer(), customer(customer_id="C2", last_purchase_date=None), customer(customer_id="C3"))
    again = history.scd2(history.scd2(first, same, T2), same, T3)
    assert versions(again) == versions(first)


def test_tracked_change_closes_and_opens(spark, first):
    later = customers(spark, customer(segment="Gold"), customer(customer_id="C2"), customer(customer_id="C4"))
    assert versions(history.scd2(first, later, T2)) == [
        ("C1", "2024-01-01", "2024-02-01", "VIP"), ("C1", "2024-02-01", "None", "Gold"),
        ("C2", "2024-01-01", "2024-02-01", "VIP"), ("C2", "2024-02-01", "None", "VIP"),  # NULL became a value
        ("C3", "2024-01-01", "None", "VIP"),  # deleted at the source, stays open
        ("C4", "2024-02-01", "None", "VIP"),
    ]


def test_untracked_change_is_ignored(spark, first):
    renamed = customers(spark, customer(first_name="Augusta"))
    got = history.scd2(first, renamed, T2).where("customer_id = 'C1'").collect()
    assert len(got) == 1 and got[0].first_name == "Ada"


def test_version_ids_are_unique(spark, first):
    later = history.scd2(first, customers(spark, customer(segment="Gold")), T2)
    assert later.select("scd_id").distinct().count() == later.count()


def point_in_time_rows(spark, hot=None):
    moved = history.scd2(history.scd2(None, customers(spark, customer()), T1), customers(spark, customer(segment="Gold")), T2)
    days = ["2023-12-31", "2024-01-01", "2024-01-31", "2024-02-01", "2030-01-01"]
    sales = stage(raw(spark, "sales", *(sale(sale_id=f"S{i}", sale_date=d) for i, d in enumerate(days)), sale(sale_id="S9", customer_id="C9")), "stg_sales")
    joined = history.point_in_time(sales, moved, "sale_date", hot=hot)
    return sorted((r.sale_id, r.at_sale_segment) for r in joined.collect()), joined


def test_point_in_time_picks_the_valid_version(spark):
    got, joined = point_in_time_rows(spark)
    assert got == [("S0", None), ("S1", "VIP"), ("S2", "VIP"), ("S3", "Gold"), ("S4", "Gold"), ("S9", None)]
    assert joined.columns.count("customer_id") == 1 and "_salt" not in joined.columns


def test_point_in_time_salted_is_the_same(spark):
    assert point_in_time_rows(spark, hot=["C1"])[0] == point_in_time_rows(spark)[0]


def test_a_fact_meets_the_versions_of_its_month_only(spark):
    """A key of 1,000 versions, one every second day, and 10,000 facts."""
    from datetime import timedelta

    begin = datetime(2019, 1, 1, 12)
    marks = [begin + timedelta(days=2 * i) for i in range(1001)]
    rows = [("C1", a, b if i < 999 else None, f"s{i}") for i, (a, b) in enumerate(zip(marks, marks[1:]))]
    moved = spark.createDataFrame(rows, "customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, segment string")
    facts = spark.range(10_000).selectExpr(
        "'C1' as customer_id", "id as n", "timestamp_ntz'2018-12-01 00:00:00' + make_dt_interval(0, id * 5) as at").cache()
    joined = history.point_in_time(facts, moved, "at", attributes=["segment"])
    for r in joined.where("n % 97 = 0").collect():
        valid = [s for _, a, b, s in rows if a <= r["at"] and (b is None or r["at"] < b)]
        assert r.at_sale_segment == (valid[0] if valid else None)
    assert joined.count() == 10_000
    slot = history.month_slot(F.col("at"))
    spread = history.by_month(moved, facts.agg(F.min(slot).alias("low"), F.max(slot).alias("high")))
    met = facts.withColumn("_slot", slot).join(spread, ["customer_id", "_slot"]).count()
    assert met < 18 * 10_000 and spread.count() < 1_100
    assert any(line.startswith("Left keys") and "customer_id" in line and "_month" in line for line in plan_of(joined).splitlines())


def test_point_in_time_at_the_edges(spark):
    moved = spark.createDataFrame(
        [("C1", datetime(2024, 1, 1), datetime(2024, 2, 1), "a"), ("C1", datetime(2024, 2, 1), None, "b"), (None, datetime(2000, 1, 1), None, "x")],
        "customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, segment string")
    facts = spark.createDataFrame(
        [("C1", datetime(2024, 1, 31, 23, 59, 59, 999999)), ("C1", datetime(2024, 2, 1)), ("C1", datetime(9998, 1, 1)), ("C1", None), (None, datetime(2024, 1, 5))],
        "customer_id string, at timestamp_ntz")
    got = sorted((str(r["at"])[:10], r.customer_id or "", r.at_sale_segment or "") for r in history.point_in_time(facts, moved, "at", attributes=["segment"]).collect())
    assert got == [("2024-01-05", "", ""), ("2024-01-31", "C1", "a"), ("2024-02-01", "C1", "b"), ("9998-01-01", "C1", "b"), ("None", "C1", "")]
    assert history.point_in_time(facts.limit(0), moved, "at", attributes=["segment"]).count() == 0


def test_point_in_time_keeps_the_equality(spark, path):
    moved = history.scd2(None, customers(spark, customer(), customer(customer_id="C2")), datetime(2024, 1, 1))
    moved.write.parquet(path("history"))
    stage(raw(spark, "sales", sale()), "stg_sales").write.parquet(path("sales"))
    joined = history.point_in_time(spark.read.parquet(path("sales")), spark.read.parquet(path("history")), "sale_date")
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_stored_history_rewrites_no_closed_version(spark, path):
    root = path("history")
    deliveries = [(T1, customer()), (T2, customer(segment="Gold")), (T3, customer(segment="Gold", lifetime_value=7))]
    for as_of, row in deliveries:
        history.record_snapshot(spark, root, customers(spark, row), as_of)
    expected = None
    for as_of, row in deliveries:
        expected = history.scd2(expected, customers(spark, row), as_of)
    stored = history.read_history(spark, root)
    assert versions(stored) == versions(expected) and stored.columns == expected.columns
    history.record_snapshot(spark, root, customers(spark, deliveries[-1][1]), T3)  # a repeated run changes nothing
    assert versions(history.read_history(spark, root)) == versions(expected)
    assert spark.read.parquet(f"{root}/run=t20240301000000000000/closed=true").count() == 1


def test_conflicting_observations_fail(spark):
    with pytest.raises(PySparkException, match="conflicting rows for key C1"):
        history.scd2(None, customers(spark, customer(), customer(segment="Gold")), T1).collect()
    assert history.scd2(None, customers(spark, customer(), customer()), T1).count() == 1


def test_two_runs_within_a_second_are_two(spark, path):
    for at, segment in (("2024-01-01 00:00:00.100", "VIP"), ("2024-01-01 00:00:00.900", "Gold")):
        history.record_snapshot(spark, path("h"), customers(spark, customer(segment=segment)), at)
    assert {(r.segment, r.valid_to is None) for r in history.read_history(spark, path("h")).collect()} == {("VIP", False), ("Gold", True)}
    assert history.run_label("2024-01-01 02:00:00+02:00") == history.run_label("2024-01-01") == "t20240101000000000000"


def test_an_interrupted_run_is_not_seen(spark, path, tmp_path):
    history.record_snapshot(spark, path("h"), customers(spark, customer()), T1)
    (tmp_path / "h" / "run=t20240201000000000000" / "_temporary").mkdir(parents=True)
    assert history.read_history(spark, path("h")).count() == 1
    history.record_snapshot(spark, path("h"), customers(spark, customer(segment="Gold")), T2)
    assert history.read_history(spark, path("h")).count() == 2


def test_an_empty_run_can_be_followed(spark, path):
    history.record_snapshot(spark, path("h"), customers(spark), T1)
    assert history.read_history(spark, path("h")).count() == 0
    history.record_snapshot(spark, path("h"), customers(spark, customer()), T2)
    assert versions(history.read_history(spark, path("h"))) == [("C1", "2024-02-01", "None", "VIP")]


def test_older_or_different_runs_are_refused(spark, path):
    history.record_snapshot(spark, path("h"), customers(spark, customer()), T2)
    with pytest.raises(history.HistoryOrderError):
        history.record_snapshot(spark, path("h"), customers(spark, customer()), T1)
    with pytest.raises(history.HistoryOrderError):
        history.record_snapshot(spark, path("h"), customers(spark, customer(segment="Gold")), T2)


def test_a_run_writes_what_changed_and_folds_now_and_then(spark, path):
    expected = None
    for step in range(7):
        rows = [customer(customer_id=f"C{i}", segment=f"s{step if i % 100 == step else 0}") for i in range(200)] if step != 4 else [customer(customer_id="C0", segment="s0")]
        current, as_of = customers(spark, *rows), f"2024-01-0{step + 1} 00:00:00"
        expected = history.scd2(expected, current, as_of)
        history.record_snapshot(spark, path("h"), current, as_of, fold_every=3)
    assert versions(history.read_history(spark, path("h"))) == versions(expected)
    stored = spark.read.option("basePath", path("h")).parquet(*(f"{path('h')}/run={history.run_label(f'2024-01-0{d} 00:00:00')}" for d in (1, 2, 3)))
    counts = {(str(r.run)[8], str(r.closed) == "true" or r.closed is True): r["count"] for r in stored.groupBy("run", "closed").count().collect()}
    assert counts == {("1", False): 200, ("2", False): 2, ("2", True): 2, ("3", False): 4, ("3", True): 4}
    assert len(history._committed(spark, path("h"), "fold")) == 2
    again = customers(spark, *rows)
    history.record_snapshot(spark, path("h"), again, "2024-01-07 00:00:00", fold_every=3)  # the same outcome again
    assert versions(history.read_history(spark, path("h"))) == versions(expected)


def test_an_interrupted_fold_is_not_seen(spark, path, tmp_path):
    for i, as_of in enumerate((T1, T2)):
        history.record_snapshot(spark, path("h"), customers(spark, customer(segment=f"s{i}")), as_of)
    (tmp_path / "h" / f"fold={history.run_label(T2)}" / "_temporary").mkdir(parents=True)
    assert history.read_history(spark, path("h")).count() == 2
    history.record_snapshot(spark, path("h"), customers(spark, customer(segment="s2")), T3, fold_every=1)
    assert history.read_history(spark, path("h")).count() == 3
