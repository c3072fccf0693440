"""Tables in folders by month: what a day's query reads, and what a new day rewrites."""

import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import plan_of

from retailloom.sources import writers

SCHEMA = "id bigint, day date, v int"


def rows(spark, first="2023-11-01", days=120):
    return spark.range(days * 5).selectExpr("id", f"date_add(date'{first}', cast(id % {days} as int)) as day", "cast(id % 7 as int) as v")


def files(target):
    return {os.path.join(d, n): os.path.getmtime(os.path.join(d, n)) for d, _, names in os.walk(target) for n in names if n.endswith(".parquet")}


def month_of(file):
    return file.split(f"{writers.MONTH}=")[1].split("/")[0]


def everything(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_day_reads_one_folder(spark, path):
    df = rows(spark)
    assert writers.write_clustered(df, path("t"), "day") == 600
    assert {month_of(f) for f in files(path("t"))} == {"202311", "202312", "202401", "202402"}
    one = writers.read_clustered(spark, path("t"), df.schema, "day", "2024-01-15", date(2024, 1, 15))
    assert everything(one) == everything(df.where("day = '2024-01-15'")) != []
    scan = next(line for line in plan_of(one).splitlines() if "PartitionFilters" in line)
    assert "202401" in scan and writers.MONTH in scan
    assert {month_of(r.f) for r in one.select(F.input_file_name().alias("f")).distinct().collect()} == {"202401"}
    over = writers.read_clustered(spark, path("t"), df.schema, "day", "2023-12-30", "2024-01-02")
    assert everything(over) == everything(df.where("day between '2023-12-30' and '2024-01-02'"))
    assert everything(writers.read_clustered(spark, path("t"), df.schema, "day")) == everything(df)


def test_a_new_day_rewrites_one_month(spark, path):
    old = rows(spark)
    writers.write_clustered(old, path("t"), "day")
    before = files(path("t"))
    new = spark.createDataFrame([(9001, date(2024, 2, 29), 1), (9002, date(2024, 2, 29), 2)], SCHEMA)
    whole = old.unionByName(new)
    changed = writers.whole_months(whole, "day", new, "day")
    assert changed.select(F.date_trunc("month", "day")).distinct().count() == 1
    for _ in range(2):  # repeating it changes nothing
        assert writers.rewrite_months(changed, path("t"), "day") == changed.count()
        after = files(path("t"))
        same = {f for f in before if after.get(f) == before[f]}
        assert {month_of(f) for f in same} == {"202311", "202312", "202401"} and {month_of(f) for f in set(after) - same} == {"202402"}
        assert everything(writers.read_clustered(spark, path("t"), old.schema, "day")) == everything(whole)


def test_rows_without_a_day(spark, path):
    df = spark.createDataFrame([(1, None, 1), (2, date(2024, 1, 1), 2), (3, None, 3)], SCHEMA)
    writers.write_clustered(df, path("t"), "day")
    assert everything(writers.read_clustered(spark, path("t"), df.schema, "day")) == everything(df)
    more = spark.createDataFrame([(4, None, 4)], SCHEMA)
    whole = df.unionByName(more)
    writers.rewrite_months(writers.whole_months(whole, "day", more, "day"), path("t"), "day")
    assert everything(writers.read_clustered(spark, path("t"), df.schema, "day")) == everything(whole)
    assert writers.whole_months(whole, "day", more.limit(0), "day").count() == 0


def shuffle_files(spark):
    found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_a_full_refresh_is_laid_out_in_parts_that_leave_nothing_behind(spark, path, monkeypatch):
    df = rows(spark).unionByName(spark.createDataFrame([(9001, None, 1)], SCHEMA)).repartition(3)
    held, parts, lay_out = shuffle_files(spark), [], writers._by_month
    monkeypatch.setattr(writers, "scratch_path", lambda spark, label: path(label))
    monkeypatch.setattr(writers, "_by_month", lambda df, *args: (parts.append(everything(df)), lay_out(df, *args))[1])
    assert writers.write_clustered(df, path("t"), "day") == 601
    assert everything(writers.read_clustered(spark, path("t"), df.schema, "day")) == everything(df)
    assert len(parts) == writers.SLICES and sum(map(len, parts)) == 601 and max(map(len, parts)) < 300
    months = [{r[1] and r[1].month for r in part} for part in parts]
    assert sum(map(len, months)) == len(set().union(*months)) == 5
    assert not os.path.exists(path("unclustered")) and spark.conf.get(writers._TIDY) == "false"
    monkeypatch.undo()
    writers.rewrite_months(writers.whole_months(df, "day", df.where("id = 1"), "day"), path("t"), "day")
    held |= shuffle_files(spark)  # what the test itself asked for is not taken away
    writers.write_clustered(df, path("t"), "day")
    for _ in range(50):
        if shuffle_files(spark) <= held:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= held


def test_an_empty_refresh_empties_and_a_failed_one_leaves_no_part(spark, path):
    df = rows(spark)
    writers.write_clustered(df, path("t"), "day")
    writers.write_clustered(df.limit(0), path("t"), "day")
    assert everything(writers.read_clustered(spark, path("t"), df.schema, "day")) == []
    bad = F.when(F.month("day") == 11, F.raise_error(F.lit("no such day"))).otherwise(F.col("v")).cast("int").alias("v")
    with pytest.raises(Exception, match="no such day"):
        writers.write_clustered(df, path("t"), "day", None, ["id", "day", bad])
    assert not os.path.exists(path("t")) and spark.conf.get(writers._TIDY) == "false"
