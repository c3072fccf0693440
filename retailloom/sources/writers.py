"""Load strategies for raw tables, the layout of marts, and the load audit."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from threading import Lock
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailloom.operators.joins import per_key
from retailloom.operators.monitoring import AUDIT_SCHEMA
from retailloom.session import path_exists, scratch_path
from retailloom.sources import manifest


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run a write and return its row count, observed while writing."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def align_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The target's columns by exact, case-sensitive name; absent ones are NULL, extra ones dropped."""
    by_position = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    position = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return by_position.select(*(
        (F.col(position[f.name]) if f.name in position else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ))


def load_replace(df: DataFrame, target: str) -> int:
    """Replace the table by this load. Repeating it changes nothing."""
    return counted_write(df, lambda d: d.write.mode("overwrite").parquet(target))


def load_append(df: DataFrame, target: str, schema: T.StructType) -> int:
    """Append by column name. Nothing is deduplicated: loading twice doubles the rows."""
    aligned = align_by_name(df, schema)
    return counted_write(aligned, lambda d: d.write.mode("append").option("compression", "snappy").parquet(target))


def latest_per_key(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """One row per key, the one with the greatest ``order_by``; equal ones by their values.

    A maximum over whole rows instead of a ranking: tasks reduce their rows
    before the shuffle, so no key's rows are gathered in one place.
    """
    rest = [c for c in df.columns if c not in (key, order_by)]
    latest = df.groupBy(key).agg(F.max(F.struct(order_by, *rest)).alias("row"))
    return latest.select(*(F.col(c) if c == key else F.col(f"row.{c}").alias(c) for c in df.columns))


def upsert(existing: DataFrame, incoming: DataFrame, key: str, order_by: str) -> DataFrame:
    """``existing`` with the incoming rows' keys replaced. Repeating it changes nothing."""
    fresh = latest_per_key(incoming, key, order_by)
    replaced = per_key(incoming, key, F.count(F.lit(1)).alias("n")).select(key)
    return existing.join(replaced, key, "left_anti").select(*fresh.columns).unionByName(fresh)


#: In a written part: the files of earlier ones that belong to the table as they are.
KEPT_FILES = "_kept_files.json"


def part_files(spark: SparkSession, part: str) -> list[str]:
    """The data files of a part: its own, and those it kept of earlier ones. No file of an earlier part is listed again."""
    own = [f"{part}/{name}" for name in sorted(manifest.listed(spark, part))]
    kept = f"{part}/{KEPT_FILES}"
    if not path_exists(spark, kept):
        return own
    scheme, at, rest = part.rpartition("://")
    return own + [f"{scheme}{at}{posixpath.normpath(f'{rest}/{name}')}" for name in json.loads(manifest.text_of(spark, kept))]


def read_parts(spark: SparkSession, parts: list[str], schema: T.StructType) -> DataFrame:
    files = [f for part in parts for f in part_files(spark, part)]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def _local_name(path: str) -> str:
    """A file's path without scheme and host, as both the file system and Spark tell it."""
    return unquote(urlparse(path).path) if ":" in path.split("/")[0] else path


def load_upsert(spark: SparkSession, df: DataFrame, source: str | list[str], target: str, key: str, order_by: str) -> int:
    """Upsert into the table at ``source``, one folder or several, writing the result to a new path ``target``; returns the rows written.

    Copy on write, by files: only files that hold a delivered key are rewritten,
    without those keys; the delivery's rows come with them, and all other files stay part of the
    table under their names, as ``target`` notes. Which files those are is
    found by a semi-join over the key column alone, within the delivery's range of keys. The
    previous version stays readable. The delivery is reduced to its latest rows once and
    stored next to the target, as several steps hang on it.
    """
    sources = [source] if isinstance(source, str) else list(source)
    if target in sources:
        raise ValueError("an upsert is written to a new path, not over the table it reads")
    files = [f for s in sources for f in part_files(spark, s)]
    latest = latest_per_key(df, key, order_by)
    if not files:
        return counted_write(latest.sortWithinPartitions(key), lambda d: d.write.mode("overwrite").parquet(target))
    path = scratch_path(spark, "delivery")
    latest.write.parquet(path)
    fresh = spark.read.schema(latest.schema).parquet(path)
    reach = fresh.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    hit: set[str] = set()
    if reach.low is not None:
        held = spark.read.schema(df.schema).parquet(*files).where(F.col(key).between(reach.low, reach.high))
        named = held.select(key, F.col("_metadata.file_path").alias("file")).join(fresh.select(key), key, "left_semi")
        hit = {_local_name(r.file) for r in named.select("file").distinct().collect()}  # at most the table's files
    rewritten = [f for f in files if _local_name(f) in hit]
    merged = fresh
    if rewritten:
        before = spark.read.schema(df.schema).parquet(*rewritten)
        merged = before.join(fresh.select(key), key, "left_anti").select(*fresh.columns).unionByName(fresh)
    kept = [f for f in files if _local_name(f) not in hit]
    # The list stands before the rows are committed, so a part never lacks it.
    manifest.remove(spark, target)
    manifest.put(spark, f"{target}/{KEPT_FILES}", json.dumps([posixpath.relpath(_local_name(f), _local_name(target)) for f in kept]))
    return counted_write(merged.sortWithinPartitions(key), lambda d: d.write.mode("append").parquet(target))


#: The folder column of clustered tables: the month of their day, as yyyymm.
MONTH = "clustered_month"
#: The rows of a full refresh are laid out in so many parts, one after another, each of whole months.
SLICES, _SLICE = 4, "clustered_slice"

#: Takes the shuffle files of a query away when it ends.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_tidying, _tidy_lock = {"depth": 0, "before": None}, Lock()


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each query within are gone when it ends, not when the driver happens to collect its garbage.

    For writes and frames that are asked once: one that is asked again has to shuffle anew.
    """
    with _tidy_lock:
        if not _tidying["depth"]:
            _tidying["before"] = spark.conf.get(_TIDY, None)
            spark.conf.set(_TIDY, "true")
        _tidying["depth"] += 1
    try:
        yield
    finally:
        with _tidy_lock:
            _tidying["depth"] -= 1
            if not _tidying["depth"]:
                spark.conf.unset(_TIDY) if _tidying["before"] is None else spark.conf.set(_TIDY, _tidying["before"])


def _month(day: Column) -> Column:
    return 100 * F.year(day) + F.month(day)


def _by_month(df: DataFrame, day: str, sort_by: str | Sequence[str] | None, columns: Sequence[Column | str] | None) -> DataFrame:
    laid_out = df.withColumn(MONTH, _month(F.col(day))).hint("rebalance", MONTH)
    ordered = laid_out.sortWithinPartitions(MONTH, *([sort_by or day] if isinstance(sort_by or day, str) else sort_by))
    return ordered.select(*columns, MONTH) if columns else ordered


def write_clustered(
    df: DataFrame, target: str, day: str, sort_by: str | Sequence[str] | None = None, columns: Sequence[Column | str] | None = None
) -> int:
    """Full refresh, one folder per month of ``day``, sorted within files, so readers skip by folder and by range.

    One hash shuffle and no sampling pass, which would evaluate the input
    twice. Adaptive execution cuts a month holding much of the data into several
    files and merges small months into one task. Rows without a day have a folder of their own.
    ``columns`` are what is written, worked out of ``df`` after the shuffle: wide hashes are not shuffled.

    The rows are stored packed first, apart by ``SLICES`` groups of months, and each group is laid out by itself: the
    disk then never holds what ``df`` shuffles, the shuffle of all rows and the table at once.
    """
    spark = df.sparkSession
    path, written = scratch_path(spark, "unclustered"), 0
    apart = df.withColumn(_SLICE, F.coalesce(F.pmod(_month(F.col(day)), F.lit(SLICES)), F.lit(0)))
    with tidy(spark):
        apart.write.option("compression", "zstd").partitionBy(_SLICE).parquet(path)
        rows = spark.read.schema(T.StructType([*df.schema, T.StructField(_SLICE, T.IntegerType())])).parquet(path)
        try:
            for part in range(SLICES):
                laid_out = _by_month(rows.where(F.col(_SLICE) == part).drop(_SLICE), day, sort_by, columns)
                written += counted_write(laid_out, lambda d, mode="append" if part else "overwrite": d.write.mode(mode)
                                         .option("compression", "zstd").partitionBy(MONTH).parquet(target))
                manifest.remove(spark, f"{path}/{_SLICE}={part}")
        except BaseException:
            manifest.remove(spark, target)  # no table rather than some of its months
            raise
    manifest.remove(spark, path)
    return written


def rewrite_months(
    df: DataFrame, target: str, day: str, sort_by: str | Sequence[str] | None = None, columns: Sequence[Column | str] | None = None
) -> int:
    """Replace exactly the months that ``df`` holds, with its rows; the folders of all others are not touched.

    ``df`` must hold these months whole (see :func:`whole_months`) and must not read ``target``. Repeating it changes nothing.
    """
    laid_out = _by_month(df, day, sort_by, columns)
    with tidy(df.sparkSession):
        return counted_write(laid_out, lambda d: d.write.mode("overwrite").option("compression", "zstd")
                             .option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(target))


def whole_months(rows: DataFrame, day: str, fresh: DataFrame, fresh_day: str) -> DataFrame:
    """The rows of every month in which ``fresh`` has a day: what has to be built anew after it arrived."""
    with tidy(fresh.sparkSession):
        months = [r[0] for r in fresh.select(_month(F.col(fresh_day).cast("date"))).distinct().collect()]  # one row per month
    known = [m for m in months if m is not None]
    wanted = _month(F.col(day).cast("date")).isin(known) if known else F.lit(False)
    return rows.where(wanted | F.col(day).isNull() if None in months else wanted)


def read_clustered(spark: SparkSession, target: str, schema: T.StructType, day: str, since=None, until=None) -> DataFrame:
    """The rows from ``since`` to ``until`` (days, both included); only the folders of their months are listed and read."""
    rows = spark.read.schema(T.StructType([*schema, T.StructField(MONTH, T.IntegerType())])).parquet(target)
    for bound, keep in ((since, "__ge__"), (until, "__le__")):
        if bound is not None:
            at = F.lit(str(bound)[:10]).cast("date")
            rows = rows.where(getattr(F.col(MONTH), keep)(_month(at))).where(getattr(F.col(day), keep)(at))
    return rows.select(*schema.names)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Catalog table bucketed by a join key; joins of such tables need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


@dataclass(frozen=True)
class LoadAudit:
    table_name: str
    row_count: int
    error_count: int
    status: str
    received_at: datetime
    loaded_at: datetime


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def audited_load(
    spark: SparkSession,
    table_name: str,
    file_name: str,
    statement: str,
    load: Callable[[], int | tuple[int, int]],
    audit: str,
    actor: str = "loader",
    pool: str = "default",
) -> LoadAudit:
    """Run a load and append what happened to the audit table, also when it fails.

    ``load`` returns the observed row count, or (rows, rejected rows).
    """
    received, rows, errors, status, code, message = _now(), 0, 0, "LOADED", None, None
    problem: Exception | None = None
    try:
        outcome = load()
        rows, errors = outcome if isinstance(outcome, tuple) else (outcome, 0)
        status = "PARTIALLY_LOADED" if errors else "LOADED"
    except Exception as e:  # recorded, then raised again
        problem, status, code, message = e, "FAIL", type(e).__name__, str(e)
    record = LoadAudit(table_name, rows, errors, status, received, _now())
    spark.createDataFrame(
        [(uuid.uuid4().hex, table_name, file_name, actor, pool, status, rows, errors, code, message,
          record.received_at, record.loaded_at, statement)],
        AUDIT_SCHEMA,
    ).write.mode("append").parquet(audit)
    if problem:
        raise problem
    return record
