"""Joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT_BUCKETS = 64


def heavy_keys(df: DataFrame, key: str, share: float = 1 / 32) -> list:
    """Key values holding at least ``share`` of the rows; at most ``1 / share`` exist.

    The counts are reduced inside each task first. Only the heavy values reach
    the driver, and their number is bounded by the share, not by the data.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count()
    total = df.count()
    return [r[0] for r in counts.where(F.col("count") >= max(1.0, total * share)).select(key).collect()]


def per_key(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """One row per key, for joining to a side on which that key may be hot.

    Adaptive execution only splits a skewed join whose two inputs are both
    fresh shuffles. An aggregate by the join key alone would be joined in place,
    so it also groups by the key's hash: the same rows, shuffled once more after
    they were reduced.
    """
    return df.groupBy(key, F.xxhash64(key).alias("_apart")).agg(*aggregates).drop("_apart")


def streamed(df: DataFrame, keys: Sequence[str], by: Sequence[str] | None = None) -> DataFrame:
    """The rows in order of ``keys``, those of one key in one task, for grouping that reduces little.

    Reducing such rows before the shuffle only fills each task's memory with
    groups of one row until they spill. Sorted rows are grouped as they pass
    instead (``spark.sql.execution.replaceHashWithSortAgg``). ``by`` names those of the
    keys that a later join needs, so its shuffle is this one.
    """
    return df.repartition(*(by or keys)).sortWithinPartitions(*keys)


def left_join(left: DataFrame, right: DataFrame, key: str, hot: list | None = None, condition=None) -> DataFrame:
    """Left equi-join, optionally with an extra ``condition`` over both sides.

    Without ``hot`` this is a plain join and adaptive execution splits skewed
    partitions at run time. Left rows with a ``hot`` key are spread over salt
    buckets, and only the right rows of those keys are repeated once per
    bucket, so the result is the same rows from evenly sized tasks.
    """
    if hot:
        is_hot = F.col(key).isin(hot)
        buckets = F.array(*(F.lit(i) for i in range(SALT_BUCKETS)))
        # Values spread different rows, the task spreads equal ones; a retried task repeats both.
        spread = F.pmod(F.xxhash64(*left.columns) + F.spark_partition_id(), F.lit(SALT_BUCKETS)).cast("int")
        left = left.withColumn("_salt", F.when(is_hot, spread).otherwise(F.lit(0)))
        right = right.withColumn("_salt", F.explode(F.when(is_hot, buckets).otherwise(F.array(F.lit(0)))))
        on = [key, "_salt"]
    else:
        on = [key]
    if condition is None:
        return left.join(right, on, "left").drop("_salt")
    matched = None
    for name in on:
        equal = left[name] == right[name]
        matched = equal if matched is None else matched & equal
    joined = left.join(right, matched & condition, "left")
    for name in on:
        joined = joined.drop(right[name])
    return joined.drop("_salt")


def orphan_counts(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, nulls_are_orphans: bool) -> DataFrame:
    """How many child rows have no parent, as one row ``offending_rows``.

    Both sides are first reduced to one row per key. The anti-join then reuses
    that partitioning and no key, however hot, reaches one task with its rows.
    """
    keys = child.select(F.col(child_key).alias("k"))
    if not nulls_are_orphans:
        keys = keys.where(F.col("k").isNotNull())
    counted = keys.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias("k")).where(F.col("k").isNotNull()).distinct()
    return counted.join(known, "k", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("offending_rows"))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name, pairwise, so the plan stays shallow however many parts there are."""
    parts = list(parts)
    while len(parts) > 1:
        pairs = [a.unionByName(b) for a, b in zip(parts[::2], parts[1::2], strict=False)]
        parts = pairs + (parts[-1:] if len(parts) % 2 else [])
    return parts[0]
