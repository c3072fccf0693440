"""Operational views over the load audit and the raw tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailloom.functions import as_timestamp, boundary_diff
from retailloom.operators.joins import union_all

AUDIT_SCHEMA = (
    "load_id string, table_name string, file_name string, actor string, pool string, status string,"
    " row_count long, error_count long, error_code string, error_message string,"
    " received_at timestamp_ntz, loaded_at timestamp_ntz, statement string"
)
FAILURES = ("FAIL", "INCIDENT")


def _since(column: str, as_of, hours: int):
    return F.col(column) >= as_timestamp(as_of) - F.expr(f"interval {int(hours)} hours")


def load_history(audit: DataFrame, as_of, hours: int = 24, limit: int = 100) -> DataFrame:
    """Loads of the last hours, latest first."""
    return (
        audit.where(_since("received_at", as_of, hours))
        .select(
            "table_name", "file_name", "status",
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            F.coalesce("error_count", F.lit(0)).alias("error_count"),
            "received_at", "loaded_at",
            boundary_diff("minute", F.col("received_at"), F.col("loaded_at")).alias("load_minutes"),
        )
        .orderBy(F.desc("received_at"), "file_name")
        .limit(limit)
    )


def recent_failures(audit: DataFrame, as_of, hours: int = 24, limit: int = 50, pool: str | None = None) -> DataFrame:
    """Failed loads of the last hours, latest first, optionally of one compute pool."""
    rows = audit.where(_since("received_at", as_of, hours)).where(F.col("status").isin(*FAILURES))
    if pool is not None:
        rows = rows.where(F.col("pool") == pool)
    return (
        rows.select(
            "load_id", "actor", "pool", "status", "error_code", "error_message", "received_at",
            (boundary_diff("millisecond", F.col("received_at"), F.col("loaded_at")) / 1000).alias("elapsed_seconds"),
        )
        .orderBy(F.desc("received_at"), "load_id")
        .limit(limit)
    )


def recent_copies(audit: DataFrame, as_of, hours: int = 2, limit: int = 10) -> DataFrame:
    """Bulk-copy statements of the last hours with the target table read from their text."""
    target = F.regexp_extract("statement", r"COPY INTO\s+(\S+)", 1)
    return (
        audit.where(F.col("statement").ilike("%COPY INTO%"))
        .where(_since("received_at", as_of, hours))
        .select(
            F.when(target == "", "Unknown").otherwise(target).alias("target_table"),
            "status", "error_message", "received_at",
            boundary_diff("millisecond", F.col("received_at"), F.col("loaded_at")).alias("elapsed_ms"),
            "load_id",
        )
        .orderBy(F.desc("received_at"), "load_id")
        .limit(limit)
    )


def table_profile(spark: SparkSession, tables: Callable[[str], DataFrame], names: Iterable[str], sample: int = 3) -> DataFrame:
    """Rows, columns and some rows as JSON per table: OK, EMPTY, or ERROR when it cannot be opened or read.

    Each table is read in a job of its own, so that one which fails while being
    read leaves the others' profiles alone. A row count and ``sample`` rows of each
    reach the driver.
    """
    found = []
    for name in names:
        try:
            df = tables(name)
            rows = df.agg(F.count(F.lit(1))).first()[0]
            found.append((name, rows, len(df.columns), "OK" if rows else "EMPTY", None, [r.j for r in sample_rows(df, sample).select(F.to_json(F.struct("*")).alias("j")).collect()]))
        except (PySparkException, ValueError) as problem:
            found.append((name, None, None, "ERROR", str(problem), []))
    return spark.createDataFrame(
        found, "table_name string, row_count long, column_count int, status string, problem string, sample array<string>")


def sample_rows(df: DataFrame, n: int = 3) -> DataFrame:
    return df.limit(n)
