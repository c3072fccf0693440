"""One scheduled refresh: deliveries in, star schema, history and verdicts out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from retailloom.operators import history, quality, reports
from retailloom.plans import checks
from retailloom.plans.warehouse import Warehouse
from retailloom.schemas import REFERENCE, STREAM_SALES, TRANSACTIONAL, RawTable, raw_table
from retailloom.session import child_names, path_exists, prepare_tables
from retailloom.sources import ndjson, writers
from retailloom.streaming import landing

# The calendar dimension's range, the end exclusive.
CALENDAR = ("2020-01-01", "2030-12-31")


@dataclass(frozen=True)
class Refreshed:
    warehouse: Warehouse
    row_counts: dict[str, int]
    check_results: DataFrame


def load_deliveries(spark: SparkSession, data_dir: str, root: str, as_of, reference: str = "append") -> dict[str, int]:
    """Load ``<entity>.json`` for every delivered entity; returns the row counts.

    Transactional tables are replaced. Reference tables are appended by column
    name, so a repeated delivery repeats its rows, or with ``upsert`` merged by
    key; the two may alternate. Nothing in use is overwritten: a failed load leaves
    every table as it was. Without any transactional row the refresh fails.
    """
    if reference not in ("append", "upsert"):
        raise ValueError(f"reference must be append or upsert, not {reference!r}")
    counts, audit = {}, f"{root}/load_audit"
    for table in (*TRANSACTIONAL, *REFERENCE):
        delivery = f"{data_dir}/{table.name}.json"
        if not path_exists(spark, delivery):
            continue
        rows = ndjson.read_ndjson(spark, delivery, table.name, "strict", as_of)
        statement, load = _load(spark, table, rows, delivery, f"{root}/raw/{table.name}", as_of, reference)
        counts[table.name] = writers.audited_load(spark, table.name, delivery, statement, load, audit).row_count
    quality.empty_load_gate({t.name: counts.get(t.name, 0) for t in TRANSACTIONAL})
    return counts


class LoadOrderError(ValueError):
    """A load older than what its table already holds."""


def _load(spark: SparkSession, table: RawTable, rows: DataFrame, delivery: str, folder: str, as_of, reference: str):
    """The statement and the write of one load.

    Every table has one layout, ``version=<time>/part=<time>``. A full load begins a
    version, an append adds a part to the current one; repeating a load replaces
    its own part. Readers see the committed parts of the newest version.
    """
    label = history.run_label(as_of)
    parts = committed_parts(spark, folder)
    if any(max(p) > label for p in parts):
        raise LoadOrderError(f"{table.name} was loaded after {as_of}")
    fresh = f"{folder}/version={label}/part={label}"
    if table in TRANSACTIONAL:
        return f"INSERT INTO {table.name}", lambda: writers.load_replace(rows, fresh)
    if reference == "append":
        version = parts[-1][0] if parts else label
        target = f"{folder}/version={version}/part={label}"
        aligned = writers.align_by_name(rows, table.schema)
        return f"COPY INTO {table.name} FROM {delivery}", lambda: writers.load_replace(aligned, target)
    before = [p for p in parts if p[0] < label]
    sources = [f"{folder}/version={v}/part={p}" for v, p in before if v == before[-1][0]]
    return f"MERGE INTO {table.name} USING {delivery}", lambda: writers.load_upsert(
        spark, rows, sources, fresh, table.key, table.loaded_at
    )


def load_table(spark: SparkSession, table: RawTable, rows: DataFrame, delivery: str, folder: str, as_of, reference: str = "append") -> int:
    """Load one table's delivery below ``folder``; returns its row count."""
    _, load = _load(spark, table, rows, delivery, folder, as_of, reference)
    return load()


def committed_parts(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(version, part) of every committed write below a table's folder, oldest first."""
    found = []
    for version in child_names(spark, folder):
        for part in child_names(spark, f"{folder}/{version}") if version.startswith("version=") else ():
            if part.startswith("part=") and path_exists(spark, f"{folder}/{version}/{part}/_SUCCESS"):
                found.append((version.removeprefix("version="), part.removeprefix("part=")))
    return sorted(found)


def current_table(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The committed parts of a table's newest version; empty if there is none."""
    parts = committed_parts(spark, folder)
    return writers.read_parts(spark, [f"{folder}/version={v}/part={p}" for v, p in parts if v == parts[-1][0]], schema)


def open_warehouse(spark: SparkSession, root: str, as_of, stream_target: str | None = None, calendar=CALENDAR) -> Warehouse:
    """The warehouse over the loaded raw tables; undelivered ones are empty."""
    def loaded(entity: str) -> DataFrame:
        schema, path = raw_table(entity).schema, f"{root}/raw/{entity}"
        if entity == STREAM_SALES.name and stream_target:
            return landing.landed(spark, stream_target)
        return current_table(spark, path, schema)

    return LoadedWarehouse(spark, loaded, f"{root}/marts/{history.run_label(as_of)}", as_of, calendar)


def latest_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart as of the newest refresh that completed all of them."""
    for label in sorted(child_names(spark, f"{root}/marts"), reverse=True):
        folder = f"{root}/marts/{label}"
        if all(path_exists(spark, f"{folder}/{mart}/_SUCCESS") for mart in Warehouse.MARTS):
            return spark.read.parquet(f"{folder}/{name}").drop(writers.MONTH)
    raise ValueError(f"no complete refresh below {root}")


def latest_dimensions(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The dimensions of the newest complete refresh, for a stream to enrich each batch with."""
    return {name: latest_mart(spark, root, name) for name in ("dim_customer", "dim_product", "dim_store")}


class LoadedWarehouse(Warehouse):
    """A warehouse whose raw tables are already stored, so they are read in place."""

    def raw(self, entity: str) -> DataFrame:
        return self._once(f"table {entity}", lambda: self.build_raw(entity))


def refresh(
    spark: SparkSession,
    data_dir: str,
    root: str,
    as_of,
    stream_target: str | None = None,
    reference: str = "append",
    gates: bool = True,
) -> Refreshed:
    """Load, rebuild every mart, snapshot the customers and check everything.

    With ``gates`` a failed check or a breached report raises after all results
    are known; warnings never do.
    """
    prepare_tables(spark)
    counts = load_deliveries(spark, data_dir, root, as_of, reference)
    warehouse = open_warehouse(spark, root, as_of, stream_target)
    warehouse.build(warehouse.MARTS)
    history.record_snapshot(spark, f"{root}/customer_history", warehouse.staged("stg_customers"), as_of)
    results = quality.run_checks(spark, warehouse.table, checks.ALL_CHECKS)
    if gates:
        quality.check_gate(results)
        quality.batch_gate(
            reports.freshness_report(warehouse.table, checks.FRESHNESS_SLA, as_of),
            reports.referential_integrity_report(warehouse.table, checks.REFERENCES),
            reports.row_count_report(spark, warehouse.table, checks.ROW_BOUNDS),
        )
    return Refreshed(warehouse, counts, results)
