"""The tables of one data set: raw tables and marts written once, staging as views."""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import Future, ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from retailloom.operators import dimensions, facts, staging
from retailloom.schemas import RAW_TABLES
from retailloom.session import prepare_tables, scratch_path
from retailloom.sources import orders_model
from retailloom.sources.writers import read_clustered, write_clustered

# (day column, sort columns) of the date-clustered facts. Within a day, rows of one order or customer
# stand side by side, so their repeated values take little space.
CLUSTERING = {
    "fact_sales": ("sale_date", ("sale_date", "sale_id")),
    "fact_returns": ("return_date", ("return_date", "return_id")),
    "fct_sales_realtime": ("sale_date", ("event_ts",)),
}


class Warehouse:
    """Resolves table names to DataFrames below one root folder.

    Raw tables and marts are written on first use, so each is computed once
    however many checks and queries read it, and a lost executor only costs a
    re-read of files. Staging views stay lazy.
    """

    def __init__(
        self,
        spark: SparkSession,
        build_raw: Callable[[str], DataFrame],
        root: str,
        as_of,
        calendar: tuple[str, str] | None = None,
        source: Callable[[str], DataFrame] | None = None,
        build_dealt: Callable[[str], DataFrame] | None = None,
        dealt_by: str | None = None,
    ):
        """``build_raw`` gives a raw table by name; ``calendar`` fixes the date range, else it follows the facts.

        ``build_dealt`` gives sales or returns as they are built, with the column ``dealt_by`` by whose values their rows lie together.
        """
        self.spark, self.build_raw, self.root, self.as_of = spark, build_raw, root, as_of
        self.calendar, self.source, self.build_dealt, self.dealt_by = calendar, source, build_dealt, dealt_by
        self._lock, self._pending = Lock(), {}

    def _once(self, name: str, make: Callable[[], object]):
        """The outcome of ``make``, run by the first thread that asks; others wait for it. A failure is not kept."""
        with self._lock:
            pending, mine = self._pending.get(name), False
            if pending is None:
                pending, mine = self._pending.setdefault(name, Future()), True
        if mine:
            try:
                pending.set_result(make())
            except BaseException as problem:
                with self._lock:
                    del self._pending[name]
                pending.set_exception(problem)
        return pending.result()

    def _materialise(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        def write() -> DataFrame:
            path = f"{self.root}/{name}"
            df = build()
            if name in CLUSTERING:
                columns = self._fact_columns(name)
                write_clustered(df, path, *CLUSTERING[name], columns)
                return read_clustered(self.spark, path, df.select(*columns).schema, CLUSTERING[name][0])
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)

        return self._once(f"table {name}", write)

    def once(self, name: str, make: Callable[[], str]) -> str:
        """Run something that produces a path once, and remember the path."""
        return self._once(f"path {name}", make)

    def raw(self, entity: str) -> DataFrame:
        return self._materialise(entity, lambda: self.build_raw(entity))

    def staged(self, view: str) -> DataFrame:
        return staging.stage(self.raw(staging.VIEWS[view].raw), view)

    def _known(self, name: str) -> bool:
        with self._lock:
            return f"table {name}" in self._pending

    def net_sales(self, join: Callable[..., DataFrame]) -> DataFrame:
        """``join`` of staged sales and returns. Where neither is stored yet, their definitions are joined as they are built,
        order by order, so sales are neither stored in between nor shuffled again by their ids."""
        views = "stg_sales", "stg_returns"
        if self.build_dealt is None or any(self._known(staging.VIEWS[v].raw) for v in views):
            return join(*(self.staged(v) for v in views))
        return join(*(staging.stage(self.build_dealt(staging.VIEWS[v].raw), v, [self.dealt_by]) for v in views), dealt_by=self.dealt_by)

    def mart(self, name: str) -> DataFrame:
        return self._materialise(name, lambda: self._build_mart(name))

    def served(self, name: str, columns: Collection[str] | None = None) -> DataFrame:
        """A fact for a question asked once: the stored one if there is one, else its definition over the raw tables.

        A question that needs few columns then neither hashes nor lays out the whole fact. Who names the ``columns``
        gets sales without their returns where none of these hangs on returns.
        """
        stored = self._known(name)
        if not stored and name == "fact_sales" and columns is not None and not set(facts.OF_RETURNS) & set(columns):
            return facts.fact_sales_apart(self.staged("stg_sales"))
        return self.mart(name) if stored else self._build_mart(name).select(*self._fact_columns(name))

    def asked(self, name: str, columns: Collection[str] | None = None) -> DataFrame:
        """Like :meth:`table`, but facts need not be stored to be asked, and need no more than the ``columns``."""
        return self.served(name, columns) if name in CLUSTERING else self.table(name)

    def _build_mart(self, name: str) -> DataFrame:
        if name == "dim_customer":
            return dimensions.dim_customer(self.staged("stg_customers"), self.staged("stg_sales"), self.as_of)
        if name == "dim_product":
            return dimensions.dim_product(self.staged("stg_products"), self.staged("stg_suppliers"))
        if name == "dim_store":
            return dimensions.dim_store(self.staged("stg_stores"), self.as_of)
        if name == "dim_date":
            if self.calendar:
                return dimensions.dim_date(dimensions.calendar_bounds(self.spark, *self.calendar))
            dated = [(self.staged("stg_sales"), "sale_date"), (self.staged("stg_returns"), "return_date")]
            return dimensions.dim_date(dimensions.calendar_bounds_of(*dated))
        # Facts as rows whose keys are hashed only when they are written.
        if name == "fact_sales":
            return self.net_sales(facts.fact_sales_rows)
        if name == "fact_returns":
            return facts.fact_returns_rows(self.staged("stg_returns"), self.staged("stg_sales"))
        if name == "fct_sales_realtime":
            return self.staged("stg_stream_sales").drop("product_name")
        raise ValueError(f"unknown table {name!r}")

    def _fact_columns(self, name: str) -> list:
        return {
            "fact_sales": facts.fact_sales_columns, "fact_returns": facts.fact_returns_columns,
            "fct_sales_realtime": facts.fct_sales_realtime_columns,
        }[name]()

    def table(self, name: str) -> DataFrame:
        if name in RAW_TABLES:
            return self.raw(name)
        if name in staging.VIEWS:
            return self.staged(name)
        if name == "products_margin":
            return self.raw("products").selectExpr("price - cost as gross_margin")
        return self.mart(name)

    MARTS = ("dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales", "fact_returns", "fct_sales_realtime")

    def build(self, names, threads: int = 4) -> None:
        """Write several tables, submitting independent jobs side by side so none leaves cores idle."""
        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(self.table, names))

    def build_all(self) -> None:
        self.build(RAW_TABLES)
        self.build(self.MARTS)


# Dates that orders may carry; a date outside is an error the checks must find. The end is exclusive.
ORDERS_CALENDAR = ("1990-01-01", "2011-01-01")

_open: dict[tuple[str, ...], Warehouse] = {}


def warehouse_for(spark: SparkSession, sf_dir: str, as_of) -> Warehouse:
    """The warehouse over the tables in ``sf_dir``, shared by the queries of one application."""
    prepare_tables(spark)
    key = (spark.sparkContext.applicationId, sf_dir, str(as_of))
    if key not in _open:
        def source(name: str) -> DataFrame:
            return spark.read.parquet(f"{sf_dir}/{name}.parquet")

        root = scratch_path(spark, "warehouse")
        _open[key] = Warehouse(
            spark, lambda entity: orders_model.build(entity, source), root, as_of, ORDERS_CALENDAR, source,
            lambda entity: orders_model.build(entity, source, [orders_model.DEALT_BY]), orders_model.DEALT_BY)
    return _open[key]
