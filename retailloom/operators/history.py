"""Type-2 history: versions of a record with validity intervals."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailloom.functions import as_timestamp
from retailloom.operators.joins import left_join
from retailloom.schemas import CUSTOMERS
from retailloom.session import child_names, path_exists

# The customer attributes kept in history, and those whose change opens a version.
CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "segment", "preferred_channel",
    "marketing_consent", "lifetime_value", "last_purchase_date",
]
CUSTOMER_CHECK_COLUMNS = [
    "segment", "preferred_channel", "marketing_consent", "lifetime_value", "last_purchase_date",
]
META_COLUMNS = ["scd_id", "updated_at", "valid_from", "valid_to"]


def _opened(key: str, columns: list[str], alias: str, as_of):
    moment = as_timestamp(as_of)
    return F.struct(
        *(F.col(f"{alias}.{c}").alias(c) for c in columns),
        F.md5(F.concat_ws("|", F.col(f"{alias}.{key}"), moment.cast("string"))).alias("scd_id"),
        moment.alias("updated_at"),
        moment.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def _kept(columns: list[str], alias: str, valid_to):
    return F.struct(
        *(F.col(f"{alias}.{c}").alias(c) for c in [*columns, "scd_id", "updated_at", "valid_from"]),
        valid_to.alias("valid_to"),
    )


def _one_row_per_key(observed: DataFrame, key: str) -> DataFrame:
    row = F.struct(*(c for c in observed.columns if c != key))
    spread = observed.groupBy(key).agg(F.min(row).alias("low"), F.max(row).alias("high"))
    conflict = F.concat(F.lit("conflicting rows for key "), F.col(key).cast("string"))
    agreed = F.when(F.col("low").eqNullSafe(F.col("high")), F.col("high")).otherwise(F.raise_error(conflict))
    single = spread.select(key, agreed.alias("row"))
    return single.select(*(F.col(c) if c == key else F.col(f"row.{c}").alias(c) for c in observed.columns))


def scd2(
    previous: DataFrame | None,
    current: DataFrame,
    as_of,
    key: str = "customer_id",
    columns: list[str] = CUSTOMER_COLUMNS,
    check: list[str] = CUSTOMER_CHECK_COLUMNS,
) -> DataFrame:
    """The history after observing ``current`` at ``as_of``.

    A key opens a new version when any ``check`` column differs (NULL-safe).
    Unchanged versions are passed through as they were, keys missing from
    ``current`` stay open, and closed versions skip the join altogether. A key
    observed with conflicting rows fails the job; equal repeats count once. The
    result must be written to a new path, never over ``previous``.
    """
    observed = _one_row_per_key(current.select(*columns), key)
    if previous is None:
        return observed.alias("new").select(F.inline(F.array(_opened(key, columns, "new", as_of))))

    closed = previous.where(F.col("valid_to").isNotNull())
    # One row per key on either side: a run opens at most one version per key.
    paired = previous.where(F.col("valid_to").isNull()).withColumn("_had", F.lit(True)).alias("old").join(
        observed.withColumn("_has", F.lit(True)).alias("new"), F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer"
    )
    differs = reduce(lambda a, b: a | b, (~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check))
    had = F.col("old._had").isNotNull()
    changed = had & F.col("new._has").isNotNull() & differs
    closing = F.when(changed, as_timestamp(as_of)).otherwise(F.col("old.valid_to"))
    versions = F.array(
        F.when(had, _kept(columns, "old", closing)),
        F.when(changed | ~had, _opened(key, columns, "new", as_of)),
    )
    refreshed = paired.select(F.inline(F.filter(versions, lambda v: v.isNotNull())))
    return closed.select(*columns, *META_COLUMNS).unionByName(refreshed)


def history_schema(columns: list[str] = CUSTOMER_COLUMNS, types: T.StructType = CUSTOMERS.schema) -> T.StructType:
    """The stored columns of a history, declared so that an empty run can be read."""
    moments = [T.StructField(c, T.TimestampNTZType()) for c in META_COLUMNS[1:]]
    return T.StructType([*(T.StructField(c, types[c].dataType) for c in columns), T.StructField("scd_id", T.StringType()), *moments])


class HistoryOrderError(ValueError):
    """A snapshot that would have to rewrite what later ones were built on."""


#: Runs after which the open versions are folded into one table again.
FOLD_EVERY = 16


def record_snapshot(
    spark: SparkSession, root: str, current: DataFrame, as_of, columns: list[str] = CUSTOMER_COLUMNS, fold_every: int = FOLD_EVERY, **options,
) -> None:
    """Observe ``current`` at ``as_of`` and store what changed below ``root``.

    Layout: ``root/run=<time>/closed=<bool>`` holds the versions that a run opened and those it
    closed, in one commit, and nothing else; ``root/fold=<time>`` holds all versions open after a run, made every
    ``fold_every`` runs. A run or fold that was interrupted is not seen; the run is written again. What
    earlier runs stored is never rewritten. A time before a stored run is refused, and so is the time of the
    latest run with another outcome; with the same outcome nothing is done.
    """
    run, done = run_label(as_of), _committed(spark, root, "run")
    if done and done[-1] > run:
        raise HistoryOrderError(f"{as_of} lies before the stored run {done[-1]}")
    schema = history_schema(columns, current.schema)
    earlier = [r for r in done if r < run]
    previous = _open_versions(spark, root, earlier, schema) if earlier else None
    closed = F.col("valid_to").isNotNull()
    changes = scd2(previous, current, as_of, columns=columns, **options).withColumn("closed", closed)
    changes = changes.where(closed | (F.col("updated_at") == as_timestamp(as_of)))
    if run in done:
        stored = _stored_runs(spark, root, [run], schema).select(*changes.columns)
        if changes.exceptAll(stored).unionByName(stored.exceptAll(changes)).limit(1).count():
            raise HistoryOrderError(f"the run {run} is stored with another outcome")
        return
    changes.write.mode("overwrite").partitionBy("closed").parquet(f"{root}/run={run}")
    folds = [f for f in _committed(spark, root, "fold") if f <= run]
    if len([r for r in [*earlier, run] if not folds or r > folds[-1]]) >= fold_every:
        _open_versions(spark, root, [*earlier, run], schema).write.mode("overwrite").parquet(f"{root}/fold={run}")


def _stored_runs(spark: SparkSession, root: str, runs: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(_with_run(schema)).option("basePath", root).parquet(*(f"{root}/run={r}" for r in runs)).drop("run")


def _open_versions(spark: SparkSession, root: str, runs: list[str], schema: T.StructType) -> DataFrame:
    """The versions open after the last of ``runs``: the newest fold among them and what was opened since, without what was closed since."""
    folds = [f for f in _committed(spark, root, "fold") if f in runs]
    since = [r for r in runs if not folds or r > folds[-1]]
    opened = spark.read.schema(schema).parquet(f"{root}/fold={folds[-1]}") if folds else None
    if since:
        changes = _stored_runs(spark, root, since, schema)
        news = changes.where("not closed").drop("closed")
        opened = opened.unionByName(news) if opened is not None else news
        opened = opened.join(changes.where("closed").select("scd_id"), "scd_id", "left_anti").select(*schema.names)
    return opened


def read_history(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """All versions: those that runs closed, and those open after the latest one."""
    runs, schema = _committed(spark, root, "run"), schema or history_schema()
    if not runs:
        raise ValueError(f"no snapshot below {root}")
    schema = T.StructType([f for f in schema if f.name not in ("run", "closed")])
    closed = _stored_runs(spark, root, runs, schema).where("closed").drop("closed")
    return closed.select(*schema.names).unionByName(_open_versions(spark, root, runs, schema))


def run_label(as_of) -> str:
    """The moment, to the microsecond and in UTC, as a folder name that sorts by time.

    Text must be an ISO date or time; a moment without an offset is taken as UTC.
    """
    moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    if not isinstance(moment, datetime):
        moment = datetime(moment.year, moment.month, moment.day)
    if moment.tzinfo:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment.strftime("t%Y%m%d%H%M%S%f")


def _committed(spark: SparkSession, root: str, kind: str) -> list[str]:
    """Committed runs or folds, oldest first."""
    names = sorted(n.removeprefix(f"{kind}=") for n in child_names(spark, root) if n.startswith(f"{kind}="))
    return [n for n in names if path_exists(spark, f"{root}/{kind}={n}/_SUCCESS")]


def _with_run(schema: T.StructType) -> T.StructType:
    kept = [f for f in schema if f.name not in ("run", "closed")]
    return T.StructType([*kept, T.StructField("run", T.StringType()), T.StructField("closed", T.BooleanType())])


def month_slot(moment: Column) -> Column:
    """The calendar month of a moment as a whole number."""
    return 12 * F.year(moment) + F.month(moment) - 1


def by_month(history: DataFrame, months: DataFrame) -> DataFrame:
    """Each version once, as ``_slot``, for every month that it touches within ``months``, one row of ``low`` and ``high``."""
    # One row, so it can always be sent to all tasks; the key is 0 everywhere, but not a constant, so this stays an equi-join.
    ranged = history.withColumn("_one", F.pmod(F.xxhash64("valid_from"), F.lit(1))).join(
        F.broadcast(months.withColumn("_one", F.pmod(F.xxhash64("low"), F.lit(1)))), "_one")
    low = F.greatest("low", month_slot(F.col("valid_from")))
    high = F.least("high", F.coalesce(month_slot(F.col("valid_to")), F.col("high")))
    return ranged.withColumn("_slot", F.explode(F.when(low <= high, F.sequence(low, high)))).drop("_one", "low", "high")


def point_in_time(
    fact: DataFrame,
    history: DataFrame,
    moment: str,
    key: str = "customer_id",
    attributes: list[str] = CUSTOMER_CHECK_COLUMNS,
    prefix: str = "at_sale_",
    hot: list | None = None,
) -> DataFrame:
    """Each fact row with the version valid at its ``moment``; none found leaves NULLs.

    An equi-join on key and month, with the interval as a residual condition: the
    versions, which are few beside the facts, are repeated for the months they
    touch, as far as there are facts, and a fact meets those of its own month only,
    however many its key has. Facts are shuffled once; the column of their moments is
    read once more for its range, so a fact that is costly to compute should be stored. A NULL moment finds nothing.
    """
    slot = month_slot(F.col(moment).cast("timestamp_ntz"))
    versions = by_month(history, fact.agg(F.min(slot).alias("low"), F.max(slot).alias("high"))).select(
        key, "valid_from", "valid_to", "_slot", *(F.col(a).alias(f"{prefix}{a}") for a in attributes)
    )
    fact = fact.withColumn("_month", slot)
    at = fact[moment].cast("timestamp_ntz")
    until = F.coalesce(versions["valid_to"], F.lit("9999-12-31").cast("timestamp_ntz"))
    valid = (fact["_month"] == versions["_slot"]) & (at >= versions["valid_from"]) & (at < until)
    return left_join(fact, versions, key, hot, valid).drop("_month", "_slot")
