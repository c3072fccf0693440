"""Data-quality checks: declared specs in, one result row per check out.

All per-column checks of a table share a single scan. Uniqueness checks of all
tables share one shuffle of fingerprints, relationship checks one join after both sides are
reduced to keys. The gates raise; uniqueness looks for repeated fingerprints at once; everything else is a lazy DataFrame.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailloom.functions import as_timestamp
from retailloom.operators.joins import streamed, union_all
from retailloom.session import scratch_path

RESULT_SCHEMA = "check_id int, check_name string, table_name string, column_name string, severity string"


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    columns: tuple[str, ...]
    severity: str = "error"
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    parent: tuple[str, str] | None = None


def not_null(table: str, *columns: str, severity: str = "error") -> list[Check]:
    return [Check("not_null", table, (c,), severity) for c in columns]


def unique(table: str, *columns: str, severity: str = "error") -> list[Check]:
    return [Check("unique", table, (c,), severity) for c in columns]


def accepted_values(table: str, column: str, values: Sequence[str], severity: str = "error") -> Check:
    return Check("accepted_values", table, (column,), severity, values=tuple(values))


def between(table: str, column: str, low=None, high=None, severity: str = "error") -> Check:
    return Check("between", table, (column,), severity, low=low, high=high)


def relationship(table: str, column: str, parent: str, parent_column: str, severity: str = "error") -> Check:
    return Check("relationships", table, (column,), severity, parent=(parent, parent_column))


def unique_combination(table: str, *columns: str, severity: str = "error") -> Check:
    return Check("unique_combination", table, columns, severity)


def columns_of(checks: Sequence[Check]) -> dict[str, set[str]]:
    """The columns that checks look at, by table."""
    found = defaultdict(set)
    for check in checks:
        found[check.table].update(check.columns)
        if check.parent:
            found[check.parent[0]].add(check.parent[1])
    return found


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def at_least(table: str, rows: int, severity: str = "error") -> Check:
    """The table holds this many rows; the failing rows are those it lacks."""
    return Check("at_least", table, ("*",), severity, low=rows)


def shaped(table: str, column: str, prefix: str, severity: str = "error") -> Check:
    """The column's text begins so; NULL passes."""
    return Check("shaped", table, (column,), severity, values=(prefix,))


def row_condition(check: Check) -> str:
    """SQL that is true on the rows breaking a row-level check. NULL passes all but not_null."""
    column = f"`{check.columns[0]}`"
    if check.kind == "not_null":
        return f"{column} is null"
    if check.kind == "accepted_values":
        return f"{column} not in ({', '.join(map(_text, check.values))})"
    if check.kind == "shaped":
        return f"not startswith({column}, {_text(check.values[0])})"
    low = [f"{column} < {check.low}"] if check.low is not None else []
    high = [f"{column} > {check.high}"] if check.high is not None else []
    return " or ".join(low + high)


ROW_KINDS = ("not_null", "accepted_values", "between", "shaped", "at_least")
KEY_KINDS = ("unique", "unique_combination")


def _row_metric(check: Check) -> str:
    return f"greatest(0, {check.low} - count(*))" if check.kind == "at_least" else f"count_if({row_condition(check)})"


def _row_metrics(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    counted = df.agg(*(F.expr(f"{_row_metric(c)} as c{i}") for i, c in checks))
    cells = ", ".join(f"{i}, c{i}" for i, _ in checks)
    return counted.selectExpr(f"stack({len(checks)}, {cells}) as (check_id, failing_rows)")


def _keyed(df: DataFrame, checks: list[tuple[int, str]], names: str = "value") -> DataFrame:
    """One (check, ...) row per checked column of every row, NULLs left out, in one scan."""
    cells = ", ".join(f"{i}, {value}" for i, value in checks)
    return df.selectExpr(f"stack({len(checks)}, {cells}) as (check_id, {names})").where(f"{names.split(',')[0]} is not null")


def _exact(check: Check) -> str:
    """A key by its values, as text; of a combination NULL counts as a value."""
    texts = [f"cast(`{c}` as string)" for c in check.columns]
    return texts[0] if len(texts) == 1 else f"to_json(array({', '.join(texts)}))"


def _some_key(check: Check, value: str) -> str:
    """``value`` where the row has a key to check: a combination always is one."""
    return value if len(check.columns) > 1 else f"if(`{check.columns[0]}` is null, null, {value})"


def fingerprint(columns: Sequence[str]) -> str:
    """Eight bytes that equal keys share; different keys may share them too."""
    return f"xxhash64({', '.join(f'`{c}`' for c in columns)})"


def _repeated(table: Callable[[str], DataFrame], checks: dict[str, list[tuple[int, Check]]], mark: Callable[[Sequence[str]], str]) -> DataFrame:
    """(check_id, mark) of all fingerprints that occur more than once; all tables share this one shuffle of whole numbers."""
    marks = [_keyed(table(name), [(i, _some_key(c, mark(c.columns))) for i, c in members], "mark") for name, members in checks.items()]
    # Counted as doubles: Spark drops the order below a count of whole numbers, and would hold all keys in memory.
    counted = streamed(union_all(marks), ["check_id", "mark"]).groupBy("check_id", "mark").agg(F.sum(F.lit(1.0)).alias("n"))
    return counted.where("n > 1").select("check_id", "mark")


#: Up to so many repeated fingerprints of a column, rows are sought by them.
FEW = 100_000


def _duplicate_metrics(
    spark: SparkSession, table: Callable[[str], DataFrame], checks: dict[str, list[tuple[int, Check]]], mark: Callable[[Sequence[str]], str] = fingerprint,
) -> DataFrame | None:
    """Values occurring more than once per check, in two phases.

    Every key is first counted by its fingerprint. Only columns with repeated fingerprints
    are looked at again, by value, so a collision is no duplicate; of sound tables there
    are none, and no key is shuffled as text. The repeated fingerprints are stored, as the
    second phase depends on how many there are: rows are sought by a few of them, but where
    there are many, all values are shuffled once and counted as they pass.
    """
    suspects = _repeated(table, checks, mark)
    path = scratch_path(spark, "repeated-keys")
    suspects.write.parquet(path)
    suspects = spark.read.schema(suspects.schema).parquet(path)
    found = {r.check_id: r["count"] for r in suspects.groupBy("check_id").count().collect()}  # at most one row per check
    few, many = [], []
    for name, members in checks.items():
        again = [(i, c) for i, c in members if i in found]
        sought = [(i, f"{_some_key(c, mark(c.columns))}, {_exact(c)}") for i, c in again if found[i] <= FEW]
        if sought:
            few.append(_keyed(table(name), sought, "mark, value"))
        compared = [(i, _some_key(c, _exact(c))) for i, c in again if found[i] > FEW]
        if compared:
            many.append(_keyed(table(name), compared))
    counts = []
    if few:
        hit = union_all(few).join(suspects, ["check_id", "mark"], "left_semi").groupBy("check_id", "value")
        counts.append(hit.agg(F.sum(F.lit(1.0)).alias("n")))
    if many:
        counts.append(streamed(union_all(many), ["check_id", "value"]).groupBy("check_id", "value").agg(F.sum(F.lit(1.0)).alias("n")))
    if not counts:
        return None
    return union_all(counts).groupBy("check_id").agg(F.count_if(F.col("n") > 1).alias("failing_rows"))


def _wide_mark(column: str) -> str:
    """Sixteen bytes of a key's text, as two whole numbers.

    The second number's own text comes first: after the key, it would only hash the first number again.
    """
    text = f"cast(`{column}` as string)"
    return f"if(`{column}` is null, null, xxhash64({text})), xxhash64('second', {text})"


def _orphan_metrics(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Child rows without a parent per check; children are reduced to keys before the join, parents hardly repeat.

    Keys are compared by 128 bits of hash, as wide as the surrogate keys themselves.
    """
    counted = children.groupBy("check_id", "one", "two").agg(F.count(F.lit(1)).alias("n"))
    orphans = counted.join(parents, ["check_id", "one", "two"], "left_anti")
    return orphans.groupBy("check_id").agg(F.sum("n").alias("failing_rows"))


def run_checks(spark: SparkSession, table: Callable[[str], DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: its failing rows and ``pass``, ``warn`` or ``fail``.

    ``table`` resolves a table name to its DataFrame. For unique checks the
    failing rows are duplicated values, for relationships child rows without a
    parent. Whether any key repeats is found out at once, the rest is lazy.
    """
    rows, keys, children, parents = defaultdict(list), defaultdict(list), defaultdict(list), defaultdict(list)
    for i, check in enumerate(checks):
        if check.kind in ROW_KINDS:
            rows[check.table].append((i, check))
        elif check.kind in KEY_KINDS:
            keys[check.table].append((i, check))
        else:
            parent, parent_column = check.parent
            children[check.table].append((i, _wide_mark(check.columns[0])))
            parents[parent].append((i, _wide_mark(parent_column)))

    def keyed(groups) -> DataFrame:
        return union_all([_keyed(table(name), members, "one, two") for name, members in groups.items()])

    metrics = [_row_metrics(table(name), members) for name, members in rows.items()]
    if keys and (repeated := _duplicate_metrics(spark, table, keys)) is not None:
        metrics.append(repeated)
    if children:
        metrics.append(_orphan_metrics(keyed(children), keyed(parents)))
    specs = spark.createDataFrame(
        [(i, c.kind, c.table, ",".join(c.columns), c.severity) for i, c in enumerate(checks)], RESULT_SCHEMA
    )
    found = union_all(metrics) if metrics else spark.createDataFrame([], "check_id int, failing_rows bigint")
    failing = F.coalesce("failing_rows", F.lit(0)).cast("bigint")
    return specs.join(found, "check_id", "left").select(
        "check_id", "check_name", "table_name", "column_name", "severity",
        failing.alias("failing_rows"),
        F.when(failing == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail").alias("status"),
    )


# --- row-returning tests -------------------------------------------------------------------


def inconsistent_amounts(fact_sales: DataFrame) -> DataFrame:
    """Sales whose refunds make no sense: net above gross, negative net or negative refund."""
    return fact_sales.where("net_amount > gross_amount or net_amount < 0 or refund_amount < 0").select(
        "sale_id", "gross_amount", "refund_amount", "net_amount"
    )


def future_sales(fact_sales: DataFrame, as_of) -> DataFrame:
    return fact_sales.where(F.col("sale_date") > as_timestamp(as_of).cast("date")).select(
        "sale_id", "sale_date", "customer_id"
    )


def duplicate_offsets(stream: DataFrame) -> DataFrame:
    """(partition, offset) pairs that landed more than once."""
    return (
        stream.groupBy("kafka_partition", "kafka_offset")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


# --- gates ---------------------------------------------------------------------------------


class QualityGateError(RuntimeError):
    """All breaches of a gate at once, in ``breaches``."""

    def __init__(self, breaches: Sequence[str]):
        self.breaches = list(breaches)
        super().__init__(f"{len(self.breaches)} breaches: " + "; ".join(self.breaches))


def _enforce(*breaches: DataFrame) -> None:
    """Raise if any of these one-column frames of breach texts has a row; one job looks at all of them."""
    found = [r.breach for r in union_all(breaches).orderBy("breach").collect()]
    if found:
        raise QualityGateError(found)


def _told(rows: DataFrame, text: str, *columns: str) -> DataFrame:
    return rows.select(F.format_string(text, *columns).alias("breach"))


def check_gate(results: DataFrame) -> None:
    """Fail on any error-severity check; warnings only report."""
    _enforce(_told(results.where("status = 'fail'"), "%s on %s.%s: %d", "check_name", "table_name", "column_name", "failing_rows"))


def batch_gate(freshness: DataFrame, integrity: DataFrame, row_counts: DataFrame) -> None:
    """Fail on stale or empty tables, on orphans and on row counts out of bounds."""
    _enforce(
        _told(freshness.where("freshness_status <> 'FRESH'"), "table %s counts as %s", "table_name", "freshness_status"),
        _told(integrity.where("offending_rows > 0"), "%s finds %d rows without a match", "check_name", "offending_rows"),
        _told(row_counts.where("status <> 'OK'"), "table %s holds %d rows: %s", "table_name", "actual_rows", "status"),
    )


def stream_gate(freshness: DataFrame, exactly_once: DataFrame) -> None:
    """Fail on a stale stream or on offsets that landed twice. An empty stream passes."""
    _enforce(
        _told(freshness.where("freshness_status = 'STALE'"), "%s last grew %d minutes ago", "table_name", "minutes_since_last_load"),
        _told(exactly_once.where("offending_groups > 0"), "%d offsets landed more than once", "offending_groups"),
    )


def empty_load_gate(row_counts: Mapping[str, int]) -> int:
    """Fail when a whole load brought no rows; returns the total otherwise."""
    total = sum(row_counts.values())
    if total == 0:
        raise QualityGateError([f"nothing was loaded into {', '.join(row_counts)}"])
    return total
