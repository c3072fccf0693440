"""Newline-delimited JSON into typed raw tables.

Every line is parsed once into its fields, with all values as text, and the
declared ones are then cast, so a bad value is reported by column instead of
voiding the line. Fields that are not declared are dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailloom.functions import as_timestamp
from retailloom.schemas import Column as RawColumn
from retailloom.schemas import RawTable, raw_table
from retailloom.session import path_exists, scratch_path
from retailloom.sources.normalise import polymorphic_address, resolve_wire_value

LINE, REASON = "raw_line", "reject_reason"


def _typed(value: Column, column: RawColumn) -> Column:
    """Text to the column's type, NULL when it does not fit. Integers round like decimals."""
    if column.type == "int":
        return F.round(value.try_cast("decimal(28,6)")).try_cast("int")
    return value if column.type == "string" else value.try_cast(column.spark_type)


def classify_lines(
    lines: DataFrame, table: RawTable, as_of, widths: Mapping[str, int] | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Typed columns plus the raw line and why it would be rejected (NULL if it would not).

    ``lines`` has a text column ``value`` and any columns to ``carry`` along.
    ``widths`` overrides declared text widths by column.
    """
    widths = widths or {}
    columns = table.on_the_wire
    names = list(dict.fromkeys(n for c in columns for n in c.wire_names))
    # Stores keep each value's own type, as an address may be text or an object.
    shaped = table.name == "stores"
    wire = T.MapType(T.StringType(), T.VariantType() if shaped else T.StringType())

    # Exploding a one-element array keeps later filters above the parse, so a line is parsed once.
    record = F.struct(*carry, F.col("value").alias(LINE), F.from_json("value", wire).alias("j"))
    parsed = lines.select(F.inline(F.array(record)))
    value = {n: F.try_element_at("j", F.lit(n)) for n in names}
    field = {n: F.try_variant_get(v, "$", "string") for n, v in value.items()} if shaped else value
    text = {
        c.name: polymorphic_address(value["address"]) if shaped and c.name == "address" else resolve_wire_value(field, c)
        for c in columns
    }
    required = [n for c in columns if not c.optional for n in c.wire_names[:1]]
    # Only a field without a value is looked for among the names, so a sound line is not searched again.
    absent = [F.when(value[n].isNull() & ~F.array_contains(F.map_keys("j"), n), F.lit(n)) for n in required]
    staged = parsed.select(*carry, LINE, F.col("j").isNull().alias("malformed"), F.concat_ws(",", *absent).alias("missing"),
                           *(text[c.name].alias(f"t_{c.name}") for c in columns))
    typed = staged.select("*", *(_typed(F.col(f"t_{c.name}"), c).alias(c.name) for c in columns))

    reasons = [
        F.when(F.col("malformed"), F.lit("malformed")),
        F.when(F.col("missing") != "", F.concat(F.lit("missing:"), F.col("missing"))),
    ]
    for c in columns:
        if not c.nullable:
            reasons.append(F.when(F.col(c.name).isNull(), F.lit(f"null:{c.name}")))
        if c.type != "string":
            bad = F.col(f"t_{c.name}").isNotNull() & F.col(c.name).isNull()
            reasons.append(F.when(bad, F.lit(f"bad_value:{c.name}")))
        width = widths.get(c.name, c.width)
        if width:
            reasons.append(F.when(F.char_length(c.name) > width, F.lit(f"too_long:{c.name}")))

    filled = [as_timestamp(as_of).alias(c.name) if c.name == "created_at" else F.lit(None).cast(c.spark_type).alias(c.name)
              for c in table.columns if c.filled]
    # Likewise a filter on the reason stays above the casts, so a value is cast once.
    judged = F.struct(*carry, *(c.name for c in columns), LINE, F.coalesce(*reasons).alias(REASON))
    return typed.select(F.inline(F.array(judged))).select(*carry, *(c.name for c in columns), *filled, LINE, REASON)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The non-blank lines of the files below ``path``."""
    return spark.read.text(path).where(F.col("value").rlike(r"\S"))


def read_ndjson(
    spark: SparkSession,
    path: str,
    entity: str,
    mode: str = "strict",
    as_of="1970-01-01 00:00:00",
    widths: Mapping[str, int] | None = None,
) -> DataFrame:
    """A raw table from NDJSON.

    ``strict`` fails the job on the first line it must reject. ``lenient``
    skips malformed lines, keeps NULL for whatever else is missing or unfit and
    reads a missing path as empty.
    """
    table = raw_table(entity)
    if mode == "lenient" and not path_exists(spark, path):
        return spark.createDataFrame([], table.schema)
    rows = classify_lines(read_lines(spark, path), table, as_of, widths)
    reason = F.col(REASON)
    if mode == "strict":
        # The message shows the beginning of a line; the line itself is in the delivery.
        message = F.concat(F.lit(f"{entity}: "), reason, F.lit(" in: "), F.substring(LINE, 1, 200))
        rows = rows.where(F.when(reason.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    elif mode == "lenient":
        rows = rows.where(reason.isNull() | (reason != "malformed"))
    else:
        raise ValueError(f"mode must be strict or lenient, not {mode!r}")
    return rows.select(*table.column_names)


def quarantine_split(
    spark: SparkSession, path: str, entity: str, as_of="1970-01-01 00:00:00", widths: Mapping[str, int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows fit for the table, rejected lines with their reason)."""
    table = raw_table(entity)
    rows = classify_lines(read_lines(spark, path), table, as_of, widths)
    return (
        rows.where(F.col(REASON).isNull()).select(*table.column_names),
        rows.where(F.col(REASON).isNotNull()).select(LINE, REASON),
    )


class QuarantineToleranceError(RuntimeError):
    pass


def load_with_quarantine(
    spark: SparkSession,
    path: str,
    entity: str,
    target: str,
    rejects: str,
    tolerance: int,
    as_of="1970-01-01 00:00:00",
    widths: Mapping[str, int] | None = None,
    load_id: str | None = None,
) -> tuple[int, int]:
    """Append fit rows to ``target`` and rejected lines to ``rejects``.

    The delivery is parsed once and stored by outcome; both counts and outputs come
    from there. Rejects go to ``rejects/load=<load_id>``, by default named after the
    delivery and the load time, so a retried load replaces its own. With
    ``tolerance`` or more of them nothing is appended to the target and the load fails.
    """
    from retailloom.sources.writers import counted_write

    table = raw_table(entity)
    rows = classify_lines(read_lines(spark, path), table, as_of, widths)
    parsed = scratch_path(spark, "parsed")
    rows.withColumn("rejected", F.col(REASON).isNotNull()).write.partitionBy("rejected").parquet(parsed)
    stored = spark.read.schema(T.StructType([*rows.schema, T.StructField("rejected", T.BooleanType())])).parquet(parsed)
    name = load_id or md5(f"{path} {as_of}".encode()).hexdigest()
    bad = stored.where("rejected").select(LINE, REASON)
    rejected = counted_write(bad, lambda df: df.write.mode("overwrite").json(f"{rejects}/load={name}"))
    if rejected >= tolerance:
        raise QuarantineToleranceError(f"{entity}: {rejected} rejected lines, tolerance is {tolerance}; see {rejects}/load={name}")
    good = stored.where("not rejected").select(*table.column_names)
    return counted_write(good, lambda df: df.write.mode("append").parquet(target)), rejected


#: Lines as they are stored here: packed, in files small enough for one task each, as a packed file is not split.
LINE_FILES = {"compression": "lz4", "maxRecordsPerFile": "250000"}


def write_ndjson(df: DataFrame, path: str, fields: Mapping[str, str] | None = None) -> None:
    """One JSON object per line; ``fields`` renames columns to their wire names."""
    fields = fields or {}
    record = F.struct(*(F.col(c).alias(fields.get(c, c)) for c in df.columns))
    df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value")).write.options(**LINE_FILES).text(path)
