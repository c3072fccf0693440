"""Reconcile the field-name and field-shape variants a record may arrive in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from retailloom.functions import first_truthy
from retailloom.schemas import Column as RawColumn

# What a field with alternative names becomes when none of them is usable.
DEFAULTS = {"store_name": "", "discount_type": "", "store_size_sqm": "0"}


def resolve_wire_value(field: Mapping[str, Column], column: RawColumn) -> Column:
    """The column's text, falling back to its alternative name when empty or zero."""
    first, *others = column.wire_names
    value = field[first]
    if not others:
        return value
    if column.type.startswith("decimal"):
        value = F.when(value.try_cast("double") != 0, value)
    if column.name in DEFAULTS:
        return first_truthy(value, field[others[0]], DEFAULTS[column.name])
    return F.coalesce(F.nullif(value, F.lit("")), field[others[0]])


def polymorphic_address(address: Column) -> Column:
    """An address given as text stays as it is, as an object becomes "street, city, country".

    ``address`` is the parsed value with its own type, which a declared schema could not tell.
    """
    shape = F.schema_of_variant(address)

    def part(name: str) -> Column:
        return F.coalesce(F.try_variant_get(address, f"$.{name}", "string"), F.lit(""))

    joined = F.concat(part("street"), F.lit(", "), part("city"), F.lit(", "), part("country"))
    return (
        F.when(shape == "STRING", F.try_variant_get(address, "$", "string"))
        .when(shape.startswith("OBJECT"), F.trim(joined, F.lit(", ")))
        .otherwise(F.lit(""))
    )


def address_as_json(address: Column) -> Column:
    """A structured address as JSON text, for storing in a text column."""
    return F.to_json(address)
