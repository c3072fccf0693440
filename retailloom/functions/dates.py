"""Date arithmetic that counts calendar boundaries crossed, not completed units."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = {"hour": 3600, "minute": 60, "second": 1}


def as_timestamp(moment: Column | datetime | date | str) -> Column:
    """A zone-free timestamp; Python values become literals without zone shifts."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    text = moment if isinstance(moment, str) else moment.isoformat(sep=" ") if isinstance(moment, datetime) else moment.isoformat()
    return F.lit(text).cast("timestamp_ntz")


def epoch_millis(moment: Column) -> Column:
    return F.unix_millis(moment.cast("timestamp"))


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Boundaries of ``unit`` between two moments: 10:59 -> 11:01 is one hour.

    Spark's own ``timestampdiff`` answers zero there because it counts whole
    elapsed units.
    """
    if unit == "year":
        return F.year(end) - F.year(start)
    if unit == "month":
        return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))
    if unit == "day":
        return F.datediff(end, start)
    if unit == "millisecond":
        return epoch_millis(end) - epoch_millis(start)
    if unit in _SECONDS:
        size = _SECONDS[unit]

        def tick(moment: Column) -> Column:
            return F.floor(F.unix_seconds(moment.cast("timestamp")) / F.lit(size))

        return tick(end) - tick(start)
    raise ValueError(f"unsupported unit: {unit}")


def date_key(day: Column) -> Column:
    """The date as an integer YYYYMMDD, computed without string formatting."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
