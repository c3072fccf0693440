"""Column expressions shared by the operators. All are native Spark expressions."""

from retailloom.functions.dates import as_timestamp, boundary_diff, date_key, epoch_millis
from retailloom.functions.keys import NULL_KEY_PLACEHOLDER, surrogate_key
from retailloom.functions.measures import first_truthy, percent_of, region_of, value_tier

__all__ = [
    "NULL_KEY_PLACEHOLDER",
    "as_timestamp",
    "boundary_diff",
    "date_key",
    "epoch_millis",
    "first_truthy",
    "percent_of",
    "region_of",
    "surrogate_key",
    "value_tier",
]
