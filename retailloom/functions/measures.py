from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Revenue floors of the customer tiers, highest first.
TIER_FLOORS = (("VIP", 5000), ("High Value", 1000), ("Regular", 100))

# Sales region of each store country; any other country is "Other".
STORE_REGIONS = {
    "France": "Europe",
    "Italy": "Europe",
    "United Kingdom": "Europe",
    "Spain": "Europe",
    "Germany": "Europe",
    "United States": "Americas",
    "Japan": "Asia-Pacific",
}


def percent_of(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; NULL when the whole is zero or NULL."""
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, digits)


def value_tier(revenue: Column, orders: Column, floors: Sequence[tuple[str, int]] = TIER_FLOORS) -> Column:
    """Tier by observed revenue, then by having ordered at all.

    Takes the aggregates before NULLs are replaced: a customer without sales has
    NULL for both and is Inactive.
    """
    (name, floor), *rest = floors
    tier = F.when(revenue >= floor, name)
    for name, floor in rest:
        tier = tier.when(revenue >= floor, name)
    return tier.when(orders >= 1, "Occasional").otherwise("Inactive")


def region_of(country: Column, regions: Mapping[str, str] = STORE_REGIONS) -> Column:
    lookup = F.create_map(*(F.lit(x) for x in chain.from_iterable(regions.items())))
    return F.coalesce(F.try_element_at(lookup, country), F.lit("Other"))


def first_truthy(value: Column, fallback: Column, default: str | int) -> Column:
    """``value`` unless it is NULL, empty or zero, else ``fallback``, else ``default``."""
    return F.coalesce(F.nullif(value, F.lit(type(default)())), fallback, F.lit(default))
