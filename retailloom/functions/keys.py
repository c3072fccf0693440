from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a NULL natural key is hashed as, so its key is constant, not NULL.
NULL_KEY_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*natural: str | Column) -> Column:
    """MD5 of the natural key; parts of a composite key are joined by ``-``.

    Facts derive their dimension keys with this instead of looking them up, so
    building a fact never joins a dimension.
    """
    parts = []
    for i, key in enumerate(natural):
        column = F.col(key) if isinstance(key, str) else key
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(column.cast("string"), F.lit(NULL_KEY_PLACEHOLDER)))
    return F.md5(parts[0] if len(parts) == 1 else F.concat(*parts))
