"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import ColumnLike, column

# How key parts are joined and what stands for a NULL part.
PART_SEPARATOR = "-"
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: ColumnLike) -> Column:
    """Hex md5 of the parts: a pure function of the natural key, stable over rebuilds."""
    texts = [F.coalesce(column(p).cast("string"), F.lit(NULL_PART)) for p in parts]
    return F.md5(F.concat_ws(PART_SEPARATOR, *texts))
