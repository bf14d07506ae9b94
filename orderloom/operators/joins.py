"""Joins of a large table to a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimension rows sent to every executor at most. Callers pass md5 keys and short
# labels only, so this many rows stay near 100 MB.
BROADCAST_ROWS = 500_000


def join_dimension(
    rows: DataFrame, dimension: DataFrame, on: str | Sequence[str], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Inner join that broadcasts the dimension only if a count shows it fits.

    Above the limit the join is left to Spark, which shuffles both sides and
    splits skewed partitions at run time. The count reads a materialised
    dimension and stops at the limit.
    """
    fits = dimension.limit(broadcast_rows + 1).count() <= broadcast_rows
    return rows.join(F.broadcast(dimension) if fits else dimension, on)
