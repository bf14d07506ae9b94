"""Reading only the part of an ordered table that a filtered dimension points to.

A join tells which rows of a large table are wanted only after they were read. The
keys of a filtered dimension are few, so they are turned into a few ranges first,
which the scan compares with the least and greatest key of each row group. That
helps where rows are stored in the order of the key; elsewhere every group spans all keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import column

#: Keys that are looked at on the driver (text of some 40 bytes each), and ranges that a scan is given, at most.
MOST_KEYS, MOST_RANGES = 20_000, 64


def _place(key: str | int) -> int:
    """A number in the order of the keys, from their first bytes."""
    return key if isinstance(key, int) else int.from_bytes(key.encode()[:8].ljust(8, b"\0"))


def key_ranges(keys: Sequence[str] | Sequence[int], most: int = MOST_RANGES) -> list[tuple]:
    """At most ``most`` ranges (least, greatest) that hold all keys, apart at the widest gaps."""
    ordered = sorted(set(keys))
    gaps = sorted(range(1, len(ordered)), key=lambda i: _place(ordered[i - 1]) - _place(ordered[i]))[: most - 1]
    cuts = [0, *sorted(gaps), len(ordered)]
    return [(ordered[a], ordered[b - 1]) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def near_keys(rows: DataFrame, on: str, keys: DataFrame, most_keys: int = MOST_KEYS, most_ranges: int = MOST_RANGES) -> DataFrame:
    """``rows`` without some of those whose ``on`` isn't among the column of that name in ``keys``; never without others.

    A join on the keys has to follow. More than ``most_keys`` keys limit nothing.
    """
    few = keys.where(column(on).isNotNull()).select(column(on)).distinct().limit(most_keys + 1)
    found = few.agg(F.sort_array(F.collect_list(on))).first()[0]
    if len(found) > most_keys:
        return rows
    if not found:
        return rows.where(F.lit(False))
    tests = [column(on) == a if a == b else column(on).between(a, b) for a, b in key_ranges(found, most_ranges)]
    return rows.where(reduce(or_, tests))
