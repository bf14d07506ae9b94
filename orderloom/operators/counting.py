"""Counting over many columns in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.functions.text import column

# Columns turned into rows at a time, which bounds how far a pass multiplies its input.
COLUMNS_PER_PASS = 12


def counters(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row with a count per named condition, from a single scan."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])


def counters_long(
    df: DataFrame, conditions: Mapping[str, Column], name: str, value: str, total: str | None = None
) -> DataFrame:
    """Like :func:`counters`, with one row per condition; ``total`` adds the row count."""
    wide = [F.count_if(cond).alias(key) for key, cond in conditions.items()]
    ids = []
    if total is not None:
        wide.append(F.count(F.lit(1)).alias(total))
        ids = [column(total)]
    return df.agg(*wide).unpivot(ids, [column(key) for key in conditions], name, value)


def _text(name: str) -> Column:
    return column(name).cast("string")


def value_counts(df: DataFrame, columns: Sequence[str], null_label: str | None = None) -> DataFrame:
    """(column_name, value, count) over several columns, one scan per pass.

    Values are text: equal values of a column have equal text and different ones
    different text, so counts of distinct values stay exact for numbers, dates,
    flags and strings.

    Each row becomes one narrow pair per column, and the pairs are counted
    before the shuffle, so a value that fills most rows costs one row per task.
    """
    parts = []
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        batch = columns[start : start + COLUMNS_PER_PASS]
        cells = df.select(
            *[
                (_text(c) if null_label is None else F.coalesce(_text(c), F.lit(null_label))).alias(c)
                for c in batch
            ]
        )
        pairs = cells.unpivot([], [column(c) for c in batch], "column_name", "value")
        parts.append(pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")))
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    return counted


def top_values(df: DataFrame, columns: Sequence[str], k: int, null_label: str = "<NULL>") -> DataFrame:
    """The ``k`` most frequent values of each column; ties go to the smaller value."""
    by_column = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc("value"))
    ranked = value_counts(df, columns, null_label).withColumn("_rank", F.row_number().over(by_column))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def distinct_counts(
    df: DataFrame, labels: Mapping[str, str | Column], relative_error: float | None = None
) -> DataFrame:
    """One row with the distinct non-null values per labelled column or expression.

    Several ``count(distinct)`` in one aggregate make Spark copy each row once
    per column at full width. Counting the distinct (column, value) pairs
    instead keeps those copies two fields wide. With ``relative_error`` the counts
    are estimated in one pass, from sketches of fixed size.
    """
    cells = df.select(*[(c if isinstance(c, Column) else column(c)).alias(name) for name, c in labels.items()])
    if relative_error is not None:
        return cells.agg(*[F.approx_count_distinct(column(n), relative_error).alias(n) for n in labels])
    counted = value_counts(cells, list(labels))
    found = (F.col("value").isNotNull()).cast("int")
    return counted.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("column_name") == name, found)), F.lit(0)).cast("bigint").alias(name)
            for name in labels
        ]
    )


def repeated_tuples(df: DataFrame, keys: Sequence[str], count: str = "row_count", within: Sequence[str] = ()) -> DataFrame:
    """Key tuples that occur more than once, with their row count.

    ``within`` names columns that rows of equal keys share. Where the rows are stored
    clustered by them, they are grouped in place and nothing is shuffled.
    """
    groups = df.groupBy(*map(column, [*within, *keys])).agg(F.count(F.lit(1)).alias(count))
    return groups.where(F.col(count) > 1).select(*map(column, keys), count)


def tuple_hashes(keys: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a key tuple, NULLs included: 16 bytes that stand for keys of any width.

    Two different tuples among n share both with a chance of about n * n / 2**129.
    """
    parts = [part for k in keys for part in (column(k), column(k).isNull())]
    return [F.xxhash64(*parts).alias("_hash_a"), F.xxhash64(F.lit("second"), *parts).alias("_hash_b")]


def repeated_groups(df: DataFrame, keys: Sequence[str], count: str = "row_count", within: Sequence[str] = ()) -> DataFrame:
    """Row counts of the key tuples that occur more than once, without the tuples.

    Only hashes are shuffled, whatever the width of the keys; with ``within``, as
    for :func:`repeated_tuples`, nothing is.
    """
    if within:
        return repeated_tuples(df, keys, count, within).select(count)
    return df.groupBy(*tuple_hashes(keys)).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1).select(count)


def distinct_tuples(df: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """One row per distinct key tuple: its hashes or, with ``within`` as for :func:`repeated_tuples`, the tuple."""
    if within:
        return df.select(*map(column, [*within, *keys])).distinct()
    return df.select(*tuple_hashes(keys)).distinct()
