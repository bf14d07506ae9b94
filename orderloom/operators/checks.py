"""Data checks. A check is a DataFrame of offending rows; no rows means it holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import column
from orderloom.operators.counting import counters_long, repeated_groups, repeated_tuples


class Accepted(NamedTuple):
    """A column's accepted values; ``where`` limits the rows that are tested."""

    table: str
    column: str
    values: Sequence[object]
    where: str | None = None

    @property
    def name(self) -> str:
        return f"accepted_values.{self.table}.{self.column}"


def null_conditions(table: str, columns: Sequence[str], where: str | None = None) -> dict[str, Column]:
    """Conditions of failing rows by check name, of the not-null check on many columns."""
    tested = F.lit(True) if where is None else F.expr(where)
    return {f"not_null.{table}.{c}": tested & column(c).isNull() for c in columns}


def row_checks(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """(check_name, failures) of any checks on single rows, in one scan."""
    return counters_long(df, conditions, "check_name", "failures")


def null_counts(df: DataFrame, table: str, columns: Sequence[str], where: str | None = None) -> DataFrame:
    """(check_name, failures) of the not-null check on many columns, in one scan."""
    return row_checks(df, null_conditions(table, columns, where))


def repeats(df: DataFrame, columns: Sequence[str], nulls: bool, where: str | None = None, within: Sequence[str] = ()) -> DataFrame:
    """Row counts of the values that occur more than once; NULLs count as a value if ``nulls``.

    ``within`` as for :func:`orderloom.operators.counting.repeated_tuples`.
    """
    rows = df if where is None else df.where(where)
    if not nulls:
        rows = rows.dropna(subset=list(columns))
    return repeated_groups(rows, columns, within=within)


def unexpected_counts(df: DataFrame, tests: Sequence[Accepted]) -> DataFrame:
    """(check_name, failures): distinct values outside each accepted list, all columns in one scan.

    Only offending cells become rows, so nothing else is shuffled.
    """
    cells = []
    for test in tests:
        value = column(test.column)
        offends = value.isNotNull() & ~value.isin(*test.values)
        if test.where is not None:
            offends = offends & F.expr(test.where)
        cells.append(F.when(offends, F.struct(F.lit(test.name).alias("check_name"), value.cast("string").alias("value"))))
    found = df.select(F.explode(F.filter(F.array(*cells), lambda cell: cell.isNotNull())).alias("cell")).select("cell.*").distinct()
    counted = found.groupBy("check_name").agg(F.count(F.lit(1)).alias("failures"))
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t.name) for t in tests])).alias("check_name"))
    return names.join(counted, "check_name", "left").select("check_name", F.coalesce("failures", F.lit(0)).alias("failures"))


def repeated_values(df: DataFrame, col: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return repeated_tuples(df.where(column(col).isNotNull()), [col])


def repeated_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column tuples that occur more than once; NULL counts as a value here."""
    return repeated_tuples(df, columns)


def unexpected_values(
    df: DataFrame, col: str, accepted: Sequence[object], where: Column | None = None
) -> DataFrame:
    """Distinct values outside the accepted list, with their row count. NULL passes.

    The test runs before the grouping, so only offending rows are shuffled.
    """
    rows = df if where is None else df.where(where)
    offending = rows.where(~column(col).isin(*accepted))
    return offending.groupBy(column(col).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))


def orphan_counts(child: DataFrame, keys: Mapping[str, tuple[str, DataFrame]], table: str, marked: str | None = None) -> DataFrame:
    """(key_name, orphans, marked) of many foreign keys, from one scan of the child.

    ``keys`` maps a foreign key to the parent's key and the parent. Keys are
    counted per value before the join, so a value held by most rows costs one row
    per task. ``marked`` names a flag of a parent, whose child rows are counted too.
    """
    names = list(keys)
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("key_name"), column(k).cast("string").alias("value")) for k in names]))
    counted = child.select(cells.alias("cell")).select("cell.*").where("value is not null").groupBy("key_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    parents = []
    for name, (key, parent) in keys.items():
        flag = column(marked) if marked in parent.columns else F.lit(False)
        parents.append(parent.select(F.lit(name).alias("key_name"), column(key).cast("string").alias("value"), flag.alias("flag")))
    known = reduce(DataFrame.unionByName, parents).groupBy("key_name", "value").agg(F.max("flag").alias("flag"))
    found = counted.join(known, ["key_name", "value"], "left").groupBy("key_name")
    return found.agg(
        F.coalesce(F.sum(F.when(F.col("flag").isNull(), F.col("rows"))), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum(F.when(F.col("flag"), F.col("rows"))), F.lit(0)).alias("marked"),
    )


def orphan_rows(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null foreign key is missing from the parent."""
    keys = parent.select(column(key).alias(foreign_key))
    return child.where(column(foreign_key).isNotNull()).join(keys, foreign_key, "left_anti")


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """(key, row_count) of the orphans, counted per key before the join.

    At most one row per key and task is shuffled, so a foreign key held by most
    of the child does not overload one join task.
    """
    present = child.where(column(foreign_key).isNotNull())
    per_key = present.groupBy(column(foreign_key)).agg(F.count(F.lit(1)).alias("row_count"))
    return per_key.join(parent.select(column(key).alias(foreign_key)), foreign_key, "left_anti")


def count_mismatch(left: DataFrame, right: DataFrame, left_name: str, right_name: str, delta: str) -> DataFrame:
    """One row with both row counts and their difference, or none if they agree."""
    counts = left.agg(F.count(F.lit(1)).alias(left_name)).crossJoin(
        right.agg(F.count(F.lit(1)).alias(right_name))
    )
    difference = F.col(left_name) - F.col(right_name)
    return counts.withColumn(delta, difference).where(difference != 0)


def failures(check_name: str, rows: DataFrame, count: Column | None = None) -> DataFrame:
    """Roll offending rows up to (check_name, failures).

    ``count`` replaces the row count where rows were pre-aggregated.
    """
    total = F.count(F.lit(1)) if count is None else F.coalesce(count, F.lit(0)).cast("bigint")
    return rows.agg(F.lit(check_name).alias("check_name"), total.alias("failures"))


def with_limits(result: DataFrame, warn_above: int = 0, error_above: int = 0) -> DataFrame:
    return result.withColumns({"warn_above": F.lit(warn_above), "error_above": F.lit(error_above)})


def level(found: Column, warn_above: Column, error_above: Column) -> Column:
    """ERROR and WARN above their limits, else PASS."""
    return F.when(found > error_above, "ERROR").when(found > warn_above, "WARN").otherwise("PASS")


def status(result: DataFrame) -> DataFrame:
    """(check_name, failures, status) of counts with their limits."""
    found = level(F.col("failures"), F.col("warn_above"), F.col("error_above"))
    return result.select("check_name", F.col("failures").cast("bigint").alias("failures"), found.alias("status"))


def union_all(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
