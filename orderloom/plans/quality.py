"""The quality suite: every declared check on the stored warehouse, with its status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators import checks
from orderloom.operators.counting import distinct_tuples
from orderloom.operators.dedup import clustering
from orderloom.operators.joins import join_dimension
from orderloom.plans import vocabulary as v
from orderloom.plans.fact import Star
from orderloom.plans.profile import status_conflict
from orderloom.sources.schemas import DIM_DATE, DIM_GEOGRAPHY, DIM_ORDER_STATUS

NOT_NULL = {
    "stg_orders": [
        "order_id",
        "sku",
        "order_date",
        "status_detail",
        "quantity",
        "is_b2b",
        "is_cancelled",
        "promo_count",
    ],
    "dim_date": DIM_DATE.names,
    "dim_product": ["product_key", "sku", "product_style", "product_category", "product_size"],
    "dim_geography": DIM_GEOGRAPHY.names,
    "dim_order_status": DIM_ORDER_STATUS.names,
    "fct_sales": [
        "sales_key",
        "date_key",
        "product_key",
        "geography_key",
        "status_key",
        "order_id",
        "sku",
        "quantity",
        "promo_count",
        "is_cancelled",
        "is_b2b",
    ],
}
UNIQUE = {
    "dim_date": ["date_key", "full_date"],
    "dim_product": ["product_key", "sku"],
    "dim_geography": ["geography_key"],
    "dim_order_status": ["status_key", "status_detail"],
    "fct_sales": ["sales_key"],
}
UNIQUE_COMBINATION = {"stg_orders": ["order_id", "sku"], "fct_sales": ["order_id", "sku"]}
FOREIGN_KEYS = {
    "date_key": "dim_date",
    "product_key": "dim_product",
    "geography_key": "dim_geography",
    "status_key": "dim_order_status",
}


class Limits(NamedTuple):
    warn_above: int = 0
    error_above: int = 0


# Tolerated rows before a warning and before an error.
UNKNOWN_REGION_LIMITS = Limits(3000, 10000)
STATUS_CONFLICT_LIMITS = Limits(250, 1000)


def accepted_values(fulfilments: Sequence[str]) -> list[checks.Accepted]:
    """Accepted values of the declared columns. Fulfilment providers differ by business."""
    return [
        checks.Accepted("stg_orders", "status_detail", [s.detail for s in v.STATUSES]),
        checks.Accepted("stg_orders", "courier_status", v.COURIER_STATUSES, "courier_status is not null"),
        checks.Accepted("stg_orders", "fulfilment", fulfilments),
        checks.Accepted("dim_date", "season", v.SEASONS),
        checks.Accepted("dim_geography", "region", v.REGIONS),
        checks.Accepted("dim_order_status", "status_group", v.STATUS_GROUPS),
    ]


def accepted_counts(tables: Mapping[str, DataFrame], tests: Sequence[checks.Accepted]) -> list[DataFrame]:
    """(check_name, failures) of accepted-values tests, one scan per table."""
    return [checks.unexpected_counts(tables[t], [x for x in tests if x.table == t]) for t in dict.fromkeys(x.table for x in tests)]


def cancelled_revenue() -> Column:
    """Whether a line is cancelled and yet has revenue."""
    return F.col("is_cancelled") & (F.col("revenue_amount") != 0)


def cancelled_revenue_rows(star: Star) -> DataFrame:
    """Cancelled lines whose revenue is not zero."""
    return star.fact.where(cancelled_revenue()).join(star.statuses, "status_key").select(
        "order_id", "sku", "status_detail", "amount", "revenue_amount"
    )


def terminal_mismatch() -> Column:
    """Whether a status has a terminal flag that contradicts its group."""
    group, terminal = F.col("status_group"), F.col("is_terminal")
    return (group.isin(v.TERMINAL_GROUPS) & ~terminal) | (group.isin(v.OPEN_GROUPS) & terminal)


def terminal_mismatch_rows(statuses: DataFrame) -> DataFrame:
    """Statuses whose terminal flag contradicts their group."""
    return statuses.where(terminal_mismatch()).select("status_detail", "status_group", "is_terminal")


def unknown_region_rows(star: Star) -> DataFrame:
    """Fact lines whose place has no region."""
    unmapped = star.places.where(F.col("region") == v.UNKNOWN_REGION)
    found = join_dimension(star.fact, unmapped.select("geography_key", "ship_state"), "geography_key")
    return found.select("order_id", "sku", "ship_state")


def unknown_region_count(star: Star) -> DataFrame:
    """(check_name, failures) for :func:`unknown_region_rows`, counted per place before the join."""
    per_place = star.fact.groupBy("geography_key").agg(F.count(F.lit(1)).alias("row_count"))
    unmapped = star.places.where(F.col("region") == v.UNKNOWN_REGION).select("geography_key")
    found = per_place.join(unmapped, "geography_key")
    return checks.failures("unknown_region.fct_sales", found, F.sum("row_count"))


def status_conflict_rows(staging: DataFrame) -> DataFrame:
    conflicting = status_conflict(F.col("status_detail"), F.col("courier_status"))
    return staging.where(conflicting).select("order_id", "sku", "status_detail", "courier_status")


def fact_count_mismatch(star: Star, staging: DataFrame) -> DataFrame:
    """Lines lost or multiplied on the way from staging to the fact."""
    return checks.count_mismatch(star.fact, staging, "fact_rows", "staging_rows", "delta_rows")


def staging_count_mismatch(raw: DataFrame, staging: DataFrame) -> DataFrame:
    """Distinct raw (order, sku) pairs, untrimmed, against staging rows; at most hashes of the pairs are shuffled."""
    pairs = distinct_tuples(raw, ["Order ID", "SKU"], clustering(raw))
    return checks.count_mismatch(
        pairs, staging, "expected_rows_from_raw_dedup", "actual_staging_rows", "unexpected_delta"
    )


ROWS = "rows."


def row_conditions(table: str, where: str | None = None) -> dict[str, Column]:
    """All checks on single rows of a table, as conditions of failing rows by check name."""
    own = checks.null_conditions(table, NOT_NULL.get(table, []), where)
    if table == "stg_orders":
        own["status_conflict.stg_orders"] = status_conflict(F.col("status_detail"), F.col("courier_status"))
    if table == "fct_sales":
        own["cancelled_revenue.fct_sales"] = cancelled_revenue()
    if table == "dim_order_status":
        own["terminal_contract.dim_order_status"] = terminal_mismatch()
    return own


def _known_counts(spark: SparkSession, found: Mapping[str, int]) -> DataFrame:
    """(check_name, failures) of counts that are known already."""
    rows = [F.struct(F.lit(name).alias("check_name"), F.lit(n).cast("bigint").alias("failures")) for name, n in found.items()]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def suite(
    raw: DataFrame,
    staging: DataFrame,
    star: Star,
    fulfilments: Sequence[str],
    unknown_region: Limits = UNKNOWN_REGION_LIMITS,
    status_conflicts: Limits = STATUS_CONFLICT_LIMITS,
    where: Mapping[str, str] | None = None,
    limits: Mapping[str, Limits] | None = None,
    measured: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """(check_name, failures, status) of all 72 checks, as one job.

    All checks on single rows, and the row counts, share one scan per table; so do
    the accepted values, and the foreign keys with the unknown regions. Uniqueness
    takes a scan of each key, of which only hashes are shuffled. ``measured`` has, by
    table, the rows and the failures of checks on single rows that were counted while the
    table was written; such a table isn't scanned for them again. ``where`` limits
    the rows of a table's not-null and uniqueness checks; ``limits`` tolerates
    failures of a check by name.
    """
    where = where or {}
    tables = {
        "stg_orders": staging,
        "dim_date": star.dates,
        "dim_product": star.products,
        "dim_geography": star.places,
        "dim_order_status": star.statuses,
        "fct_sales": star.fact,
    }
    own = {t: row_conditions(t, where.get(t)) for t in NOT_NULL}
    for t in ("stg_orders", "fct_sales"):
        own[t][ROWS + t] = F.lit(True)
    known = {}
    for t, counts in (measured or {}).items():
        if not where.get(t) and own[t].keys() <= counts.keys():
            known |= {name: counts[name] for name in own.pop(t)}
    found = [checks.row_checks(tables[t], conditions) for t, conditions in own.items()]
    if known:
        found.append(_known_counts(star.fact.sparkSession, known))
    found += accepted_counts(tables, accepted_values(fulfilments))
    for t, columns in UNIQUE.items():
        found += [checks.failures(f"unique.{t}.{c}", checks.repeats(tables[t], [c], False, where.get(t))) for c in columns]
    for t, columns in UNIQUE_COMBINATION.items():
        found.append(checks.failures(f"unique_combination.{t}.{'+'.join(columns)}", checks.repeats(tables[t], columns, True, where.get(t))))
    found.append(checks.failures(ROWS + "raw", distinct_tuples(raw, ["Order ID", "SKU"], clustering(raw))))
    flagged = star.places.withColumn("unmapped", F.col("region") == v.UNKNOWN_REGION)
    parents = {k: (k, flagged if t == "dim_geography" else tables[t]) for k, t in FOREIGN_KEYS.items()}
    orphans = checks.orphan_counts(star.fact, parents, "fct_sales", "unmapped")
    # a key held by no row at all has no line of its own: its count is 0
    found.append(orphans.select(F.explode(F.array(
        F.struct(F.concat(F.lit("relationships.fct_sales."), "key_name").alias("check_name"), F.col("orphans").cast("bigint").alias("failures")),
        F.struct(F.concat(F.lit("marked."), "key_name").alias("check_name"), F.col("marked").cast("bigint").alias("failures")),
    )).alias("x")).select("x.*"))
    counts = checks.union_all([x.select("check_name", F.col("failures").cast("bigint").alias("failures")) for x in found])
    return checks.status(_results(counts, fulfilments, unknown_region, status_conflicts, limits or {}))


def check_names(fulfilments: Sequence[str]) -> list[str]:
    """Names of the 72 checks."""
    names = [f"not_null.{t}.{c}" for t, columns in NOT_NULL.items() for c in columns]
    names += [f"unique.{t}.{c}" for t, columns in UNIQUE.items() for c in columns]
    names += [x.name for x in accepted_values(fulfilments)]
    names += [f"relationships.fct_sales.{k}" for k in FOREIGN_KEYS]
    names += [f"unique_combination.{t}.{'+'.join(columns)}" for t, columns in UNIQUE_COMBINATION.items()]
    return names + [
        "row_count.fct_sales.stg_orders",
        "row_count.stg_orders.raw",
        "cancelled_revenue.fct_sales",
        "terminal_contract.dim_order_status",
        "unknown_region.fct_sales",
        "status_conflict.stg_orders",
    ]


def _results(counts: DataFrame, fulfilments: Sequence[str], unknown_region: Limits, status_conflicts: Limits, limits: Mapping[str, Limits]) -> DataFrame:
    """One row per check with its limits, from the counts, of which there are about as many as checks."""
    known = counts.agg(F.map_from_entries(F.collect_list(F.struct("check_name", "failures"))).alias("m"))
    of = lambda name: F.coalesce(F.try_element_at("m", F.lit(name)), F.lit(0).cast("bigint"))
    differ = lambda a, b: (of(ROWS + a) != of(ROWS + b)).cast("bigint")
    derived = {
        "row_count.fct_sales.stg_orders": differ("fct_sales", "stg_orders"),
        "row_count.stg_orders.raw": differ("raw", "stg_orders"),
        "unknown_region.fct_sales": of("marked.geography_key"),
    }
    tolerated = {"unknown_region.fct_sales": unknown_region, "status_conflict.stg_orders": status_conflicts, **limits}
    rows = []
    for name in check_names(fulfilments):
        warn, error = tolerated.get(name, Limits())
        rows.append(F.struct(F.lit(name).alias("check_name"), derived.get(name, of(name)).alias("failures"), F.lit(warn).alias("warn_above"), F.lit(error).alias("error_above")))
    return known.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
