"""Profile of the raw extract. Every function takes the raw order lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.numbers import percent, round_double
from orderloom.functions.parse import parse_double, parse_int, parse_mdy
from orderloom.functions.text import (
    blank_to_null,
    clean,
    clean_upper,
    column,
    has_text,
    is_blank,
    list_length,
    or_default,
)
from orderloom.operators.counting import counters, counters_long, distinct_counts, repeated_groups, repeated_tuples, top_values, value_counts
from orderloom.operators.dedup import HASH_ROWS, clustering, with_repeated_key
from orderloom.operators.repeats import top_values_of_many
from orderloom.operators.summaries import Summary, summarise
from orderloom.plans.staging import line_key
from orderloom.plans.vocabulary import CANCELLED
from orderloom.sources.schemas import RAW_COLUMNS

NULL_LABEL = "<NULL>"
CATEGORICAL = [
    "Status",
    "Courier Status",
    "Fulfilment",
    "Sales Channel",
    "ship-service-level",
    "Category",
    "Size",
    "currency",
    "ship-country",
    "B2B",
    "fulfilled-by",
]
BUSINESS_COLUMNS = [c for c in RAW_COLUMNS if c != "index"]


def _rows() -> Column:
    return F.count(F.lit(1)).cast("bigint")


def overview(raw: DataFrame) -> DataFrame:
    """Rows, distinct orders, products and places, and the range of order dates, all from one scan.

    Every column's values are counted once; the rows are the sum of one column's
    counts, and only distinct dates are parsed.
    """
    labels = {
        "unique_orders": "Order ID",
        "skus": "SKU",
        "styles": "Style",
        "categories": "Category",
        "sizes": "Size",
        "ship_cities": "ship-city",
        "distinct_dates": "Date",
    }
    counted = value_counts(raw, list(labels.values()))
    of = lambda c: F.col("column_name") == c
    date = F.when(of("Date"), parse_mdy("value"))
    found = F.col("value").isNotNull().cast("int")
    return counted.agg(
        F.coalesce(F.sum(F.when(of("Date"), F.col("count"))), F.lit(0)).cast("bigint").alias("records"),
        F.min(date).alias("date_min"),
        F.max(date).alias("date_max"),
        *[F.coalesce(F.sum(F.when(of(c), found)), F.lit(0)).cast("bigint").alias(name) for name, c in labels.items()],
    ).select(
        "records",
        "unique_orders",
        "skus",
        "styles",
        "categories",
        "sizes",
        "ship_cities",
        "date_min",
        "date_max",
        "distinct_dates",
    )


def order_fanout(raw: DataFrame) -> DataFrame:
    """Orders of several lines, and the most lines of one order."""
    lines = raw.groupBy(column("Order ID")).agg(_rows().alias("lines"))
    return lines.agg(
        F.count_if(F.col("lines") > 1).alias("orders_with_multiple_rows"),
        F.max("lines").alias("max_rows_per_order"),
    )


def style_fanout(raw: DataFrame) -> DataFrame:
    """Styles with several SKUs, and the most SKUs of one style."""
    pairs = raw.where(has_text("Style")).select(column("Style"), column("SKU")).distinct()
    skus = pairs.groupBy("Style").agg(F.count("SKU").alias("skus"))
    return skus.agg(
        F.count_if(F.col("skus") > 1).alias("styles_with_multiple_skus"),
        F.max("skus").alias("max_skus_per_style"),
    )


def _surplus() -> Column:
    return F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).cast("bigint")


def duplicate_pairs(raw: DataFrame) -> DataFrame:
    """(order, sku) pairs that occur again, and the rows beyond the first; clustered lines are counted in place."""
    return repeated_tuples(raw, ["Order ID", "SKU"], within=clustering(raw)).agg(
        _rows().alias("duplicate_groups"), _surplus().alias("extra_rows_in_dupe_groups")
    )


def exact_duplicates(raw: DataFrame, repeated: DataFrame | None = None, broadcast_rows: int = HASH_ROWS) -> DataFrame:
    """Rows that repeat another one in every column but the row index.

    Such rows share their (order, sku). With the table ``repeated`` of repeated
    pairs, only their rows are grouped at full width, if it is small enough to be
    broadcast; else clustered lines are grouped in place, and of others only 16 bytes
    of hashes move, however many rows are repeated.
    """
    if repeated is not None and repeated.limit(broadcast_rows + 1).count() <= broadcast_rows:
        rows = with_repeated_key(raw, line_key(), repeated, True, broadcast_rows)
    elif clustering(raw):
        rows = raw
    else:
        return repeated_groups(raw, BUSINESS_COLUMNS).agg(_surplus().alias("business_level_exact_duplicates"))
    return repeated_tuples(rows, BUSINESS_COLUMNS, within=clustering(raw)).agg(_surplus().alias("business_level_exact_duplicates"))


def _quality() -> dict[str, Column]:
    quantity = parse_int("Qty")
    return {
        "missing_amount": is_blank("Amount"),
        "qty_zero": quantity == 0,
        "qty_negative": quantity < 0,
        "amount_negative": parse_double("Amount") < 0,
        "invalid_dates": has_text("Date") & parse_mdy("Date").isNull(),
        "missing_shipping_info": is_blank("ship-city") | is_blank("ship-state") | is_blank("ship-postal-code") | is_blank("ship-country"),
    }


def quality_counters(raw: DataFrame) -> DataFrame:
    return counters(raw, _quality())


def sku_drift(raw: DataFrame) -> DataFrame:
    """SKUs that carry more than one style, category or size.

    An attribute has several values if its smallest and largest differ. That
    needs no distinct count; repeated tuples are dropped first, by hashing.
    """
    attributes = {"style": "Style", "category": "Category", "size": "Size"}
    tuples = (
        raw.where(has_text("SKU"))
        .select(column("SKU"), *[blank_to_null(source).alias(name) for name, source in attributes.items()])
        .distinct()
    )
    drifts = tuples.groupBy("SKU").agg(*[(F.min(a) != F.max(a)).alias(a) for a in attributes])
    return drifts.agg(*[F.count_if(a).alias(f"sku_{a}_drift") for a in attributes])


def _co_missing() -> dict[str, Column]:
    no_amount, no_currency = is_blank("Amount"), is_blank("currency")
    return {
        "both_null": no_amount & no_currency,
        "only_amount_null": no_amount & ~no_currency,
        "only_currency_null": ~no_amount & no_currency,
    }


def co_missing(raw: DataFrame) -> DataFrame:
    """Whether amount and currency are missing together."""
    return counters(raw, _co_missing())


def fulfilment_crosstab(raw: DataFrame) -> DataFrame:
    by = F.coalesce(blank_to_null("fulfilled-by"), F.lit(NULL_LABEL)).alias("fulfilled_by")
    counted = raw.groupBy(column("Fulfilment"), by).agg(_rows().alias("row_count"))
    return counted.orderBy(F.asc_nulls_last("Fulfilment"), "fulfilled_by")


def status_conflict(status: Column, courier: Column) -> Column:
    """Shipped without the courier's confirmation, or confirmed while still pending."""
    unconfirmed = (status == "Shipped") & courier.isin("Unshipped", CANCELLED)
    premature = status.startswith("Pending") & (courier == "Shipped")
    return unconfirmed | premature


def status_conflicts(raw: DataFrame) -> DataFrame:
    """Conflicting status pairs, untrimmed, with their row count."""
    conflicting = raw.where(status_conflict(column("Status"), column("Courier Status")))
    counted = conflicting.groupBy(
        column("Status"), or_default("Courier Status", NULL_LABEL).alias("courier_status")
    ).agg(_rows().alias("row_count"))
    return counted.orderBy(F.desc("row_count"), "Status", "courier_status")


def casing_collapse(raw: DataFrame) -> DataFrame:
    """Distinct places before and after trimming and upper-casing."""
    return distinct_counts(
        raw,
        {
            "city_raw": "ship-city",
            "city_normalized": clean_upper("ship-city"),
            "state_raw": "ship-state",
            "state_normalized": clean_upper("ship-state"),
            "distinct_countries": "ship-country",
        },
    )


def _anomalies() -> dict[str, Column]:
    status = clean("Status")
    families = {"cancelled": status == CANCELLED, "shipped": status.startswith("Shipped")}
    anomalies = {"qty_zero": parse_int("Qty") == 0, "amount_missing": is_blank("Amount")}
    conditions = {}
    for anomaly, found in anomalies.items():
        conditions[f"{anomaly}_total"] = found
        for family, member in families.items():
            conditions[f"{anomaly}_{family}"] = found & member
    return conditions


def anomalies_by_status(raw: DataFrame) -> DataFrame:
    """Zero quantities and missing amounts, among cancelled and shipped lines."""
    return counters(raw, _anomalies())


def _cancelled_and_priced() -> Column:
    return (column("Status") == CANCELLED) & (parse_double("Amount") > 0)


def cancelled_with_amount(raw: DataFrame) -> DataFrame:
    priced = raw.where(_cancelled_and_priced())
    return priced.agg(_rows().alias("cancelled_orders_with_amount_gt_zero"))


def _promotions() -> dict[str, Column]:
    listed, items = has_text("promotion-ids"), list_length("promotion-ids")
    return {
        "rows_with_promo": F.count_if(listed),
        "max_raw_length": F.max(F.length(column("promotion-ids"))).cast("bigint"),
        "max_promo_count_per_row": F.max(items).cast("bigint"),
        "avg_promo_count_when_present": F.avg(F.when(listed, items)),
    }


def promotion_shape(raw: DataFrame) -> DataFrame:
    """How many lines carry promotions, and how long the lists are."""
    return raw.agg(*[c.alias(name) for name, c in _promotions().items()])


def filled_rows(raw: DataFrame, col: str, alias: str) -> DataFrame:
    """Rows with any text in a column."""
    return raw.agg(F.count_if(has_text(col)).alias(alias))


def missing_by_column(raw: DataFrame, columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Missing cells per column, as count and percentage, from one scan."""
    conditions = {c: is_blank(c) for c in columns}
    counted = counters_long(raw, conditions, "column_name", "missing", total="_total")
    share = round_double(percent(F.col("missing"), F.col("_total")), 2)
    return counted.select("column_name", "missing", share.alias("pct_missing")).orderBy(
        F.desc("missing"), "column_name"
    )


def summaries(columns: Sequence[str] = RAW_COLUMNS) -> dict[str, Summary]:
    """The profiles that are one aggregate of all lines, to be taken from one scan."""
    rows = F.count(F.lit(1))
    missing = {c: F.count_if(is_blank(c)) for c in columns}
    return {
        "quality_counters": Summary.of_conditions(_quality()),
        "co_missing": Summary.of_conditions(_co_missing()),
        "anomalies_by_status": Summary.of_conditions(_anomalies()),
        "cancelled_with_amount": Summary.of_conditions({"cancelled_orders_with_amount_gt_zero": _cancelled_and_priced()}),
        "promotion_shape": Summary(_promotions()),
        "filled_rows": Summary.of_conditions({"unnamed_22_non_empty": has_text("Unnamed: 22")}),
        "missing": Summary(missing),
        "pct_missing": Summary({**missing, "_rows": rows}, lambda found: {c: round_double(percent(found[c], found["_rows"]), 2) for c in missing}),
    }


def bundle(raw: DataFrame, chosen: Mapping[str, Summary] | None = None) -> DataFrame:
    """(profile, measure, value) of many profiles, from one scan."""
    return summarise(raw, summaries() if chosen is None else chosen)


def value_distribution(raw: DataFrame, columns: Sequence[str] = CATEGORICAL, k: int = 15) -> DataFrame:
    """The most frequent values of each column."""
    found = top_values(raw, columns, k, NULL_LABEL)
    return found.orderBy("column_name", F.desc("count"), "value")


def value_distribution_of_many(raw: DataFrame, columns: Sequence[str] = (*CATEGORICAL, "Order ID", "ASIN"), k: int = 15) -> DataFrame:
    """The same for columns of very many values, of which those that occur once aren't shuffled."""
    return top_values_of_many(raw, columns, k, NULL_LABEL).orderBy("column_name", F.desc("count"), "value")


def category_cardinality(raw: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Distinct values per column."""
    label = lambda c: c.lower().replace(" ", "_").replace("-", "_") + "_distinct"
    return distinct_counts(raw, {label(c): c for c in columns})
