"""Raw extract to one clean, typed row per (order, sku)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import parse, text
from orderloom.operators.dedup import HASH_ROWS, keep_first
from orderloom.plans.vocabulary import CANCELLED
from orderloom.sources.schemas import MONEY, STAGING, conform

# Staging column, raw column, conversion. Raw columns not listed here are left out.
CONVERSIONS = [
    ("order_id", "Order ID", text.clean),
    ("sku", "SKU", text.clean),
    ("order_date", "Date", parse.parse_mdy),
    ("status_detail", "Status", text.clean),
    ("courier_status", "Courier Status", text.clean),
    ("fulfilment", "Fulfilment", text.clean),
    ("sales_channel", "Sales Channel", text.clean),
    ("ship_service_level", "ship-service-level", text.clean),
    ("product_style", "Style", text.clean),
    ("product_category", "Category", text.clean),
    ("product_size", "Size", text.clean),
    ("asin", "ASIN", text.clean),
    ("quantity", "Qty", parse.parse_int),
    ("amount", "Amount", parse.parse_money),
    ("currency", "currency", text.clean),
    ("ship_city", "ship-city", text.clean_upper),
    ("ship_city_raw", "ship-city", text.clean),
    ("ship_state", "ship-state", text.clean_upper),
    ("ship_state_raw", "ship-state", text.clean),
    ("ship_postal_code", "ship-postal-code", text.before_dot),
    ("ship_country", "ship-country", text.clean),
    ("promotion_ids_raw", "promotion-ids", text.blank_to_null),
    ("is_b2b", "B2B", text.is_true_text),
]


def line_key() -> list[Column]:
    return [text.clean("Order ID"), text.clean("SKU")]


def best_lines(raw: DataFrame, repeated: DataFrame | None = None, broadcast_rows: int = HASH_ROWS) -> DataFrame:
    """One raw row per (order, sku): a row with an amount first, then the latest one.

    Only the four values that decide are parsed before the shuffle, and the rows
    travel as the raw text, which holds each value once.
    """
    order = [parse.parse_money("Amount").isNull(), parse.parse_int("index").desc_nulls_last()]
    return keep_first(raw, line_key(), order, repeated, broadcast_rows)


def typed_lines(raw: DataFrame) -> DataFrame:
    """Renamed, cleaned and typed columns."""
    return raw.select(*[convert(source).alias(name) for name, source, convert in CONVERSIONS])


def revenue(cancelled: Column, amount: Column) -> Column:
    """The amount, or zero on a cancelled line; a cancelled flag of NULL counts as no."""
    return F.when(cancelled, F.lit(0).cast(MONEY)).otherwise(amount)


def with_measures(lines: DataFrame) -> DataFrame:
    cancelled = F.col("status_detail") == CANCELLED
    return lines.withColumns(
        {
            "is_cancelled": cancelled,
            "revenue_amount": revenue(cancelled, F.col("amount")),
            "promo_count": F.coalesce(text.list_length("promotion_ids_raw"), F.lit(0)),
        }
    )


def staged_lines(raw: DataFrame, repeated: DataFrame | None = None, broadcast_rows: int = HASH_ROWS) -> DataFrame:
    """Staging; ``repeated`` as in :func:`orderloom.operators.dedup.keep_first`."""
    return conform(with_measures(typed_lines(best_lines(raw, repeated, broadcast_rows))), STAGING)
