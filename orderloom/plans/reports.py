"""Business reports on the star.

Each report filters through the small dimensions first and then sums the fact
per foreign key, so that only sums, one per key and task, are shuffled to the
dimensions that grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.numbers import ratio
from orderloom.operators.joins import join_dimension
from orderloom.operators.skipping import near_keys
from orderloom.plans.fact import Star
from orderloom.plans.vocabulary import SOLD_GROUPS, UNKNOWN_REGION

MILLION = 1e6


def _in_country(fact: DataFrame, country: str | None) -> DataFrame:
    """Lines shipped to the country; a line without address fails the test."""
    return fact if country is None else fact.where(F.col("ship_country") == country)


def _units() -> Column:
    return F.sum("quantity").cast("bigint").alias("units")


def _revenue() -> Column:
    return F.sum("revenue_amount").cast("decimal(38,2)").alias("revenue")


def _sold_in_city(
    star: Star, city: str, country: str | None, status_groups: Sequence[str], attribute: str
) -> DataFrame:
    """(attribute, units, revenue) of one city, by a product attribute."""
    statuses = star.statuses.where(F.col("status_group").isin(*status_groups)).select("status_key")
    city_keys = star.places.where(F.col("ship_city") == city).select("geography_key")
    fact = near_keys(star.fact, "geography_key", city_keys) if star.by_place else star.fact
    lines = _in_country(fact, country).join(statuses, "status_key")
    per_product = join_dimension(lines, city_keys, "geography_key").groupBy("product_key").agg(_units(), _revenue())
    return (
        per_product.join(star.products.select("product_key", attribute), "product_key")
        .groupBy(attribute)
        .agg(F.sum("units").cast("bigint").alias("units"), F.sum("revenue").cast("decimal(38,2)").alias("revenue"))
    )


def top_styles(
    star: Star, city: str, country: str | None, k: int = 10, status_groups: Sequence[str] = SOLD_GROUPS
) -> DataFrame:
    """Best-selling styles of a city by units."""
    sold = _sold_in_city(star, city, country, status_groups, "product_style")
    return sold.select("product_style", "units").orderBy(F.desc("units"), "product_style").limit(k)


def category_units(
    star: Star, city: str, country: str | None, status_groups: Sequence[str] = SOLD_GROUPS
) -> DataFrame:
    """Units of every category sold in a city."""
    sold = _sold_in_city(star, city, country, status_groups, "product_category")
    return sold.select("product_category", "units").orderBy(F.desc("units"), "product_category")


def style_revenue(
    star: Star, city: str, country: str | None = None, k: int = 5, status_groups: Sequence[str] = SOLD_GROUPS
) -> DataFrame:
    """Units and revenue of a city's best-selling styles."""
    sold = _sold_in_city(star, city, country, status_groups, "product_style")
    rounded = F.round("revenue", 2).cast("decimal(38,2)").alias("revenue_inr")
    return sold.select("product_style", "units", rounded).orderBy(F.desc("units"), "product_style").limit(k)


def season_revenue(star: Star, country: str | None) -> DataFrame:
    """Revenue per season, in total and per day with data, from the first month on.

    ``orders`` counts order lines.
    """
    per_day = (
        _in_country(star.fact, country).groupBy("date_key").agg(F.count(F.lit(1)).alias("lines"), _revenue())
    )
    days = star.dates.select("date_key", "full_date", "month", "season")
    total = F.sum("revenue")
    seasons = (
        per_day.join(days, "date_key")
        .groupBy("season")
        .agg(
            F.count_distinct("full_date").alias("days_in_data"),
            F.sum("lines").cast("bigint").alias("orders"),
            total.cast("decimal(38,2)").alias("total_revenue"),
            ratio(total, F.count_distinct("full_date")).alias("avg_daily_revenue"),
            F.min("month").alias("first_month"),
        )
    )
    return seasons.orderBy("first_month", "season").select(
        "season",
        "days_in_data",
        "orders",
        "total_revenue",
        "avg_daily_revenue",
        (F.col("total_revenue").cast("double") / MILLION).alias("total_revenue_millions"),
        (F.col("avg_daily_revenue") / MILLION).alias("avg_daily_revenue_millions"),
    )


def cancellation_rate(star: Star, country: str | None) -> DataFrame:
    """Share of cancelled lines, in percent, per known region; highest first."""
    per_place = (
        _in_country(star.fact, country)
        .groupBy("geography_key")
        .agg(F.count(F.lit(1)).alias("lines"), F.count_if("is_cancelled").alias("cancelled"))
    )
    known = star.places.where(F.col("region") != UNKNOWN_REGION).select("geography_key", "region")
    per_region = (
        per_place.join(known, "geography_key")
        .groupBy("region")
        .agg(F.sum("lines").cast("bigint").alias("line_items"), F.sum("cancelled").alias("cancelled"))
    )
    rate = F.lit(100.0) * ratio(F.col("cancelled"), F.col("line_items"))
    return per_region.select("region", "line_items", rate.alias("cancellation_rate")).orderBy(
        F.desc("cancellation_rate"), "region"
    )
