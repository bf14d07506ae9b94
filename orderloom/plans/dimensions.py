"""The four dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.functions.keys import surrogate_key
from orderloom.operators.dedup import collapse_max
from orderloom.plans import vocabulary as v
from orderloom.sources.constants import literal_rows
from orderloom.sources.schemas import DIM_DATE, DIM_GEOGRAPHY, DIM_ORDER_STATUS, DIM_PRODUCT, REGIONS, conform

PLACE = ["ship_country", "ship_city", "ship_state", "ship_postal_code"]
PRODUCT_ATTRIBUTES = ["asin", "product_style", "product_category", "product_size"]


def products(staging: DataFrame) -> DataFrame:
    """One row per sku; where attributes drift, the largest value of each wins."""
    per_sku = collapse_max(staging, ["sku"], PRODUCT_ATTRIBUTES)
    keyed = per_sku.select(surrogate_key("sku").alias("product_key"), "sku", *PRODUCT_ATTRIBUTES)
    return conform(keyed, DIM_PRODUCT)


def season(month: Column) -> Column:
    names = [F.when(month.isin(months), name) for name, months in v.SEASON_MONTHS.items()]
    return F.coalesce(*names, F.lit(v.OTHER_SEASON))


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    weekday = F.dayofweek(day) - 1
    attributes = {
        "date_key": F.date_format(day, "yyyyMMdd").cast("int"),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": weekday.isin(0, 6),
        "week_of_year": F.weekofyear(day),
        "season": season(F.month(day)),
    }
    return conform(days.select(*[c.alias(name) for name, c in attributes.items()]), DIM_DATE)


def calendar(spark: SparkSession, start: str = v.CALENDAR_START, end: str = v.CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    last = F.date_sub(F.lit(end).cast("date"), 1)
    span = F.sequence(F.lit(start).cast("date"), last)
    return _calendar(spark.range(1).select(F.explode(span).alias("full_date")))


def calendar_covering(rows: DataFrame, date: str) -> DataFrame:
    """Whole years around the dates that occur in ``rows``."""
    bounds = rows.agg(F.min(date).alias("first"), F.max(date).alias("last"))
    start = F.trunc("first", "year")
    end = F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1)
    return _calendar(bounds.select(F.explode(F.sequence(start, end)).alias("full_date")))


def order_statuses(spark: SparkSession) -> DataFrame:
    rows = literal_rows(spark, v.STATUSES, StructType(DIM_ORDER_STATUS.fields[1:]))
    return conform(rows.select(surrogate_key("status_detail").alias("status_key"), "*"), DIM_ORDER_STATUS)


def state_regions(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, v.STATE_REGIONS, REGIONS)


def places(staging: DataFrame, regions: DataFrame) -> DataFrame:
    """One row per complete address plus one for missing addresses (type 1: no history)."""
    known = staging.select(*PLACE).dropna(how="any").distinct()
    unknown = staging.sparkSession.range(1).select(*[F.lit(v.UNKNOWN_PLACE).alias(c) for c in PLACE])
    lookup = regions.select(F.col("country").alias("ship_country"), F.col("state").alias("ship_state"), "region")
    located = known.unionByName(unknown).join(lookup, ["ship_country", "ship_state"], "left")
    return conform(
        located.select(
            surrogate_key(*PLACE).alias("geography_key"),
            *PLACE,
            F.coalesce("region", F.lit(v.UNKNOWN_REGION)).alias("region"),
        ),
        DIM_GEOGRAPHY,
    )
