"""The order-line fact."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.keys import surrogate_key
from orderloom.functions.text import or_default
from orderloom.operators.joins import BROADCAST_ROWS
from orderloom.plans.dimensions import PLACE
from orderloom.plans.vocabulary import UNKNOWN_PLACE
from orderloom.sources.schemas import FACT, conform


# Days of a calendar that is sent to every executor at most: a century.
MOST_DAYS = 36_525


class Star(NamedTuple):
    """The fact with its dimensions; ``by_place`` says that the fact is stored in the order of its places."""

    fact: DataFrame
    dates: DataFrame
    products: DataFrame
    places: DataFrame
    statuses: DataFrame
    by_place: bool = False


#: The order of a fact that is stored by place: the last keys split a place and day that holds many lines.
PLACE_ORDER = ("geography_key", "date_key", "order_id", "sku")


_DIGESTS = ("sales_key", "product_key", "geography_key", "status_key")


def packed(rows: DataFrame) -> DataFrame:
    """Fact rows whose keys are bytes, which are half as long and have the same order, to be shuffled."""
    return rows.withColumns({c: F.unhex(c) for c in _DIGESTS})


def unpacked(rows: DataFrame) -> DataFrame:
    """Fact rows with their keys as text again; those that order and sku tell are made of these, so that Spark needn't move them."""
    told = {"sales_key": surrogate_key("order_id", "sku"), "product_key": surrogate_key("sku")}
    return rows.withColumns({c: told.get(c, F.lower(F.hex(c))) for c in _DIGESTS})


def _dated(staging: DataFrame, dates: DataFrame, statuses: DataFrame) -> DataFrame:
    """Lines with their date and status key.

    The statuses are 13 and a calendar of a century has 36,525 days, so both are
    broadcast; a longer calendar is left to Spark.
    """
    days = dates.select(F.col("full_date").alias("order_date"), "date_key")
    fits = days.limit(MOST_DAYS + 1).count() <= MOST_DAYS
    dated = staging.join(F.broadcast(days) if fits else days, "order_date")
    return dated.join(F.broadcast(statuses.select("status_detail", "status_key")), "status_detail")


def _fact(lines: DataFrame) -> DataFrame:
    keyed = lines.withColumn("sales_key", surrogate_key("order_id", "sku"))
    return conform(keyed.select(*FACT.names), FACT)


def fact_by_lookup(
    staging: DataFrame, dates: DataFrame, products: DataFrame, places: DataFrame, statuses: DataFrame
) -> DataFrame:
    """Fact with every key looked up; a line that misses any dimension is dropped.

    A missing address field is matched as UNKNOWN, each field on its own: a line
    that lacks only its city finds no place and is lost, which the row-count
    check reports.
    """
    found = _dated(staging, dates, statuses).withColumns(
        {f"at_{c}": or_default(c, UNKNOWN_PLACE) for c in PLACE}
    )
    keys = places.select("geography_key", *[F.col(c).alias(f"at_{c}") for c in PLACE])
    # places are far fewer than products: once their key is known the address needn't move
    placed = found.join(keys, [f"at_{c}" for c in PLACE])
    placed = placed.withColumns({c: F.unhex(c) for c in ("geography_key", "status_key")})
    keyed = placed.join(products.select("sku", "product_key"), "sku")
    return _fact(keyed.withColumns({c: F.lower(F.hex(c)) for c in ("geography_key", "status_key")}))


def _absent() -> Column:
    """Address fields that a line lacks."""
    return sum((F.col(c).isNull().cast("int") for c in PLACE), F.lit(0))


def _keyed(staging: DataFrame, dates: DataFrame, statuses: DataFrame) -> DataFrame:
    """Lines with every key, product and place keys derived from the line itself."""
    return _dated(staging.where(F.col("sku").isNotNull()), dates, statuses).withColumns(
        {
            "product_key": surrogate_key("sku"),
            "geography_key": surrogate_key(*[or_default(c, UNKNOWN_PLACE) for c in PLACE]),
        }
    )


def named_unknown(places: DataFrame) -> DataFrame:
    """Keys of the places with a field that reads UNKNOWN: the stand-in, and any that the data holds."""
    literal = F.lit(False)
    for c in PLACE:
        literal = literal | (F.col(c) == UNKNOWN_PLACE)
    return places.where(literal).select("geography_key")


def fact_by_key(staging: DataFrame, dates: DataFrame, places: DataFrame, statuses: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The same fact without shuffling it to the two dimensions that grow with the data.

    Product and place keys are functions of their natural keys, and both
    dimensions hold exactly the values found in ``staging``. So a line with a
    complete address, or with none, has its place. Only a line that lacks a part
    of it must be looked up, and its missing fields are read as UNKNOWN, so it can
    match no place but one that holds that word: a few, broadcast after a count.
    """
    lines = _keyed(staging, dates, statuses)
    whole = _absent().isin(0, len(PLACE))
    named = named_unknown(places)
    if named.limit(broadcast_rows + 1).count() > broadcast_rows:
        return _fact(lines.where(whole)).unionByName(_fact(lines.where(~whole).join(named, "geography_key")))
    partly = F.when(~whole, F.col("geography_key"))
    probed = lines.join(F.broadcast(named.withColumnRenamed("geography_key", "_named")), partly == F.col("_named"), "left")
    return _fact(probed.where(whole | F.col("_named").isNotNull()))
