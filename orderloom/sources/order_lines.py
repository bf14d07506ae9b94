"""Raw order lines from the benchmark tables.

No sales extract comes with the benchmark, so its line items, orders, customers
and parts are rendered as one: text columns only, with untrimmed values, blanks,
missing addresses, duplicate (order, sku) pairs and status conflicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import text as texts
from orderloom.operators.dedup import KEY_HASH, key_hash
from orderloom.plans.vocabulary import CANCELLED, STATUSES
from orderloom.sources.constants import literal_rows
from orderloom.sources.schemas import RAW, RAW_LINES, REGIONS, conform

#: A source below this size may be one row group, which one task reads; of a larger one a bucket of lines takes about the second size.
SPREAD_BYTES, BUCKET_BYTES = 64 << 20, 6 << 20

# Fixed values of the benchmark mapping.
COUNTRY = "XX"
CURRENCY = "XXX"
FULFILMENT = {"F": "House", "O": "Merchant"}
# MIDDLE EAST is left out on purpose, so that some lines have no known region.
REGION_OF_STATE = {"AFRICA": "South", "AMERICA": "West", "ASIA": "East", "EUROPE": "North"}


def benchmark_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _source_bytes(spark: SparkSession, folder: str) -> int:
    listed = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/lineitem.parquet").agg(F.sum("length").alias("bytes")).first()
    return listed["bytes"] or 0


def is_large(spark: SparkSession, folder: str) -> bool:
    """Whether the line items are so many that they come in several row groups, and their shuffles take room."""
    return _source_bytes(spark, folder) >= SPREAD_BYTES


def line_buckets(spark: SparkSession, folder: str) -> int:
    """Buckets of the lines in ``folder``: as many as Spark shuffles into, or more, so that a bucket doesn't grow with the source."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-_source_bytes(spark, folder) // BUCKET_BYTES))


def benchmark_regions(spark: SparkSession) -> DataFrame:
    rows = [(COUNTRY, state, region) for state, region in REGION_OF_STATE.items()]
    return literal_rows(spark, rows, REGIONS)


def _rank(c: str, first: str, second: str) -> Column:
    return F.when(F.col(c) == first, 0).when(F.col(c) == second, 1).otherwise(2)


#: The lines' traits, one number in place of as many columns: the status code and these bits.
_CODE, _ADDRESSED, _LOWER, _EXPEDITED, _STATES = 15, 16, 32, 64, {state: 128 << i for i, state in enumerate(FULFILMENT)}


def _bit(found: Column, bit: int) -> Column:
    """The bit if the condition holds; an unknown one doesn't."""
    return F.when(found, bit).otherwise(0)


def _has(bit: int) -> Column:
    return F.col("traits").bitwiseAND(bit) != 0


def _status_code() -> Column:
    line = F.when(F.col("l_traits").bitwiseAND(_STATES["F"]) != 0, 0).otherwise(1)
    return (6 * F.col("o_rank") + 2 * F.col("l_traits").bitwiseAND(3) + line) % len(STATUSES)


def _priced(code: Column) -> Column:
    return ~((code == 2) & (F.col("l_linenumber") % 2 == 0))


def _courier_status() -> Column:
    code, order = F.col("code"), F.col("l_orderkey")
    pending = F.when(order % 500 == 0, "Shipped").otherwise("Unshipped")
    return (
        F.when(code == 2, CANCELLED)
        .when(F.col("l_linenumber") == 7, F.lit(None))
        .when(code.isin(5, 6), pending)
        .when((code == 0) & (order % 500 == 1), "Unshipped")
        .otherwise("Shipped")
    )


def _order_id() -> Column:
    return F.col("l_orderkey").cast("string")


def _sku() -> Column:
    return F.concat(F.lit(" SKU-"), F.col("l_partkey").cast("string"), F.lit(" "))


def joined_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item: the numbers and names that its text is made of, and the hash of its (order, sku).

    These take a third of the text's room, so lines move as such, and are rendered where they arrive. What the text
    needs of several columns is one number, and a price is a decimal, which compresses better.
    """
    load = lambda name, *cols: benchmark_table(spark, folder, name).select(*cols)
    # Orders meet their customers first: the line items, several per order, then
    # move for two joins and not for three.
    expedited = F.substring("o_orderpriority", 1, 1).isin("1", "2")
    orders = load(
        "orders",
        "o_orderkey",
        "o_custkey",
        _rank("o_orderstatus", "F", "O").alias("o_rank"),
        F.col("o_orderdate").cast("date").alias("ordered"),
        _bit(expedited, _EXPEDITED).alias("o_traits"),
    ).join(load("customer", "c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    customer = _bit(F.col("o_custkey") % 100 != 0, _ADDRESSED) + _bit(F.col("o_custkey") % 2 == 0, _LOWER)
    orders = orders.select("o_orderkey", "o_rank", (F.col("o_traits") + customer).alias("o_traits"), "ordered", "c_nationkey", "c_mktsegment")
    parts = load("part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    states = [_bit(F.col("l_linestatus") == state, bit) for state, bit in _STATES.items()]
    items = load(
        "lineitem",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        sum(states, _rank("l_returnflag", "A", "N")).alias("l_traits"),
    )
    if not is_large(spark, folder):
        items = items.repartition(spark.sparkContext.defaultParallelism)
    code = _status_code()
    state = F.col("l_traits").bitwiseAND(sum(_STATES.values()))
    ordered = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        F.when(_priced(code), F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
        (code + state + F.col("o_traits")).alias("traits"),
        "ordered",
        "c_nationkey",
        "c_mktsegment",
    )
    lines = ordered.join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    return lines.withColumn(KEY_HASH, key_hash([texts.clean(_order_id()), texts.clean(_sku())]))


def rendered_lines(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    """The 24 text columns of joined lines, and the hash of their (order, sku).

    The 25 nations are joined here: they need no shuffle, and their names needn't move.
    """
    load = lambda name, *cols: benchmark_table(spark, folder, name).select(*cols)
    # each by itself, as Spark takes the size of a join for the product of its sides
    placed = lines.join(load("nation", "n_nationkey", "n_name", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    placed = placed.join(load("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))

    placed = placed.withColumn("code", F.col("traits").bitwiseAND(_CODE))
    number = F.col("l_linenumber")
    cancelled = F.col("code") == 2
    priced = _priced(F.col("code"))
    addressed = _has(_ADDRESSED)
    text = lambda c: F.col(c).cast("string")
    padded = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    fulfilment = F.coalesce(*[F.when(_has(_STATES[state]), name) for state, name in FULFILMENT.items()])
    city = F.when(_has(_LOWER), padded(F.lower("n_name"))).otherwise(F.col("n_name"))
    promotions = F.concat(F.lit("PROMO0"), F.repeat(F.lit(",PROMO1"), number))

    columns = {
        "index": (number * 1000000 + F.col("l_suppkey")).cast("string"),
        "Order ID": _order_id(),
        "Date": F.date_format("ordered", "MM-dd-yy"),
        "Status": F.element_at(F.array(*[F.lit(s.detail) for s in STATUSES]), F.col("code") + 1),
        "Fulfilment": fulfilment,
        "Sales Channel": F.col("c_mktsegment"),
        "ship-service-level": F.when(_has(_EXPEDITED), "Expedited").otherwise("Standard"),
        "Style": F.col("p_brand"),
        "SKU": _sku(),
        "Category": F.col("p_type"),
        "Size": text("p_size"),
        "ASIN": F.col("p_name"),
        "Courier Status": _courier_status(),
        "Qty": F.when(cancelled & (number % 2 == 1), "0").otherwise(text("l_quantity")),
        "currency": F.when(priced, CURRENCY),
        "Amount": text("price"),
        "ship-city": F.when(addressed, city),
        "ship-state": F.when(addressed, F.col("r_name")),
        "ship-postal-code": F.when(addressed, F.concat(text("c_nationkey"), F.lit(".0"))),
        "ship-country": F.when(addressed, COUNTRY),
        "promotion-ids": F.when(number % 3 == 1, "").when(number % 3 == 2, promotions),
        "B2B": F.when(F.col("c_mktsegment") == "MACHINERY", "True").otherwise(" FALSE "),
        "fulfilled-by": F.when(_has(_STATES["O"]), "Easy Ship"),
        "Unnamed: 22": F.when(number % 2 == 0, "False"),
    }
    return conform(placed.select(*[c.alias(name) for name, c in columns.items()], KEY_HASH), RAW_LINES)


def raw_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The 24 text columns, one row per line item."""
    return conform(rendered_lines(spark, folder, joined_order_lines(spark, folder)).drop(KEY_HASH), RAW)


def clustered_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the hash of their (order, sku), and dealt by it; they move before they are text."""
    joined = joined_order_lines(spark, folder)
    return rendered_lines(spark, folder, joined.repartition(line_buckets(spark, folder), F.col(KEY_HASH)))
