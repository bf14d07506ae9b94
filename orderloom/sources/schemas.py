"""Column contracts of every table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(10, 2)

# Header names of the raw extract, in file order.
RAW_COLUMNS = [
    "index",
    "Order ID",
    "Date",
    "Status",
    "Fulfilment",
    "Sales Channel",
    "ship-service-level",
    "Style",
    "SKU",
    "Category",
    "Size",
    "ASIN",
    "Courier Status",
    "Qty",
    "currency",
    "Amount",
    "ship-city",
    "ship-state",
    "ship-postal-code",
    "ship-country",
    "promotion-ids",
    "B2B",
    "fulfilled-by",
    "Unnamed: 22",
]


def _struct(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


TEXT, INT, DATE, FLAG = StringType(), IntegerType(), DateType(), BooleanType()

RAW = StructType([StructField(name, TEXT) for name in RAW_COLUMNS])

KEY_HASH = "key_hash"
KEY_HASHES = _struct(key_hash=LongType())

RAW_LINES = StructType([*RAW.fields, *KEY_HASHES.fields])

REGIONS = _struct(country=TEXT, state=TEXT, region=TEXT)

STAGING = _struct(
    order_id=TEXT,
    sku=TEXT,
    order_date=DATE,
    status_detail=TEXT,
    courier_status=TEXT,
    fulfilment=TEXT,
    sales_channel=TEXT,
    ship_service_level=TEXT,
    product_style=TEXT,
    product_category=TEXT,
    product_size=TEXT,
    asin=TEXT,
    quantity=INT,
    amount=MONEY,
    currency=TEXT,
    ship_city=TEXT,
    ship_city_raw=TEXT,
    ship_state=TEXT,
    ship_state_raw=TEXT,
    ship_postal_code=TEXT,
    ship_country=TEXT,
    promotion_ids_raw=TEXT,
    is_b2b=FLAG,
    is_cancelled=FLAG,
    revenue_amount=MONEY,
    promo_count=INT,
)

DIM_PRODUCT = _struct(
    product_key=TEXT, sku=TEXT, asin=TEXT, product_style=TEXT, product_category=TEXT, product_size=TEXT
)

DIM_DATE = _struct(
    date_key=INT,
    full_date=DATE,
    year=INT,
    quarter=INT,
    month=INT,
    month_name=TEXT,
    day_of_month=INT,
    day_of_week=INT,
    day_name=TEXT,
    is_weekend=FLAG,
    week_of_year=INT,
    season=TEXT,
)

DIM_GEOGRAPHY = _struct(
    geography_key=TEXT, ship_country=TEXT, ship_city=TEXT, ship_state=TEXT, ship_postal_code=TEXT, region=TEXT
)

DIM_ORDER_STATUS = _struct(status_key=TEXT, status_detail=TEXT, status_group=TEXT, is_terminal=FLAG)

FACT = _struct(
    sales_key=TEXT,
    date_key=INT,
    product_key=TEXT,
    geography_key=TEXT,
    status_key=TEXT,
    order_id=TEXT,
    sku=TEXT,
    fulfilment=TEXT,
    sales_channel=TEXT,
    ship_service_level=TEXT,
    currency=TEXT,
    ship_country=TEXT,
    quantity=INT,
    amount=MONEY,
    revenue_amount=MONEY,
    promo_count=INT,
    is_cancelled=FLAG,
    is_b2b=FLAG,
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Return ``df`` if its names and types are those of ``schema``, else raise."""
    found = [(f.name, f.dataType.simpleString()) for f in df.schema]
    wanted = [(f.name, f.dataType.simpleString()) for f in schema]
    if found != wanted:
        raise ValueError(f"unexpected schema:\n  found  {found}\n  wanted {wanted}")
    return df
