"""The warehouse as SQL common table expressions over the benchmark tables."""

from __future__ import annotations

from collections.abc import Sequence

from orderloom.plans import vocabulary as v
from orderloom.sources.order_lines import COUNTRY, CURRENCY, REGION_OF_STATE
from orderloom.sources.schemas import RAW_COLUMNS

NULL_PART = "_dbt_utils_surrogate_key_null_"


def quote(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    return "'" + str(value).replace("'", "''") + "'"


def in_list(values: Sequence[object]) -> str:
    return "(" + ", ".join(map(quote, values)) + ")"


def value_rows(rows: Sequence[Sequence[object]]) -> str:
    return ", ".join(in_list(row) for row in rows)


def key(*parts: str) -> str:
    joined = " || '-' || ".join(f"coalesce(cast({p} AS varchar), {quote(NULL_PART)})" for p in parts)
    return f"md5({joined})"


def total_order(columns: Sequence[str]) -> str:
    return ", ".join(f'"{c}" ASC NULLS LAST' for c in columns)


_STATUS_BY_CODE = " ".join(f"WHEN {i} THEN {quote(s.detail)}" for i, s in enumerate(v.STATUSES))

RAW = f"""
SELECT
    cast(l_linenumber * 1000000 + l_suppkey AS varchar) AS "index",
    cast(l_orderkey AS varchar) AS "Order ID",
    strftime(o_orderdate, '%m-%d-%y') AS "Date",
    CASE code {_STATUS_BY_CODE} END AS "Status",
    if(l_linestatus = 'F', 'House', 'Merchant') AS "Fulfilment",
    c_mktsegment AS "Sales Channel",
    if(o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%', 'Expedited', 'Standard') AS "ship-service-level",
    p_brand AS "Style",
    concat(' SKU-', l_partkey, ' ') AS "SKU",
    p_type AS "Category",
    cast(p_size AS varchar) AS "Size",
    p_name AS "ASIN",
    CASE
        WHEN code = 2 THEN 'Cancelled'
        WHEN l_linenumber = 7 THEN NULL
        WHEN code IN (5, 6) THEN if(l_orderkey % 500 = 0, 'Shipped', 'Unshipped')
        WHEN code = 0 AND l_orderkey % 500 = 1 THEN 'Unshipped'
        ELSE 'Shipped'
    END AS "Courier Status",
    if(code = 2 AND odd_line, '0', cast(l_quantity AS varchar)) AS "Qty",
    if(code = 2 AND NOT odd_line, NULL, '{CURRENCY}') AS "currency",
    if(code = 2 AND NOT odd_line, NULL, cast(cast(l_extendedprice AS decimal(18, 2)) AS varchar)) AS "Amount",
    CASE
        WHEN no_address THEN NULL
        WHEN o_custkey % 2 = 0 THEN concat(' ', lower(n_name), ' ')
        ELSE n_name
    END AS "ship-city",
    if(no_address, NULL, r_name) AS "ship-state",
    if(no_address, NULL, concat(c_nationkey, '.0')) AS "ship-postal-code",
    if(no_address, NULL, '{COUNTRY}') AS "ship-country",
    CASE l_linenumber % 3
        WHEN 1 THEN ''
        WHEN 2 THEN concat('PROMO0', repeat(',PROMO1', l_linenumber))
    END AS "promotion-ids",
    if(c_mktsegment = 'MACHINERY', 'True', ' FALSE ') AS "B2B",
    if(l_linestatus = 'O', 'Easy Ship', NULL) AS "fulfilled-by",
    if(odd_line, NULL, 'False') AS "Unnamed: 22"
FROM (
    SELECT
        *,
        l_linenumber % 2 = 1 AS odd_line,
        o_custkey % 100 = 0 AS no_address,
        (
            CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 6 ELSE 12 END
            + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 2 ELSE 4 END
            + if(l_linestatus = 'F', 0, 1)
        ) % 13 AS code
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    JOIN part ON p_partkey = l_partkey
)
"""

TYPED_COLUMNS = {
    "order_id": 'trim("Order ID")',
    "sku": 'trim("SKU")',
    "order_date": "cast(try_strptime(\"Date\", '%m-%d-%y') AS date)",
    "status_detail": 'trim("Status")',
    "courier_status": 'trim("Courier Status")',
    "fulfilment": 'trim("Fulfilment")',
    "sales_channel": 'trim("Sales Channel")',
    "ship_service_level": 'trim("ship-service-level")',
    "product_style": 'trim("Style")',
    "product_category": 'trim("Category")',
    "product_size": 'trim("Size")',
    "asin": 'trim("ASIN")',
    "quantity": 'try_cast("Qty" AS int)',
    "amount": 'try_cast("Amount" AS decimal(10, 2))',
    "currency": 'trim("currency")',
    "ship_city": 'upper(trim("ship-city"))',
    "ship_city_raw": 'trim("ship-city")',
    "ship_state": 'upper(trim("ship-state"))',
    "ship_state_raw": 'trim("ship-state")',
    "ship_postal_code": "split_part(trim(\"ship-postal-code\"), '.', 1)",
    "ship_country": 'trim("ship-country")',
    "promotion_ids_raw": "nullif(trim(\"promotion-ids\"), '')",
    "is_b2b": "lower(trim(\"B2B\")) = 'true'",
}

KEPT = """
SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (
        PARTITION BY trim("Order ID"), trim("SKU")
        ORDER BY if(try_cast("Amount" AS decimal(10, 2)) IS NULL, 1, 0),
            try_cast("index" AS int) DESC NULLS LAST, {}
    ) AS place
    FROM raw
)
WHERE place = 1
""".format(total_order(RAW_COLUMNS))

TYPED = "SELECT {} FROM kept".format(", ".join(f"{expr} AS {name}" for name, expr in TYPED_COLUMNS.items()))

STG = """
SELECT
    *,
    status_detail = 'Cancelled' AS is_cancelled,
    cast(if(status_detail = 'Cancelled', 0, amount) AS decimal(10, 2)) AS revenue_amount,
    cast(coalesce(len(string_split(promotion_ids_raw, ',')), 0) AS int) AS promo_count
FROM typed
"""

PRODUCTS = f"""
SELECT {key("sku")} AS product_key, sku, max(asin) AS asin, max(product_style) AS product_style,
    max(product_category) AS product_category, max(product_size) AS product_size
FROM stg GROUP BY sku
"""

REGIONS = "SELECT * FROM (VALUES {}) AS t(country, state, region)".format(
    value_rows([(COUNTRY, state, region) for state, region in REGION_OF_STATE.items()])
)

PLACES = f"""
SELECT {key("ship_country", "ship_city", "ship_state", "ship_postal_code")} AS geography_key,
    ship_country, ship_city, ship_state, ship_postal_code, coalesce(region, 'Unknown') AS region
FROM (
    SELECT ship_country, ship_city, ship_state, ship_postal_code FROM stg
    WHERE ship_country IS NOT NULL AND ship_city IS NOT NULL
      AND ship_state IS NOT NULL AND ship_postal_code IS NOT NULL
    GROUP BY ALL
    UNION ALL
    VALUES ('UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN')
)
LEFT JOIN regions ON ship_country = country AND ship_state = state
"""

STATUSES = f"""
SELECT {key("status_detail")} AS status_key, *
FROM (VALUES {value_rows(v.STATUSES)}) AS t(status_detail, status_group, is_terminal)
"""

DATES = """
SELECT
    cast(strftime(full_date, '%Y%m%d') AS int) AS date_key,
    full_date,
    cast(year(full_date) AS int) AS year,
    cast(quarter(full_date) AS int) AS quarter,
    cast(month(full_date) AS int) AS month,
    monthname(full_date) AS month_name,
    cast(day(full_date) AS int) AS day_of_month,
    cast(dayofweek(full_date) AS int) AS day_of_week,
    dayname(full_date) AS day_name,
    dayofweek(full_date) IN (0, 6) AS is_weekend,
    cast(weekofyear(full_date) AS int) AS week_of_year,
    CASE
        WHEN month(full_date) BETWEEN 3 AND 4 THEN 'Spring'
        WHEN month(full_date) BETWEEN 5 AND 6 THEN 'Summer'
        WHEN month(full_date) BETWEEN 7 AND 9 THEN 'Monsoon'
        WHEN month(full_date) BETWEEN 10 AND 11 THEN 'Autumn'
        ELSE 'Winter'
    END AS season
FROM (
    SELECT cast(unnest(generate_series(
        date_trunc('year', min(order_date)),
        date_trunc('year', max(order_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
        INTERVAL 1 DAY
    )) AS date) AS full_date
    FROM stg
)
"""

FACT = f"""
SELECT {key("order_id", "stg.sku")} AS sales_key, date_key, product_key, geography_key, status_key,
    order_id, stg.sku, fulfilment, sales_channel, ship_service_level, currency, stg.ship_country,
    quantity, amount, revenue_amount, promo_count, is_cancelled, is_b2b
FROM stg
JOIN dates ON full_date = order_date
JOIN products ON products.sku = stg.sku
JOIN statuses ON statuses.status_detail = stg.status_detail
JOIN places
    ON places.ship_country = coalesce(stg.ship_country, 'UNKNOWN')
   AND places.ship_city = coalesce(stg.ship_city, 'UNKNOWN')
   AND places.ship_state = coalesce(stg.ship_state, 'UNKNOWN')
   AND places.ship_postal_code = coalesce(stg.ship_postal_code, 'UNKNOWN')
"""

# Name, definition, names it reads. In build order.
MODELS = {
    "raw": (RAW, []),
    "kept": (KEPT, ["raw"]),
    "typed": (TYPED, ["kept"]),
    "stg": (STG, ["typed"]),
    "regions": (REGIONS, []),
    "products": (PRODUCTS, ["stg"]),
    "places": (PLACES, ["stg", "regions"]),
    "statuses": (STATUSES, []),
    "dates": (DATES, ["stg"]),
    "fact": (FACT, ["stg", "dates", "products", "places", "statuses"]),
}


def statement(body: str, *models: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the models it reads and, after them, its own ``extra`` ones."""
    needed: set[str] = set()

    def need(name: str) -> None:
        needed.add(name)
        for parent in MODELS[name][1]:
            need(parent)

    for name in models:
        need(name)
    ctes = [f"{name} AS MATERIALIZED ({MODELS[name][0]})" for name in MODELS if name in needed]
    ctes += [f"{name} AS MATERIALIZED ({text})" for name, text in (extra or {}).items()]
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
