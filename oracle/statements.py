"""One SQL statement per registered query."""

from __future__ import annotations

from oracle.models import DATES, in_list, key, quote, statement
from orderloom.plans import quality
from orderloom.plans import vocabulary as v
from orderloom.plans.catalog import CITY, FULFILMENTS
from orderloom.plans.profile import BUSINESS_COLUMNS, CATEGORICAL
from orderloom.sources.order_lines import COUNTRY, REGION_OF_STATE
from orderloom.sources.schemas import RAW_COLUMNS, STAGING

LINE = '"Order ID" AS order_id, "index" AS line_index'
LINE_NUMBER = 'cast("index" AS bigint) // 1000000'


def ident(name: str) -> str:
    return '"' + name + '"'


def blank(name: str) -> str:
    return f"coalesce(trim({ident(name)}), '') = ''"


def choose(number: str, *choices: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(choices))
    return f"CASE ({number}) % {len(choices)} {cases} END"


def sources_and_sinks() -> dict[str, str]:
    raw_csv = ", ".join(
        "concat('\"', \"ASIN\", '\", boxed') AS \"ASIN\"" if c == "ASIN" else f"nullif({ident(c)}, '') AS {ident(c)}"
        for c in RAW_COLUMNS
    )
    broken = "concat(\"ASIN\", chr(10), '\"boxed\",', chr(10), \"Order ID\") AS \"ASIN\""
    broken_csv = ", ".join(broken if c == "ASIN" else f"nullif({ident(c)}, '') AS {ident(c)}" for c in RAW_COLUMNS)
    return {
        "src_csv_raw": statement(f"SELECT {raw_csv} FROM raw", "raw"),
        "src_csv_line_breaks": statement(f"SELECT {broken_csv} FROM raw", "raw"),
        "src_csv_malformed": statement(
            f"SELECT \"index\" AS line_index, CASE WHEN NOT bad THEN \"Order ID\" END AS order_id, "
            f"CASE WHEN bad THEN NULL WHEN {LINE_NUMBER} = 2 THEN concat(\"ASIN\", chr(10), '\"boxed\"') "
            f"ELSE \"ASIN\" END AS asin, bad AS diverted FROM (SELECT *, {LINE_NUMBER} IN (3, 4) AS bad FROM raw)",
            "raw",
        ),
        "sink_overwrite_roundtrip": statement(
            "SELECT order_id, sku, order_date, quantity, amount, is_b2b FROM stg", "stg"
        ),
        "load_audit_count": statement(
            "SELECT 'order_lines' AS table_name, (SELECT count(*) FROM lineitem) AS observed_rows, "
            "count(*) AS stored_rows FROM raw",
            "raw",
        ),
        "seed_region_lookup": statement(
            "SELECT ship_country AS country, ship_state AS state, count(*) AS order_lines, any_value(region) AS region "
            "FROM stg LEFT JOIN regions ON ship_country = country AND ship_state = state GROUP BY ALL",
            "stg",
            "regions",
        ),
        "mart_materialize_roundtrip": statement(
            "SELECT date_key // 100 AS sale_month, count(*) AS order_lines, "
            "cast(sum(revenue_amount) AS decimal(38, 2)) AS total_revenue FROM fact GROUP BY 1",
            "fact",
        ),
        "namespace_sql": statement(
            "SELECT region, status_group, cast(sum(quantity) AS bigint) AS units FROM fact "
            "JOIN places USING (geography_key) JOIN statuses USING (status_key) GROUP BY ALL",
            "fact",
        ),
    }


def scalars() -> dict[str, str]:
    digits = "split_part(\"Qty\", '.', 1)"
    amount = "coalesce(\"Amount\", '')"
    number = choose(
        LINE_NUMBER,
        '"Qty"',
        amount,
        f"' ' || {digits} || '.5 '",
        f"{amount} || 'd'",
        f"{digits} || 'e2'",
        f"'-' || {digits} || '.5'",
        f"{digits} || '12345678.125'",
    )
    month, day, year = (f"split_part(\"Date\", '-', {i})" for i in (1, 2, 3))

    def bare(part: str) -> str:
        return f"cast(cast({part} AS int) AS varchar)"

    date = choose(
        LINE_NUMBER,
        "' ' || \"Date\" || chr(9)",
        f"{bare(month)} || '-' || {bare(day)} || '-' || {year}",
        f"{day} || '-' || {month} || '-' || {year}",
        f"'0' || {month} || '-' || {day} || '-' || {year}",
        f"{month} || '-' || {day} || '-20' || {year}",
        f"{month} || '-' || {day} || '-' || {bare(year)}",
        f"{month} || '-' || {day} || '-' || lpad(cast(cast(\"Order ID\" AS bigint) % 100 AS varchar), 2, '0')",
    )
    return {
        "scalar_text_clean": statement(
            f"""SELECT {LINE}, trim("SKU") AS sku, trim("ship-city") AS city, upper(trim("ship-city")) AS city_upper,
            upper(trim(chr(160) || ' ' || "ship-city" || chr(12288))) AS wide_spaces,
            trim(chr(9) || "ship-city") AS tab_kept,
            "promotion-ids" IS NULL OR trim("promotion-ids") = '' AS no_promotion FROM raw""",
            "raw",
        ),
        "scalar_bool_flag": statement(
            f"""SELECT {LINE}, lower(trim("B2B")) = 'true' AS is_b2b,
            if("Courier Status" IS NULL, NULL, lower(trim("B2B")) = 'true') AS some_missing FROM raw""",
            "raw",
        ),
        "scalar_postal_clean": statement(
            f"""SELECT {LINE}, split_part(trim("ship-postal-code"), '.', 1) AS postal_code,
            split_part(trim("Amount"), '.', 1) AS whole_amount FROM raw""",
            "raw",
        ),
        "scalar_nullif_coalesce": statement(
            f"""SELECT {LINE}, nullif(trim("promotion-ids"), '') AS promotions,
            coalesce(nullif(trim("promotion-ids"), ''), '<NULL>') AS promotions_label,
            coalesce("ship-city", 'UNKNOWN') AS city_or_unknown FROM raw""",
            "raw",
        ),
        "scalar_try_cast": statement(
            "SELECT order_id, line_index, given, try_cast(given AS int) AS as_int, "
            "try_cast(given AS decimal(10, 2)) AS as_money, try_cast(given AS double) AS as_double FROM messy",
            "raw",
            extra={"messy": f"SELECT {LINE}, {number} AS given FROM raw"},
        ),
        "scalar_try_date": statement(
            "SELECT order_id, line_index, coalesce(given, '') AS given, "
            "cast(try_strptime(given, '%m-%d-%y') AS date) AS as_date FROM messy",
            "raw",
            extra={"messy": f"SELECT {LINE}, {date} AS given FROM raw"},
        ),
        "derived_measures": statement(
            "SELECT order_id, sku, status_detail, amount, is_cancelled, revenue_amount, promo_count FROM stg", "stg"
        ),
        "surrogate_key": statement(
            f"SELECT order_id, sku, {key('order_id', 'sku')} AS sales_key, {key('sku')} AS product_key, "
            f"{key('ship_country', 'ship_city', 'ship_state', 'ship_postal_code')} AS place_key FROM stg",
            "stg",
        ),
    }


def model_tables() -> dict[str, str]:
    fact = statement("SELECT * FROM fact", "fact")
    stg = statement(f"SELECT {', '.join(STAGING.names)} FROM stg", "stg")
    span = "SELECT cast(unnest(generate_series(DATE '1995-01-01', DATE '1997-06-30', INTERVAL 1 DAY)) AS date) AS full_date"
    days = f"{DATES[: DATES.index('FROM (')]} FROM ({span})"
    return {
        "dedup_latest_complete": statement(
            'SELECT trim("Order ID") AS order_id, trim("SKU") AS sku, cast("index" AS int) AS source_position, '
            '"Status" AS status_detail, try_cast("Qty" AS int) AS quantity, '
            'try_cast("Amount" AS decimal(10, 2)) AS amount FROM kept',
            "kept",
        ),
        "stg_orders": stg,
        "stg_orders_many_repeats": stg,
        "stg_orders_from_source": stg,
        "dim_product": statement("SELECT * FROM products", "products"),
        "dim_date": statement("SELECT * FROM dates", "dates"),
        "dim_date_span": statement(
            f"SELECT days.*, (SELECT count(*) FROM stg WHERE order_date = full_date) AS order_lines FROM ({days}) AS days", "stg"
        ),
        "dim_geography": statement("SELECT * FROM places", "places"),
        "dim_order_status": statement(
            "SELECT statuses.*, (SELECT count(*) FROM stg WHERE stg.status_detail = statuses.status_detail) "
            "AS order_lines FROM statuses",
            "stg",
            "statuses",
        ),
        "fct_sales": fact,
        "fct_sales_derived_keys": fact,
    }


def report_tables() -> dict[str, str]:
    sold = (
        "fact JOIN products USING (product_key) JOIN places USING (geography_key) JOIN statuses USING (status_key) "
        f"WHERE places.ship_city = {quote(CITY)} AND status_group IN {in_list(v.SOLD_GROUPS)}"
    )
    here = f"fact.ship_country = {quote(COUNTRY)}"
    by_style = statement(
        "SELECT product_style, cast(sum(quantity) AS bigint) AS units, "
        f"cast(round(sum(revenue_amount), 2) AS decimal(38, 2)) AS revenue_inr FROM {sold} "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
        "fact",
    )
    return {
        "rpt_city_style_topn": statement(
            f"SELECT product_style, cast(sum(quantity) AS bigint) AS units FROM {sold} AND {here} "
            "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
            "fact",
        ),
        "rpt_city_category_units": statement(
            f"SELECT product_category, cast(sum(quantity) AS bigint) AS units FROM {sold} AND {here} GROUP BY 1",
            "fact",
        ),
        "rpt_city_style_revenue": by_style,
        "rpt_city_style_revenue_by_place": by_style,
        "mart_reopen_report": by_style,
        "rpt_season_revenue": statement(
            "SELECT season, days_in_data, orders, total_revenue, per_day AS avg_daily_revenue, "
            "cast(total_revenue AS double) / 1e6 AS total_revenue_millions, per_day / 1e6 AS avg_daily_revenue_millions "
            "FROM (SELECT season, count(DISTINCT full_date) AS days_in_data, count(*) AS orders, "
            "cast(sum(revenue_amount) AS decimal(38, 2)) AS total_revenue, "
            "cast(sum(revenue_amount) AS double) / count(DISTINCT full_date) AS per_day "
            f"FROM fact JOIN dates USING (date_key) WHERE {here} GROUP BY season)",
            "fact",
        ),
        "rpt_cancel_rate_region": statement(
            "SELECT region, count(*) AS line_items, 100 * avg(if(is_cancelled, 1, 0)) AS cancellation_rate "
            f"FROM fact JOIN places USING (geography_key) WHERE region <> 'Unknown' AND {here} GROUP BY region",
            "fact",
        ),
    }


def _overview(rows: str) -> str:
    named = {
        "unique_orders": "Order ID",
        "skus": "SKU",
        "styles": "Style",
        "categories": "Category",
        "sizes": "Size",
        "ship_cities": "ship-city",
        "distinct_dates": "Date",
    }
    distinct = ", ".join(f"count(DISTINCT {ident(c)}) AS {name}" for name, c in named.items())
    date = "cast(try_strptime(\"Date\", '%m-%d-%y') AS date)"
    return f"SELECT count(*) AS records, {distinct}, min({date}) AS date_min, max({date}) AS date_max FROM {rows}"


def _style_fanout(rows: str) -> str:
    return f"""SELECT count(*) FILTER (n > 1) AS styles_with_multiple_skus, max(n) AS max_skus_per_style
    FROM (SELECT count(DISTINCT "SKU") AS n FROM {rows} WHERE NOT ({blank("Style")}) GROUP BY "Style")"""


def _duplicate_pairs(rows: str) -> str:
    return f"""SELECT count(*) AS duplicate_groups,
    cast(coalesce(sum(n) - count(*), 0) AS bigint) AS extra_rows_in_dupe_groups
    FROM (SELECT count(*) AS n FROM {rows} GROUP BY "Order ID", "SKU") WHERE n > 1"""


def _exact_duplicates(rows: str) -> str:
    columns = ", ".join(map(ident, BUSINESS_COLUMNS))
    return f"""SELECT (SELECT count(*) FROM {rows}) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {rows}))
    AS business_level_exact_duplicates"""


def _quality_counters(rows: str) -> str:
    address = " OR ".join(blank(c) for c in ("ship-city", "ship-state", "ship-postal-code", "ship-country"))
    return f"""SELECT count(*) FILTER ({blank("Amount")}) AS missing_amount,
    count(*) FILTER (try_cast("Qty" AS int) = 0) AS qty_zero,
    count(*) FILTER (try_cast("Qty" AS int) < 0) AS qty_negative,
    count(*) FILTER (try_cast("Amount" AS double) < 0) AS amount_negative,
    count(*) FILTER (NOT ({blank("Date")}) AND try_strptime("Date", '%m-%d-%y') IS NULL) AS invalid_dates,
    count(*) FILTER ({address}) AS missing_shipping_info FROM {rows}"""


def _sku_drift(rows: str) -> str:
    def distinct(c: str) -> str:
        return f"count(DISTINCT nullif(trim({ident(c)}), ''))"

    return f"""SELECT count(*) FILTER (styles > 1) AS sku_style_drift, count(*) FILTER (categories > 1) AS sku_category_drift,
    count(*) FILTER (sizes > 1) AS sku_size_drift FROM (
        SELECT {distinct("Style")} AS styles, {distinct("Category")} AS categories, {distinct("Size")} AS sizes
        FROM {rows} WHERE NOT ({blank("SKU")}) GROUP BY "SKU")"""


def _co_missing(rows: str) -> str:
    return f"""SELECT count(*) FILTER (a AND c) AS both_null, count(*) FILTER (a AND NOT c) AS only_amount_null,
    count(*) FILTER (c AND NOT a) AS only_currency_null
    FROM (SELECT {blank("Amount")} AS a, {blank("currency")} AS c FROM {rows})"""


def _missing_by_column(rows: str) -> str:
    def share(c: str) -> str:
        return (
            f"SELECT {quote(c)} AS column_name, count(*) FILTER ({blank(c)}) AS missing, "
            f"round(100.0::double * count(*) FILTER ({blank(c)}) / count(*), 2) AS pct_missing FROM {rows}"
        )

    return " UNION ALL ".join(map(share, RAW_COLUMNS))


DIRTY = f"""
SELECT * REPLACE (
    CASE line WHEN 1 THEN '13-45-99' WHEN 2 THEN ' ' ELSE "Date" END AS "Date",
    if(line = 3, '-' || "Qty", "Qty") AS "Qty",
    if(line = 4, '-' || "Amount", "Amount") AS "Amount",
    if(line = 5, chr(160), "currency") AS "currency",
    CASE line WHEN 6 THEN '' WHEN 7 THEN 'Brand#0' ELSE "Style" END AS "Style",
    if(line = 7, "Category" || ' ', "Category") AS "Category",
    if(line = 1, '  ', "ship-city") AS "ship-city"
)
FROM (
    SELECT *, {LINE_NUMBER} AS line FROM raw
    UNION ALL
    SELECT *, {LINE_NUMBER} AS line FROM raw WHERE "Status" LIKE 'Pending%'
)
"""


def profiles() -> dict[str, str]:
    cancelled, shipped = "trim(\"Status\") = 'Cancelled'", "trim(\"Status\") LIKE 'Shipped%'"
    zero, no_amount = 'try_cast("Qty" AS int) = 0', blank("Amount")
    items = "len(string_split(\"promotion-ids\", ','))"
    distributions, of_many = (
        " UNION ALL ".join(
            f"(SELECT {quote(c)} AS column_name, coalesce({ident(c)}, '<NULL>') AS value, count(*) AS count "
            "FROM raw GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 15)"
            for c in columns
        )
        for columns in (CATEGORICAL, [*CATEGORICAL, "Order ID", "ASIN"])
    )
    cardinalities = ", ".join(
        f"count(DISTINCT {ident(c)}) AS {c.lower().replace(' ', '_').replace('-', '_')}_distinct" for c in CATEGORICAL
    )
    on_both = {
        "prof_overview": _overview,
        "prof_style_fanout": _style_fanout,
        "prof_duplicate_pairs": _duplicate_pairs,
        "prof_exact_duplicates": _exact_duplicates,
        "prof_quality_counters": _quality_counters,
        "prof_sku_drift": _sku_drift,
        "prof_co_missing": _co_missing,
        "prof_missing_by_column": _missing_by_column,
    }
    found = {name: statement(build("raw"), "raw") for name, build in on_both.items()}
    for name, build in on_both.items():
        found[f"{name}_dirty"] = statement(build("dirty"), "raw", extra={"dirty": DIRTY})
    found["prof_exact_duplicates_clustered"] = found["prof_exact_duplicates"]
    bodies = {
        "prof_order_fanout": """SELECT count(*) FILTER (n > 1) AS orders_with_multiple_rows, max(n) AS max_rows_per_order
            FROM (SELECT count(*) AS n FROM raw GROUP BY "Order ID")""",
        "prof_crosstab": """SELECT "Fulfilment", coalesce(nullif(trim("fulfilled-by"), ''), '<NULL>') AS fulfilled_by,
            count(*) AS row_count FROM raw GROUP BY ALL""",
        "prof_status_courier": """SELECT "Status", "Courier Status" AS courier_status, count(*) AS row_count FROM raw
            WHERE ("Status", "Courier Status") IN (('Shipped', 'Unshipped'), ('Shipped', 'Cancelled'))
               OR (starts_with("Status", 'Pending') AND "Courier Status" = 'Shipped') GROUP BY ALL""",
        "prof_casing_collapse": """SELECT count(DISTINCT "ship-city") AS city_raw,
            count(DISTINCT upper(trim("ship-city"))) AS city_normalized, count(DISTINCT "ship-state") AS state_raw,
            count(DISTINCT upper(trim("ship-state"))) AS state_normalized,
            count(DISTINCT "ship-country") AS distinct_countries FROM raw""",
        "prof_anomaly_by_status": f"""SELECT count(*) FILTER ({zero}) AS qty_zero_total,
            count(*) FILTER ({zero} AND {cancelled}) AS qty_zero_cancelled, count(*) FILTER ({zero} AND {shipped}) AS qty_zero_shipped,
            count(*) FILTER ({no_amount}) AS amount_missing_total,
            count(*) FILTER (({no_amount}) AND {cancelled}) AS amount_missing_cancelled,
            count(*) FILTER (({no_amount}) AND {shipped}) AS amount_missing_shipped FROM raw""",
        "prof_cancelled_with_amount": """SELECT count(*) FILTER ("Status" = 'Cancelled' AND try_cast("Amount" AS double) > 0)
            AS cancelled_orders_with_amount_gt_zero FROM raw""",
        "prof_promo_shape": f"""SELECT count(*) FILTER (NOT ({blank("promotion-ids")})) AS rows_with_promo,
            max(length("promotion-ids")) AS max_raw_length, max({items}) AS max_promo_count_per_row,
            avg({items}) FILTER (NOT ({blank("promotion-ids")})) AS avg_promo_count_when_present FROM raw""",
        "prof_non_empty": f"""SELECT count(*) FILTER (NOT ({blank("Unnamed: 22")})) AS unnamed_22_non_empty FROM raw""",
        "prof_value_distribution": distributions,
        "prof_value_distribution_sketched": of_many,
        "prof_distinct_counts": f"SELECT {cardinalities} FROM raw",
    }
    wide = {
        "quality_counters": _quality_counters("raw"),
        "co_missing": _co_missing("raw"),
        "anomalies_by_status": bodies["prof_anomaly_by_status"],
        "cancelled_with_amount": bodies["prof_cancelled_with_amount"],
        "promotion_shape": bodies["prof_promo_shape"],
        "filled_rows": bodies["prof_non_empty"],
    }
    parts = [
        f"SELECT {quote(name)} AS profile, measure, value FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS double) FROM ({body})) "
        "ON COLUMNS(*) INTO NAME measure VALUE value)"
        for name, body in wide.items()
    ]
    for profile, value in (("missing", "missing"), ("pct_missing", "pct_missing")):
        parts.append(f"SELECT '{profile}' AS profile, column_name AS measure, CAST({value} AS double) AS value FROM ({_missing_by_column('raw')})")
    bodies["prof_bundle"] = " UNION ALL ".join(parts)
    return found | {name: statement(body, "raw") for name, body in bodies.items()}


# Where the check statements find each stored table.
TABLES = {
    "raw": "raw",
    "stg_orders": "stg",
    "fct_sales": "fact",
    "dim_date": "dates",
    "dim_product": "products",
    "dim_geography": "places",
    "dim_order_status": "statuses",
}


def _found(name: str, failures: str, rows: str, warn: int = 0, error: int = 0) -> str:
    """SELECT of (check_name, failures, status) where ``failures`` is an aggregate over ``rows``."""
    return (
        f"SELECT {quote(name)} AS check_name, failures, CASE WHEN failures > {error} THEN 'ERROR' "
        f"WHEN failures > {warn} THEN 'WARN' ELSE 'PASS' END AS status "
        f"FROM (SELECT cast(coalesce({failures}, 0) AS bigint) AS failures FROM {rows})"
    )


def _nulls(table: str, column: str) -> str:
    return _found(f"not_null.{table}.{column}", f"count(*) - count({ident(column)})", TABLES[table])


def _repeats(name: str, table: str, columns: list[str]) -> str:
    listed = ", ".join(map(ident, columns))
    present = f"WHERE {ident(columns[0])} IS NOT NULL" if len(columns) == 1 else ""
    return _found(name, "count(*) FILTER (n > 1)", f"(SELECT count(*) AS n FROM {TABLES[table]} {present} GROUP BY {listed})")


def _unexpected(table: str, column: str, values: list[object], where: str | None) -> str:
    wrong = f"{column} NOT IN {in_list(values)}"
    only = wrong if where is None else f"{wrong} AND {where}"
    return _found(
        f"accepted_values.{table}.{column}", f"count(DISTINCT {column})", f"{TABLES[table]} WHERE {only}"
    )


def _orphans(table: str, column: str, parent: str, parent_column: str) -> str:
    return _found(
        f"relationships.{table}.{column}",
        "count(*)",
        f"{TABLES[table]} AS child WHERE child.{column} IS NOT NULL AND NOT EXISTS "
        f"(FROM {parent} AS parent WHERE parent.{parent_column} = child.{column})",
    )


def _foreign_keys() -> list[str]:
    return [_orphans("fct_sales", c, TABLES[parent], c) for c, parent in quality.FOREIGN_KEYS.items()]


CONFLICT = (
    "(status_detail = 'Shipped' AND courier_status IN ('Unshipped', 'Cancelled')) "
    "OR (status_detail LIKE 'Pending%' AND courier_status = 'Shipped')"
)
FACT_ROWS, STG_ROWS = "(SELECT count(*) FROM fact)", "(SELECT count(*) FROM stg)"
RAW_PAIRS = '(SELECT count(*) FROM (SELECT DISTINCT "Order ID", "SKU" FROM raw))'
ONE_ROW = "(SELECT 1 AS one)"
TERMINAL = f"(status_group IN {in_list(v.TERMINAL_GROUPS)}) <> {{}}"
UNKNOWN = "fact JOIN places USING (geography_key) WHERE region = 'Unknown'"


def _differ(left: str, right: str) -> str:
    return f"if({left} <> {right}, 1, 0)"


def check_tables() -> dict[str, str]:
    everything = list(TABLES.values())

    def union(*selects: str) -> str:
        return statement(" UNION ALL ".join(selects), *everything, "regions")

    not_null = [_nulls(t, c) for t, columns in quality.NOT_NULL.items() for c in columns]
    unique = [_repeats(f"unique.{t}.{c}", t, [c]) for t, columns in quality.UNIQUE.items() for c in columns]
    accepted = [_unexpected(*wanted) for wanted in quality.accepted_values(FULFILMENTS)]
    conflicts = f"stg WHERE {CONFLICT}"
    fact_rows = _found("row_count.fct_sales.stg_orders", _differ(FACT_ROWS, STG_ROWS), ONE_ROW)
    staging_rows = _found("row_count.stg_orders.raw", _differ(RAW_PAIRS, STG_ROWS), ONE_ROW)
    cancelled = _found("cancelled_revenue.fct_sales", "count(*) FILTER (is_cancelled AND revenue_amount <> 0)", "fact")
    priced = "(SELECT count(amount) FROM stg)"
    raw_rows = "(SELECT count(*) FROM raw)"
    on_status = "stg JOIN statuses USING (status_detail)"

    def leveled(name: str, rows: str, limits: list[tuple[int, int]]) -> str:
        return union(
            *[
                f"SELECT *, {error} AS error_above FROM ({_found(name, 'count(*)', rows, warn, error)})"
                for warn, error in limits
            ]
        )

    found = {
        "chk_not_null": union(*not_null, *[_nulls("raw", c) for c in RAW_COLUMNS]),
        "chk_unique": union(*unique, *[_repeats(f"unique.raw.{c}", "raw", [c]) for c in ("Order ID", "index")]),
        "chk_accepted_values": union(
            *accepted,
            _unexpected("stg_orders", "product_size", ["1", "2", "3"], None),
            _unexpected("stg_orders", "sales_channel", ["BUILDING"], "is_b2b"),
        ),
        "chk_relationships": union(*_foreign_keys(), _orphans("stg_orders", "ship_state", "regions", "state")),
        "chk_relationships_rows": statement(
            f"SELECT order_id, sku, ship_state FROM stg WHERE ship_state NOT IN {in_list(list(REGION_OF_STATE))}",
            "stg",
        ),
        "chk_unique_combination": union(
            *[_repeats(f"unique_combination.{t}", t, cs) for t, cs in quality.UNIQUE_COMBINATION.items()],
            _repeats("unique_combination.raw", "raw", ["Order ID", "SKU"]),
        ),
        "chk_rowcount_reconcile": union(
            fact_rows,
            _found("row_count.raw.stg_orders", _differ(raw_rows, STG_ROWS), ONE_ROW),
            _found("row_count_delta.raw.stg_orders", f"{raw_rows} - {STG_ROWS}", ONE_ROW),
        ),
        "chk_staging_reconcile": union(
            staging_rows,
            _found("row_count.priced_lines.raw", _differ(RAW_PAIRS, priced), ONE_ROW),
            _found("row_count_delta.priced_lines.raw", f"{RAW_PAIRS} - {priced}", ONE_ROW),
        ),
        "chk_cancelled_revenue": union(
            cancelled, _found("cancelled_revenue.gross", "count(*) FILTER (is_cancelled AND amount <> 0)", "fact")
        ),
        "chk_is_terminal_contract": union(
            _found("terminal_contract.stg_orders", f"count(*) FILTER ({TERMINAL.format('is_terminal')})", on_status),
            _found(
                "terminal_contract.broken",
                f"count(*) FILTER ({TERMINAL.format('(is_terminal OR status_group = ' + quote('Pending') + ')')})",
                on_status,
            ),
        ),
        "chk_unknown_region": leveled(
            "unknown_region.fct_sales", UNKNOWN, [(3000, 10000), (3000, 10**9), (10**8, 10**9)]
        ),
        "chk_unknown_region_rows": statement(f"SELECT order_id, sku, ship_state FROM {UNKNOWN}", "fact"),
        "chk_status_courier": leveled("status_conflict.stg_orders", conflicts, [(250, 1000), (0, 10**6), (0, 0)]),
        "chk_status_courier_rows": statement(
            f"SELECT order_id, sku, status_detail, courier_status FROM {conflicts}", "stg"
        ),
        "chk_suite_summary": union(
            *not_null,
            *unique,
            *accepted,
            *_foreign_keys(),
            *[_repeats(f"unique_combination.{t}.{'+'.join(cs)}", t, cs) for t, cs in quality.UNIQUE_COMBINATION.items()],
            fact_rows,
            staging_rows,
            cancelled,
            _found("terminal_contract.dim_order_status", f"count(*) FILTER ({TERMINAL.format('is_terminal')})", "statuses"),
            _found("unknown_region.fct_sales", "count(*)", UNKNOWN, *quality.UNKNOWN_REGION_LIMITS),
            _found("status_conflict.stg_orders", "count(*)", conflicts, *quality.STATUS_CONFLICT_LIMITS),
        ),
    }
    found["chk_suite_scanned"] = found["chk_suite_summary"]
    found["chk_unique_sketched"] = found["chk_unique"]
    return found


def all_statements() -> dict[str, str]:
    return {
        **sources_and_sinks(),
        **scalars(),
        **model_tables(),
        **report_tables(),
        **profiles(),
        **check_tables(),
    }
