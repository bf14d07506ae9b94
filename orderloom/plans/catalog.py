"""Every query by name, each on a folder of benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderloom.functions import keys, parse, text
from orderloom.operators import checks, repeats
from orderloom.operators.dedup import clustering
from orderloom.plans import dimensions, fact, profile, quality, reports, staging
from orderloom.plans.benchmark import open_benchmark, scratch
from orderloom.plans.vocabulary import UNKNOWN_PLACE
from orderloom.plans.warehouse import SALE_MONTH, Warehouse
from orderloom.sources import csvfiles, tables
from orderloom.sources.order_lines import COUNTRY, FULFILMENT, benchmark_regions, clustered_order_lines

CITY = "NATION_3"
FULFILMENTS = list(FULFILMENT.values())

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register a query on the stored warehouse under the function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(open_benchmark(spark, folder))

    QUERIES[build.__name__] = run
    return build


def _rows() -> Column:
    return F.count(F.lit(1)).cast("bigint")


def _lines(raw: DataFrame, *columns: Column) -> DataFrame:
    """Columns of the raw lines next to what identifies a line."""
    return raw.select(text.column("Order ID").alias("order_id"), F.col("index").alias("line_index"), *columns)


def _variant(raw: DataFrame, *choices: Column) -> Column:
    """One of the choices per line, by its line number."""
    number = F.floor(F.col("index").cast("bigint") / 1000000).cast("int")
    return F.element_at(F.array(*choices), number % len(choices) + 1)


# Sources and sinks


@query
def src_csv_raw(w: Warehouse) -> DataFrame:
    """Raw lines through a CSV file, with quotes and commas inside a field."""
    path = scratch(w, "order-lines-csv")
    quoted = F.concat(F.lit('"'), F.col("ASIN"), F.lit('", boxed'))
    csvfiles.write_csv(w.raw().withColumn("ASIN", quoted), path, compressed=True)
    return csvfiles.read_text_csv(w.spark, path)


@query
def src_csv_malformed(w: Warehouse) -> DataFrame:
    """Lines of a CSV file with line breaks in quoted fields, fields too many and fields too few."""
    path = scratch(w, "order-lines-malformed")
    number = F.floor(F.col("index").cast("bigint") / 1000000).cast("int")
    quoted = [F.concat(F.lit('"'), F.coalesce(text.column(c), F.lit("")), F.lit('"')) for c in ("index", "Order ID")]
    broken = F.concat(F.lit('"'), text.column("ASIN"), F.lit('\n""boxed"""'))
    asin = F.when(number == 2, broken).otherwise(F.concat(F.lit('"'), text.column("ASIN"), F.lit('"')))
    line = F.when(number == 3, F.concat_ws(",", *quoted)).when(number == 4, F.concat_ws(",", *quoted, asin, F.lit("extra"))).otherwise(F.concat_ws(",", *quoted, asin))
    w.raw().select(line.alias("value")).write.mode("overwrite").text(path)
    schema = StructType([StructField(c, StringType()) for c in ("line_index", "order_id", "asin")])
    good, bad = csvfiles.split_csv(w.spark, path, schema, multi_line=True, header=False)
    diverted = bad.select(F.replace(F.split_part(F.col(csvfiles.MALFORMED), F.lit(","), F.lit(1)), F.lit('"'), F.lit("")).alias("line_index"))
    return good.withColumn("diverted", F.lit(False)).unionByName(diverted.withColumn("diverted", F.lit(True)), allowMissingColumns=True)


@query
def src_csv_line_breaks(w: Warehouse) -> DataFrame:
    """Raw lines through a CSV file with line breaks in quoted fields, each file read in splits of a megabyte."""
    path = scratch(w, "order-lines-broken")
    broken = F.concat(text.column("ASIN"), F.lit('\n"boxed",\n'), text.column("Order ID"))
    csvfiles.write_csv(w.raw().withColumn("ASIN", broken), path)
    return csvfiles.read_text_csv(w.spark, path, multi_line=True, split_bytes=1 << 20)


@query
def sink_overwrite_roundtrip(w: Warehouse) -> DataFrame:
    """A table written twice holds the second content only."""
    path = scratch(w, "overwrite")
    rows = w.staging().select("order_id", "sku", "order_date", "quantity", "amount", "is_b2b")
    tables.overwrite(rows.where("is_b2b"), path)
    tables.overwrite(rows, path)
    return tables.read(w.spark, path, rows.schema)


@query
def load_audit_count(w: Warehouse) -> DataFrame:
    """Rows counted while loading, next to the rows found in the stored table."""
    stored = w.raw()
    observed = w.rows_written["order_lines"]
    return stored.agg(_rows().alias("stored_rows")).select(
        F.lit("order_lines").alias("table_name"), F.lit(observed).cast("bigint").alias("observed_rows"), "stored_rows"
    )


@query
def seed_region_lookup(w: Warehouse) -> DataFrame:
    """Region lookup from its CSV file, with the lines shipped to each state."""
    path = scratch(w, "regions-csv")
    csvfiles.write_csv(benchmark_regions(w.spark), path)
    lookup = csvfiles.read_regions(w.spark, path)
    per_state = w.staging().groupBy(F.col("ship_country").alias("country"), F.col("ship_state").alias("state"))
    return per_state.agg(_rows().alias("order_lines")).join(lookup, ["country", "state"], "left")


@query
def mart_materialize_roundtrip(w: Warehouse) -> DataFrame:
    """The fact stored by month and read back."""
    path = scratch(w, "fact-by-month")
    month = (F.col("date_key") / 100).cast("int")
    tables.overwrite(fact.packed(w.fact()).withColumn(SALE_MONTH, month), path, partition_by=SALE_MONTH, finish=fact.unpacked)
    per_month = w.spark.read.parquet(tables.current(w.spark, path)).groupBy(F.col(SALE_MONTH).cast("int").alias(SALE_MONTH))
    return per_month.agg(
        _rows().alias("order_lines"), F.sum("revenue_amount").cast("decimal(38,2)").alias("total_revenue")
    )


@query
def namespace_sql(w: Warehouse) -> DataFrame:
    """Units per region and status group, as SQL on the published names."""
    prefix = f"ol_{w.base.rsplit('-', 1)[-1][:8]}_"
    w.publish(prefix)
    found = w.spark.sql(
        f"""
        SELECT region, status_group, CAST(sum(quantity) AS BIGINT) AS units
        FROM {prefix}marts.fct_sales
        JOIN {prefix}marts.dim_geography USING (geography_key)
        JOIN {prefix}marts.dim_order_status USING (status_key)
        GROUP BY region, status_group
        """
    )
    # the plan holds the tables by now, so the names may go
    tables.unpublish(w.spark, ["raw", "seeds", "staging", "marts"], prefix)
    return found


@query
def mart_reopen_report(w: Warehouse) -> DataFrame:
    """A report from the stored tables, opened anew without loading or building anything."""
    w.build()
    return reports.style_revenue(Warehouse.open(w.spark, w.base).star(), CITY)


# Column functions, on all raw lines


@query
def scalar_text_clean(w: Warehouse) -> DataFrame:
    raw = w.raw()
    wide = F.concat(F.lit("\u00a0 "), F.col("ship-city"), F.lit("\u3000"))
    tabbed = F.concat(F.lit("\t"), F.col("ship-city"))
    return _lines(
        raw,
        text.clean("SKU").alias("sku"),
        text.clean("ship-city").alias("city"),
        text.clean_upper("ship-city").alias("city_upper"),
        text.clean_upper(wide).alias("wide_spaces"),
        text.clean(tabbed).alias("tab_kept"),
        text.is_blank("promotion-ids").alias("no_promotion"),
    )


@query
def scalar_bool_flag(w: Warehouse) -> DataFrame:
    missing = F.when(F.col("Courier Status").isNotNull(), F.col("B2B"))
    return _lines(w.raw(), text.is_true_text("B2B").alias("is_b2b"), text.is_true_text(missing).alias("some_missing"))


@query
def scalar_postal_clean(w: Warehouse) -> DataFrame:
    return _lines(
        w.raw(), text.before_dot("ship-postal-code").alias("postal_code"), text.before_dot("Amount").alias("whole_amount")
    )


@query
def scalar_nullif_coalesce(w: Warehouse) -> DataFrame:
    return _lines(
        w.raw(),
        text.blank_to_null("promotion-ids").alias("promotions"),
        text.or_default(text.blank_to_null("promotion-ids"), "<NULL>").alias("promotions_label"),
        text.or_default("ship-city", UNKNOWN_PLACE).alias("city_or_unknown"),
    )


@query
def scalar_try_cast(w: Warehouse) -> DataFrame:
    raw = w.raw()
    quantity, amount = F.col("Qty"), F.coalesce("Amount", F.lit(""))
    digits = F.split_part(quantity, F.lit("."), F.lit(1))
    messy = _variant(
        raw,
        quantity,
        amount,
        F.concat(F.lit(" "), digits, F.lit(".5 ")),
        F.concat(amount, F.lit("d")),
        F.concat(digits, F.lit("e2")),
        F.concat(F.lit("-"), digits, F.lit(".5")),
        F.concat(digits, F.lit("12345678.125")),
    )
    return _lines(
        raw,
        messy.alias("given"),
        parse.parse_int(messy).alias("as_int"),
        parse.parse_money(messy).alias("as_money"),
        parse.parse_double(messy).alias("as_double"),
    )


@query
def scalar_try_date(w: Warehouse) -> DataFrame:
    raw = w.raw()
    month, day, year = (F.split_part(F.col("Date"), F.lit("-"), F.lit(i)) for i in (1, 2, 3))
    unpadded = lambda c: c.cast("int").cast("string")
    dashed = lambda *parts: F.concat_ws("-", *parts)
    messy = _variant(
        raw,
        F.concat(F.lit(" "), F.col("Date"), F.lit("\t")),
        dashed(unpadded(month), unpadded(day), year),
        dashed(day, month, year),
        dashed(F.concat(F.lit("0"), month), day, year),
        dashed(month, day, F.concat(F.lit("20"), year)),
        dashed(month, day, unpadded(year)),
        dashed(month, day, F.lpad(F.floor(F.col("l") % 100).cast("string"), 2, "0")),
    )
    lined = raw.withColumn("l", F.col("Order ID").cast("bigint"))
    return _lines(
        lined, F.coalesce(messy, F.lit("")).alias("given"), parse.parse_mdy(messy).alias("as_date")
    )


@query
def derived_measures(w: Warehouse) -> DataFrame:
    return w.staging().select(
        "order_id", "sku", "status_detail", "amount", "is_cancelled", "revenue_amount", "promo_count"
    )


@query
def surrogate_key(w: Warehouse) -> DataFrame:
    return w.staging().select(
        "order_id",
        "sku",
        keys.surrogate_key("order_id", "sku").alias("sales_key"),
        keys.surrogate_key("sku").alias("product_key"),
        keys.surrogate_key(*dimensions.PLACE).alias("place_key"),
    )


# Models


@query
def dedup_latest_complete(w: Warehouse) -> DataFrame:
    """The kept line of each (order, sku) and its position in the source."""
    kept = staging.best_lines(w.lines(), w.repeated_lines())
    return kept.select(
        text.clean("Order ID").alias("order_id"),
        text.clean("SKU").alias("sku"),
        parse.parse_int("index").alias("source_position"),
        text.column("Status").alias("status_detail"),
        parse.parse_int("Qty").alias("quantity"),
        parse.parse_money("Amount").alias("amount"),
    )


@query
def stg_orders(w: Warehouse) -> DataFrame:
    """Staging from the stored raw lines, only repeated ones sorted."""
    return staging.staged_lines(w.lines(), w.repeated_lines())


@query
def stg_orders_many_repeats(w: Warehouse) -> DataFrame:
    """The same where the repeated lines are too many to broadcast: clustered lines are sorted where they are."""
    return staging.staged_lines(w.lines(), w.repeated_lines(), broadcast_rows=0)


def stg_orders_from_source(spark: SparkSession, folder: str) -> DataFrame:
    """Staging straight from the source tables, nothing stored in between."""
    return staging.staged_lines(clustered_order_lines(spark, folder))


QUERIES["stg_orders_from_source"] = stg_orders_from_source


@query
def dim_product(w: Warehouse) -> DataFrame:
    return dimensions.products(w.staging())


@query
def dim_date(w: Warehouse) -> DataFrame:
    return dimensions.calendar_covering(w.staging(), "order_date")


@query
def dim_date_span(w: Warehouse) -> DataFrame:
    """A calendar of a stated span, with the staging lines of each day."""
    days = dimensions.calendar(w.spark, "1995-01-01", "1997-07-01")
    lines = w.staging().groupBy(F.col("order_date").alias("full_date")).agg(_rows().alias("order_lines"))
    counted = days.join(lines, "full_date", "left")
    return counted.withColumn("order_lines", F.coalesce("order_lines", F.lit(0).cast("bigint")))


@query
def dim_geography(w: Warehouse) -> DataFrame:
    return dimensions.places(w.staging(), w.regions())


@query
def dim_order_status(w: Warehouse) -> DataFrame:
    """The status dimension with the staging lines in each status."""
    lines = w.staging().groupBy("status_detail").agg(_rows().alias("order_lines"))
    counted = dimensions.order_statuses(w.spark).join(lines, "status_detail", "left")
    return counted.withColumn("order_lines", F.coalesce("order_lines", F.lit(0).cast("bigint")))


@query
def fct_sales(w: Warehouse) -> DataFrame:
    """The fact with every key looked up in its dimension."""
    return fact.fact_by_lookup(w.staging(), w.dates(), w.products(), w.places(), w.statuses())


@query
def fct_sales_derived_keys(w: Warehouse) -> DataFrame:
    """The same fact with product and place keys computed in place."""
    return fact.fact_by_key(w.staging(), w.dates(), w.places(), w.statuses())


# Reports


@query
def rpt_city_style_topn(w: Warehouse) -> DataFrame:
    return reports.top_styles(w.star(), CITY, COUNTRY)


@query
def rpt_city_category_units(w: Warehouse) -> DataFrame:
    return reports.category_units(w.star(), CITY, COUNTRY)


@query
def rpt_season_revenue(w: Warehouse) -> DataFrame:
    return reports.season_revenue(w.star(), COUNTRY)


@query
def rpt_cancel_rate_region(w: Warehouse) -> DataFrame:
    return reports.cancellation_rate(w.star(), COUNTRY)


@query
def rpt_city_style_revenue(w: Warehouse) -> DataFrame:
    return reports.style_revenue(w.star(), CITY)


@query
def rpt_city_style_revenue_by_place(w: Warehouse) -> DataFrame:
    """The same on a fact stored in the order of places, of which the row groups of the city are read."""
    path = scratch(w, "fact-by-place")
    tables.overwrite(fact.packed(w.fact()), path, order_by=fact.PLACE_ORDER, rows_per_group=20_000, finish=fact.unpacked)
    star = w.star()._replace(fact=tables.read(w.spark, path, w.fact().schema), by_place=True)
    return reports.style_revenue(star, CITY)


# Profile of the raw lines


def _profile(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: build(open_benchmark(spark, folder).raw())


_profile("prof_overview", profile.overview)
_profile("prof_order_fanout", profile.order_fanout)
_profile("prof_style_fanout", profile.style_fanout)
QUERIES["prof_duplicate_pairs"] = lambda spark, folder: profile.duplicate_pairs(open_benchmark(spark, folder).lines())
_profile("prof_quality_counters", profile.quality_counters)
_profile("prof_sku_drift", profile.sku_drift)
_profile("prof_co_missing", profile.co_missing)
_profile("prof_crosstab", profile.fulfilment_crosstab)
_profile("prof_status_courier", profile.status_conflicts)
_profile("prof_casing_collapse", profile.casing_collapse)
_profile("prof_anomaly_by_status", profile.anomalies_by_status)
_profile("prof_cancelled_with_amount", profile.cancelled_with_amount)
_profile("prof_promo_shape", profile.promotion_shape)
_profile("prof_non_empty", lambda raw: profile.filled_rows(raw, "Unnamed: 22", "unnamed_22_non_empty"))
_profile("prof_missing_by_column", profile.missing_by_column)
_profile("prof_bundle", profile.bundle)
_profile("prof_value_distribution", profile.value_distribution)
_profile("prof_value_distribution_sketched", profile.value_distribution_of_many)
_profile("prof_distinct_counts", profile.category_cardinality)


@query
def prof_exact_duplicates(w: Warehouse) -> DataFrame:
    return profile.exact_duplicates(w.lines(), w.repeated_lines())


@query
def prof_exact_duplicates_clustered(w: Warehouse) -> DataFrame:
    """The same where the repeated lines are too many to broadcast: clustered lines are grouped where they are."""
    return profile.exact_duplicates(w.lines(), w.repeated_lines(), broadcast_rows=0)


def _dirty(raw: DataFrame) -> DataFrame:
    """Raw lines with the faults the extract lacks, chosen by line number, plus pending lines twice."""
    number = F.floor(F.col("index").cast("bigint") / 1000000).cast("int")
    faults = {
        "Date": F.when(number == 1, "13-45-99").when(number == 2, " ").otherwise(F.col("Date")),
        "Qty": F.when(number == 3, F.concat(F.lit("-"), F.col("Qty"))).otherwise(F.col("Qty")),
        "Amount": F.when(number == 4, F.concat(F.lit("-"), F.col("Amount"))).otherwise(F.col("Amount")),
        "currency": F.when(number == 5, F.lit("\u00a0")).otherwise(F.col("currency")),
        "Style": F.when(number == 6, "").when(number == 7, "Brand#0").otherwise(F.col("Style")),
        "Category": F.when(number == 7, F.concat(F.col("Category"), F.lit(" "))).otherwise(F.col("Category")),
        "ship-city": F.when(number == 1, "  ").otherwise(F.col("ship-city")),
    }
    faulty = raw.withColumns(faults)
    return faulty.unionByName(faulty.where(F.col("Status").startswith("Pending")))


_profile("prof_overview_dirty", lambda raw: profile.overview(_dirty(raw)))
_profile("prof_duplicate_pairs_dirty", lambda raw: profile.duplicate_pairs(_dirty(raw)))
_profile("prof_exact_duplicates_dirty", lambda raw: profile.exact_duplicates(_dirty(raw)))
_profile("prof_quality_counters_dirty", lambda raw: profile.quality_counters(_dirty(raw)))
_profile("prof_style_fanout_dirty", lambda raw: profile.style_fanout(_dirty(raw)))
_profile("prof_sku_drift_dirty", lambda raw: profile.sku_drift(_dirty(raw)))
_profile("prof_co_missing_dirty", lambda raw: profile.co_missing(_dirty(raw)))
_profile("prof_missing_by_column_dirty", lambda raw: profile.missing_by_column(_dirty(raw)))


# Checks. Each also covers an input that fails.


def _status(*results: DataFrame, limits: quality.Limits = quality.Limits()) -> DataFrame:
    return checks.status(checks.with_limits(checks.union_all(results), *limits))


def _under(found: DataFrame, *limits: quality.Limits) -> DataFrame:
    """One count held against several limits."""
    each = F.array(*[F.struct(F.lit(x.warn_above).alias("warn_above"), F.lit(x.error_above).alias("error_above")) for x in limits])
    held = found.select("check_name", "failures", F.explode(each).alias("x")).select("check_name", "failures", "x.*")
    level = checks.level(F.col("failures"), F.col("warn_above"), F.col("error_above"))
    return held.select("check_name", F.col("failures").cast("bigint").alias("failures"), level.alias("status"), "error_above")


def _named_tables(w: Warehouse) -> dict[str, DataFrame]:
    star = w.star()
    return {
        "raw": w.raw(),
        "stg_orders": w.staging(),
        "fct_sales": star.fact,
        "dim_date": star.dates,
        "dim_product": star.products,
        "dim_geography": star.places,
        "dim_order_status": star.statuses,
    }


@query
def chk_not_null(w: Warehouse) -> DataFrame:
    t = _named_tables(w)
    wanted = {**quality.NOT_NULL, "raw": t["raw"].columns}
    return _status(*[checks.null_counts(t[name], name, columns) for name, columns in wanted.items()])


@query
def chk_unique(w: Warehouse) -> DataFrame:
    t = _named_tables(w)
    wanted = {**quality.UNIQUE, "raw": ["Order ID", "index"]}
    return _status(
        *[
            checks.failures(f"unique.{name}.{c}", checks.repeats(t[name], [c], nulls=False))
            for name, columns in wanted.items()
            for c in columns
        ]
    )


@query
def chk_unique_sketched(w: Warehouse) -> DataFrame:
    """The same where keys that occur once are told by a sketch, and only the others are shuffled."""
    t = _named_tables(w)
    wanted = {**quality.UNIQUE, "raw": ["Order ID", "index"]}
    return _status(*[checks.failures(f"unique.{name}.{c}", repeats.repeated_counts(t[name], [c], nulls=False)) for name, columns in wanted.items() for c in columns])


@query
def chk_accepted_values(w: Warehouse) -> DataFrame:
    t = _named_tables(w)
    wanted = [
        *quality.accepted_values(FULFILMENTS),
        checks.Accepted("stg_orders", "product_size", ["1", "2", "3"]),
        checks.Accepted("stg_orders", "sales_channel", ["BUILDING"], "is_b2b"),
    ]
    return _status(*quality.accepted_counts(t, wanted))


@query
def chk_relationships(w: Warehouse) -> DataFrame:
    t = _named_tables(w)
    results = [
        checks.failures(
            f"relationships.fct_sales.{key}",
            checks.orphan_keys(t["fct_sales"], key, t[parent], key),
            F.sum("row_count"),
        )
        for key, parent in quality.FOREIGN_KEYS.items()
    ]
    states = checks.orphan_keys(t["stg_orders"], "ship_state", w.regions(), "state")
    return _status(*results, checks.failures("relationships.stg_orders.ship_state", states, F.sum("row_count")))


@query
def chk_relationships_rows(w: Warehouse) -> DataFrame:
    """The lines themselves whose state is missing from the region lookup."""
    orphans = checks.orphan_rows(w.staging(), "ship_state", w.regions(), "state")
    return orphans.select("order_id", "sku", "ship_state")


@query
def chk_unique_combination(w: Warehouse) -> DataFrame:
    t = _named_tables(w)
    t["raw"] = w.lines()
    wanted = {**quality.UNIQUE_COMBINATION, "raw": ["Order ID", "SKU"]}
    return _status(
        *[
            checks.failures(f"unique_combination.{name}", checks.repeats(t[name], columns, nulls=True, within=clustering(t[name])))
            for name, columns in wanted.items()
        ]
    )


@query
def chk_rowcount_reconcile(w: Warehouse) -> DataFrame:
    star = w.star()
    against_raw = checks.count_mismatch(w.raw(), w.staging(), "raw_rows", "staging_rows", "delta_rows")
    return _status(
        checks.failures("row_count.fct_sales.stg_orders", quality.fact_count_mismatch(star, w.staging())),
        checks.failures("row_count.raw.stg_orders", against_raw),
        checks.failures("row_count_delta.raw.stg_orders", against_raw, F.sum("delta_rows")),
    )


@query
def chk_staging_reconcile(w: Warehouse) -> DataFrame:
    raw, staged = w.lines(), w.staging()
    thinned = staged.where(F.col("amount").isNotNull())
    short = quality.staging_count_mismatch(raw, thinned)
    return _status(
        checks.failures("row_count.stg_orders.raw", quality.staging_count_mismatch(raw, staged)),
        checks.failures("row_count.priced_lines.raw", short),
        checks.failures("row_count_delta.priced_lines.raw", short, F.sum("unexpected_delta")),
    )


@query
def chk_cancelled_revenue(w: Warehouse) -> DataFrame:
    star = w.star()
    gross = star._replace(fact=star.fact.withColumn("revenue_amount", F.col("amount")))
    return _status(
        checks.failures("cancelled_revenue.fct_sales", quality.cancelled_revenue_rows(star)),
        checks.failures("cancelled_revenue.gross", quality.cancelled_revenue_rows(gross)),
    )


@query
def chk_is_terminal_contract(w: Warehouse) -> DataFrame:
    """The status contract on the status of every staging line, and on a broken copy."""
    lines = w.staging().join(w.statuses(), "status_detail")
    broken = lines.withColumn("is_terminal", F.col("is_terminal") | (F.col("status_group") == "Pending"))
    return _status(
        checks.failures("terminal_contract.stg_orders", quality.terminal_mismatch_rows(lines)),
        checks.failures("terminal_contract.broken", quality.terminal_mismatch_rows(broken)),
    )


@query
def chk_unknown_region(w: Warehouse) -> DataFrame:
    """The same count under the default limits and under wider ones."""
    found = quality.unknown_region_count(w.star())
    return _under(found, quality.UNKNOWN_REGION_LIMITS, quality.Limits(3000, 10**9), quality.Limits(10**8, 10**9))


@query
def chk_unknown_region_rows(w: Warehouse) -> DataFrame:
    return quality.unknown_region_rows(w.star())


@query
def chk_status_courier(w: Warehouse) -> DataFrame:
    found = checks.failures("status_conflict.stg_orders", quality.status_conflict_rows(w.staging()))
    return _under(found, quality.STATUS_CONFLICT_LIMITS, quality.Limits(0, 10**6), quality.Limits())


@query
def chk_status_courier_rows(w: Warehouse) -> DataFrame:
    return quality.status_conflict_rows(w.staging())


@query
def chk_suite_summary(w: Warehouse) -> DataFrame:
    """All checks; those on single rows and the row counts were counted while the tables were written."""
    return w.suite(FULFILMENTS)


@query
def chk_suite_scanned(w: Warehouse) -> DataFrame:
    """All checks on tables of which nothing is known."""
    return quality.suite(w.raw(), w.staging(), w.star(), FULFILMENTS)
