"""Each check must fail on its bad row, and the suite must count all 72."""

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderloom.operators import checks
from orderloom.plans import profile, quality
from orderloom.plans.benchmark import open_benchmark
from orderloom.plans.catalog import FULFILMENTS
from orderloom.plans.warehouse import Warehouse
from tests.conftest import SMALL, plan


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (None, None), (2, "c")], "k int, v string")


def test_nulls(small):
    found = {r["check_name"]: r["failures"] for r in checks.null_counts(small, "t", ["k", "v"]).collect()}
    assert found == {"not_null.t.k": 2, "not_null.t.v": 1}


def test_repeats_ignore_null_in_one_column_and_count_it_in_combinations(small):
    assert [tuple(r) for r in checks.repeated_values(small, "k").collect()] == [(1, 2)]
    doubled = small.union(small.where("k is null and v is null"))
    assert [tuple(r) for r in checks.repeated_combinations(doubled, ["k", "v"]).collect()] == [(None, None, 2)]


def test_unexpected_values(small):
    found = {tuple(r) for r in checks.unexpected_values(small, "v", ["a"]).collect()}
    assert found == {("b", 2), ("c", 1)}
    assert checks.unexpected_values(small, "v", ["a"], F.col("k") == 2).count() == 1
    assert checks.unexpected_values(small, "v", ["a", "b", "c"]).count() == 0


def test_repeats_by_hash(small):
    assert [r[0] for r in checks.repeats(small, ["k"], nulls=False).collect()] == [2]
    doubled = small.union(small.where("k is null and v is null"))
    assert [r[0] for r in checks.repeats(doubled, ["k", "v"], nulls=True).collect()] == [2]
    swapped = small.sparkSession.createDataFrame([("a", None), (None, "a"), ("ab", "c"), ("a", "bc")], "x string, y string")
    assert checks.repeats(swapped, ["x", "y"], nulls=True).count() == 0
    assert checks.repeats(small, ["v"], nulls=False, where="k = 1").count() == 0


def test_unexpected_counts_of_several_columns(small):
    tests = [checks.Accepted("t", "k", [1]), checks.Accepted("t", "v", ["a"]), checks.Accepted("t", "v", ["a", "b"], "k = 1"), checks.Accepted("t", "v", ["c"], "k = 2")]
    found = {r["check_name"]: r["failures"] for r in checks.unexpected_counts(small, tests[:2]).collect()}
    assert found == {"accepted_values.t.k": 1, "accepted_values.t.v": 2}
    assert [r["failures"] for r in checks.unexpected_counts(small, tests[2:3]).collect()] == [0]
    assert [r["failures"] for r in checks.unexpected_counts(small, tests[3:]).collect()] == [0]


def test_kinds_of_checks_are_as_many_as_declared():
    """Stated numbers, so that a value missing from a list is noticed."""
    from orderloom.plans import vocabulary as v
    from orderloom.sources.schemas import RAW_COLUMNS, STAGING

    names = quality.check_names(FULFILMENTS)
    kinds = {k: sum(n.startswith(k + ".") for n in names) for k in ("not_null", "unique", "accepted_values", "relationships", "unique_combination")}
    assert kinds == {"not_null": 46, "unique": 8, "accepted_values": 6, "relationships": 4, "unique_combination": 2}
    assert len(names) == len(set(names)) == 72
    assert len(v.STATUSES) == 13 and len(set(v.STATUS_GROUPS)) == 5 and {s.group for s in v.STATUSES} == set(v.STATUS_GROUPS)
    assert len(v.STATE_REGIONS) == 36 and len(RAW_COLUMNS) == 24
    assert len(profile.BUSINESS_COLUMNS) == 23 and len(profile.CATEGORICAL) == 11
    assert len(STAGING.names) == 26


def test_orphans(spark, small):
    parents = spark.createDataFrame([("a",), (None,)], "id string")
    assert checks.orphan_rows(small, "v", parents, "id").count() == 3
    assert {tuple(r) for r in checks.orphan_keys(small, "v", parents, "id").collect()} == {("b", 2), ("c", 1)}


def test_count_mismatch(spark, small):
    assert checks.count_mismatch(small, small, "l", "r", "d").count() == 0
    assert tuple(checks.count_mismatch(small, spark.range(2), "l", "r", "d").first()) == (5, 2, 3)


@pytest.mark.parametrize("failures, wanted", [(0, "PASS"), (250, "PASS"), (251, "WARN"), (1000, "WARN"), (1001, "ERROR")])
def test_status_limits(spark, failures, wanted):
    rows = checks.failures("c", spark.range(failures))
    assert checks.status(checks.with_limits(rows, 250, 1000)).first()["status"] == wanted


def test_suite_on_benchmark(spark):
    w = open_benchmark(spark, SMALL)
    found = {r["check_name"]: r for r in quality.suite(w.raw(), w.staging(), w.star(), FULFILMENTS).collect()}
    assert len(found) == 72
    assert {r["status"] for r in found.values()} == {"PASS"}


def test_suite_reports_each_fault(spark, tmp_path, raw_rows):
    rows = raw_rows(
        {"Order ID": "ok"},
        {"Order ID": None, "SKU": None, "Date": "x", "Status": None, "Qty": None, "B2B": None, "Courier Status": "lost"},
        {"Order ID": "p", "SKU": "k2", "Style": None, "Category": None, "Size": None, "Fulfilment": "nobody", "Status": "?"},
        {"Order ID": "p", "SKU": "k3", "Status": "?"},
        {"Order ID": " ok", "index": "2"},
    )
    w = Warehouse(spark, str(tmp_path / "wh"), raw=lambda: rows)
    w.build()
    star = w.star()
    broken = star.fact.limit(1).withColumns(
        {
            "date_key": F.lit(1),
            "product_key": F.lit("p"),
            "geography_key": F.lit("g"),
            "is_cancelled": F.lit(True),
        }
    )
    missing = star.fact.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in star.fact.schema])
    places = star.places.unionByName(star.places.limit(1).withColumn("region", F.lit("Nowhere")))
    statuses = star.statuses.withColumn("is_terminal", ~F.col("is_terminal"))
    dates = star.dates.unionByName(star.dates.limit(1).withColumn("season", F.lit("Dry")))
    bad = star._replace(fact=star.fact.union(broken).union(missing), places=places, statuses=statuses, dates=dates)
    found = {
        r["check_name"]: r["failures"]
        for r in quality.suite(w.raw(), w.staging(), bad, ["Merchant"], quality.Limits(), quality.Limits()).collect()
        if r["failures"]
    }
    scanned = Counter(map(tuple, quality.suite(w.lines(), w.staging(), star, ["Merchant"]).collect()))
    assert Counter(map(tuple, w.suite(["Merchant"]).collect())) == scanned
    assert Counter(map(tuple, Warehouse.open(spark, str(tmp_path / "wh")).suite(["Merchant"]).collect())) == scanned
    for column in quality.NOT_NULL["stg_orders"]:
        expected = 0 if column == "promo_count" else 1
        assert found.get(f"not_null.stg_orders.{column}", 0) == expected, column
    for column in ("sku", "product_style", "product_category", "product_size"):
        assert found[f"not_null.dim_product.{column}"] >= 1, column
    for column in quality.NOT_NULL["fct_sales"]:
        assert found[f"not_null.fct_sales.{column}"] == 1, column
    assert found["unique.fct_sales.sales_key"] == 1
    assert found["unique.dim_geography.geography_key"] == 1
    assert found["unique.dim_date.date_key"] == found["unique.dim_date.full_date"] == 1
    assert found["accepted_values.stg_orders.status_detail"] == 1
    assert found["accepted_values.stg_orders.courier_status"] == 1
    assert found["accepted_values.stg_orders.fulfilment"] == 1
    assert found["accepted_values.dim_date.season"] == 1
    assert found["accepted_values.dim_geography.region"] == 1
    for key in ("date_key", "product_key", "geography_key"):
        assert found[f"relationships.fct_sales.{key}"] == 1
    assert found["unique_combination.fct_sales.order_id+sku"] == 1
    assert found["row_count.fct_sales.stg_orders"] == 1
    assert found["row_count.stg_orders.raw"] == 1  # ' ok' and 'ok' are two raw orders
    assert found["cancelled_revenue.fct_sales"] == 1
    assert found["terminal_contract.dim_order_status"] == 13


def test_what_was_measured_is_not_scanned_again(spark):
    w = open_benchmark(spark, SMALL)
    w.build()
    measured = w.measured()
    assert measured["stg_orders"]["rows.stg_orders"] == w.staging().count() and measured["fct_sales"]["cancelled_revenue.fct_sales"] == 0
    scans = lambda df, table: len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*/{table}/", plan(df)))
    reads = lambda df: "\n".join(x for x in plan(df).split("\n") if x.startswith("ReadSchema"))
    found, before = w.suite(FULFILMENTS), quality.suite(w.lines(), w.staging(), w.star(), FULFILMENTS)
    # staging: accepted values, unique pairs; the fact: keys, unique key, unique pairs
    assert scans(found, "stg_orders") == 2 and scans(before, "stg_orders") == 3
    assert scans(found, "fct_sales") == 3 and scans(before, "fct_sales") == 4
    for column in ("quantity", "promo_count", "revenue_amount", "is_cancelled"):
        assert column in reads(before) and column not in reads(found)
    limited = quality.suite(w.lines(), w.staging(), w.star(), FULFILMENTS, where={"stg_orders": "is_b2b"}, measured=measured)
    assert scans(limited, "stg_orders") == 3 and limited.count() == 72


def test_status_conflicts(raw_rows, spark, tmp_path):
    rows = raw_rows(
        {"Order ID": "1", "Courier Status": "Unshipped"},
        {"Order ID": "2", "Courier Status": "Cancelled"},
        {"Order ID": "3", "Status": "Pending - Waiting for Pick Up"},
        {"Order ID": "4", "Status": "Pending", "Courier Status": None},
        {"Order ID": "5", "Status": "Shipped - Damaged", "Courier Status": "Unshipped"},
        {"Order ID": "6"},
    )
    found = profile.status_conflicts(rows).collect()
    assert sorted((r["Status"], r["courier_status"], r["row_count"]) for r in found) == [
        ("Pending - Waiting for Pick Up", "Shipped", 1),
        ("Shipped", "Cancelled", 1),
        ("Shipped", "Unshipped", 1),
    ]


def test_overview_of_an_empty_extract(spark, raw_rows):
    empty = raw_rows({}).where("false")
    row = profile.overview(empty).first()
    assert (row["records"], row["unique_orders"], row["date_min"]) == (0, 0, None)
    assert profile.exact_duplicates(empty).first()[0] == 0
    assert profile.missing_by_column(empty).where("pct_missing is null").count() == 24
    assert profile.overview(raw_rows({})).first()["date_max"] == dt.date(2022, 4, 30)


def test_value_distribution_limits_and_breaks_ties(spark):
    values = [("x",)] * 3 + [(None,)] * 2 + [("<NULL>",)] + [(f"v{i:02d}",) for i in range(30)]
    rows = spark.createDataFrame([(v, v) for (v,) in values], "`a b` string, c string")
    found = profile.value_distribution(rows, ["a b", "c"], 5).collect()
    expected = [("<NULL>", 3), ("x", 3), ("v00", 1), ("v01", 1), ("v02", 1)]
    assert [(r["value"], r["count"]) for r in found if r["column_name"] == "a b"] == expected
    assert len(found) == 10
