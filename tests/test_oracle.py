"""Every registered query against its SQL counterpart."""

import glob
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from oracle import statements
from orderloom.plans import catalog
from tests.conftest import SMALL, plan

QUERIES, SQL = catalog.QUERIES, statements.all_statements()
# Reports and profiles whose rows come in order: the columns that they are ordered by, True for descending.
ORDERED = {
    "rpt_city_style_topn": [("units", True), ("product_style", False)],
    "rpt_city_category_units": [("units", True)],
    "rpt_cancel_rate_region": [("cancellation_rate", True)],
    "rpt_city_style_revenue": [("units", True)],
    "rpt_city_style_revenue_by_place": [("units", True)],
    "prof_status_courier": [("row_count", True)],
    "prof_missing_by_column": [("missing", True), ("column_name", False)],
    "prof_value_distribution": [("column_name", False), ("count", True), ("value", False)],
    "prof_value_distribution_sketched": [("column_name", False), ("count", True), ("value", False)],
}
# Records over several lines and sketches are made in Arrow batches in the tasks; all other queries stay with column functions.
IN_PYTHON = {"src_csv_malformed", "src_csv_line_breaks", "chk_unique_sketched", "prof_value_distribution_sketched"}
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "date": "DATE"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(file).stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_a_counterpart_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, name):
    rows = [r.asDict() for r in QUERIES[name](spark, SMALL).collect()]
    assert len(rows) > 1
    wanted = rows
    for column, descending in reversed(ORDERED[name]):
        wanted = sorted(wanted, key=lambda r: r[column], reverse=descending)
    assert [tuple(r[c] for c, _ in ORDERED[name]) for r in rows] == [tuple(r[c] for c, _ in ORDERED[name]) for r in wanted]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches(spark, con, name):
    found = QUERIES[name](spark, SMALL)
    wanted = con.execute(SQL[name])
    wanted_types = {c[0]: str(c[1]) for c in wanted.description}
    found_types = {c: TYPES.get(t, t.upper()) for c, t in found.dtypes}
    assert found_types == wanted_types
    order = [list(wanted_types).index(c) for c in found.columns]
    expected = Counter(tuple(row[i] for i in order) for row in wanted.fetchall())
    assert expected, "an empty result proves nothing"
    assert Counter(map(tuple, found.collect())) == expected
    steps = plan(found)
    assert name in IN_PYTHON or ("Python" not in steps and "Arrow" not in steps)
    assert "FlatMapGroups" not in steps and "CartesianProduct" not in steps


def test_seasons_come_in_the_order_of_the_year(spark):
    found = [r["season"] for r in QUERIES["rpt_season_revenue"](spark, SMALL).collect()]
    assert found == ["Winter", "Spring", "Summer", "Monsoon", "Autumn"]


def test_entry(spark):
    assert entry.entry(spark).count() == 5
