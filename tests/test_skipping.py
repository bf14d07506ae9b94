"""Reports on a fact that is stored by place."""

from collections import Counter

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.operators.skipping import key_ranges, near_keys
from orderloom.plans import reports
from orderloom.plans.benchmark import open_benchmark
from orderloom.plans.catalog import CITY
from orderloom.plans.fact import PLACE_ORDER
from orderloom.plans.warehouse import Warehouse
from orderloom.sources import tables
from orderloom.sources.order_lines import benchmark_regions, raw_order_lines
from tests.conftest import SMALL, plan


def rows_read(spark, run):
    """Rows that scans hand on while ``run`` does its work."""
    store, gateway = spark._jsc.sc().statusStore(), spark._sc._gateway

    def total():
        spark._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).inputRecords() for i in range(stages.size()))

    before = total()
    out = run()
    return total() - before, out


def test_city_reports_read_few_row_groups(spark, tmp_path):
    w = open_benchmark(spark, SMALL)
    path = str(tmp_path / "fact")
    n = tables.overwrite(w.fact(), path, order_by=PLACE_ORDER, rows_per_group=100)
    star = w.star()._replace(fact=tables.read(spark, path, w.fact().schema), by_place=True)
    wanted = reports.style_revenue(w.star(), CITY).collect()
    found = reports.style_revenue(star, CITY)
    assert found.collect() == wanted and wanted
    assert "geography_key" in next(x for x in plan(found).split("\n") if x.startswith("PushedFilters") and "geography_key" in x)
    lines = near_keys(star.fact, "geography_key", star.places.where(F.col("ship_city") == CITY)).select("geography_key", "quantity")
    read, _ = rows_read(spark, lambda: lines.write.format("noop").mode("overwrite").save())
    assert 0 < read - 2 * star.places.count() < n / 5
    # the row groups themselves, by their statistics
    key = star.places.where(F.col("ship_city") == CITY).first()["geography_key"]
    groups = hit = 0
    for file in (tmp_path / "fact").rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("geography_key")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            groups, hit = groups + 1, hit + (stats.min <= key <= stats.max)
    assert groups >= 40 and 0 < hit < groups / 5


def test_a_warehouse_stored_by_place(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path), raw=lambda: raw_order_lines(spark, SMALL), regions=lambda: benchmark_regions(spark), calendar=None, fact_by_place=True)
    star = w.star()
    assert star.by_place and Warehouse.open(spark, str(tmp_path)).star().by_place
    plain = open_benchmark(spark, SMALL).star()
    assert not plain.by_place and star.fact.columns == plain.fact.columns
    assert Counter(star.fact.collect()) == Counter(plain.fact.collect())
    assert reports.top_styles(star, CITY, "XX").collect() == reports.top_styles(plain, CITY, "XX").collect()
    assert reports.top_styles(star, "no such city", "XX").count() == 0


def test_keys_that_are_too_many_limit_nothing(spark):
    rows = spark.range(100).selectExpr("cast(id % 10 AS string) AS k", "id")
    keys = spark.createDataFrame([("3",), ("7",), ("3",), (None,)], "k string")
    assert Counter(r["k"] for r in near_keys(rows, "k", keys).collect()) == {"3": 10, "7": 10}
    assert near_keys(rows, "k", keys, most_ranges=1).count() == 50
    assert near_keys(rows, "k", keys, most_keys=1) is rows
    assert near_keys(rows, "k", keys.limit(0)).count() == 0
    assert near_keys(rows, "id", spark.range(4).where("id <> 1")).count() == 3


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.lists(st.integers(-50, 50), min_size=1), st.lists(st.text(max_size=9), min_size=1)), st.integers(1, 6))
def test_ranges_hold_all_keys(keys, most):
    ranges = key_ranges(keys, most)
    assert len(ranges) <= most and all(any(a <= k <= b for a, b in ranges) for k in keys)
    assert all(a in keys and b in keys for a, b in ranges) and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:], strict=False))
    if most >= len(set(keys)):
        assert all(a == b for a, b in ranges)
