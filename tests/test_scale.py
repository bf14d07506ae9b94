"""What the plans must keep to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderloom.operators import checks, counting, summaries
from orderloom.operators.joins import join_dimension
from orderloom.plans import dimensions, fact, profile, quality, reports, staging
from orderloom.plans.benchmark import open_benchmark
from orderloom.plans.catalog import FULFILMENTS
from tests.conftest import SMALL, plan


def nodes(df, name):
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(rf"[-:\s]\s?{name}", tree))


@pytest.fixture(scope="module")
def w(spark):
    warehouse = open_benchmark(spark, SMALL)
    warehouse.build()
    return warehouse


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_limits_each_key_before_the_shuffle(w):
    tree = plan(staging.staged_lines(w.raw())).split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    assert tree.count("Exchange") == 1
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")


def test_dedup_shuffles_only_repeated_lines(w):
    tree = plan(staging.staged_lines(w.raw(), w.repeated_lines())).split("\n\n")[0]
    union, window = tree.index("Union"), tree.index("Window ")
    assert union < window
    assert tree.count("BroadcastHashJoin LeftAnti") == tree.count("BroadcastHashJoin LeftSemi") == 1
    unshuffled, shuffled = sorted([tree.index("LeftAnti"), window])
    assert len(re.findall(r"[- ]Exchange", tree[unshuffled:])) == 1 and unshuffled == tree.index("LeftAnti")


def test_many_columns_are_profiled_in_one_scan(w):
    for build in (profile.missing_by_column, profile.value_distribution, profile.quality_counters):
        assert nodes(build(w.raw()), "Scan parquet") == 1, build.__name__


def test_many_summaries_share_one_scan_and_equal_aggregates(w):
    found = profile.bundle(w.raw())
    assert nodes(found, "Scan parquet") == 1 and plan(found).split("\n\n")[0].count("HashAggregate") == 2
    text = plan(found)
    assert text.count("partial_count(1)") == 1  # the rows are counted once for all 24 shares
    rows = {(r["profile"], r["measure"]): r["value"] for r in found.collect()}
    alone = profile.quality_counters(w.raw()).first().asDict() | profile.promotion_shape(w.raw()).first().asDict()
    assert {m: rows[p, m] for p, m in rows if p in ("quality_counters", "promotion_shape")} == alone
    few = summaries.summarise(w.raw().limit(0), {"a": summaries.Summary({"n": F.count(F.lit(1)), "top": F.max("Qty")})})
    assert [tuple(r) for r in few.collect()] == [("a", "n", 0.0), ("a", "top", None)]


def test_counts_before_the_shuffle(w):
    tree = plan(profile.value_distribution(w.raw())).split("\n\n")[0]
    assert tree.count("HashAggregate") >= 2
    assert tree.count("WindowGroupLimit") == 2


def test_scan_reads_only_what_a_report_needs(w):
    text = plan(profile.cancelled_with_amount(w.raw()))
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert schema == "struct<Status:string,Amount:string>"
    assert "EqualTo(Status,Cancelled)" in text


def test_derived_keys_need_no_shuffle(w):
    tree = plan(fact.fact_by_key(w.staging(), w.dates(), w.places(), w.statuses())).split("\n\n")[0]
    assert len(re.findall(r"[- ]Exchange", tree)) == 0
    assert tree.count("BroadcastHashJoin") == 3


def test_lookups_never_shuffle_staging_for_dates_or_statuses(w, no_broadcast):
    tree = plan(fact.fact_by_lookup(w.staging(), w.dates(), w.products(), w.places(), w.statuses())).split("\n\n")[0]
    assert tree.count("BroadcastHashJoin") == 2 and tree.count("SortMergeJoin") == 2


def scans(df, table):
    return len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*/{table}/", plan(df)))


def test_suite_reads_each_table_a_few_times(w):
    suite = quality.suite(w.raw(), w.staging(), w.star(), FULFILMENTS)
    assert scans(suite, "stg_orders") <= 3 and scans(suite, "fct_sales") <= 4 and scans(suite, "order_lines") == 1
    unknown, conflicts, accepted = (entry.queries()[f"chk_{x}"](w.spark, SMALL) for x in ("unknown_region", "status_courier", "accepted_values"))
    assert scans(unknown, "fct_sales") == 1 and scans(conflicts, "stg_orders") == 1 and scans(accepted, "stg_orders") == 1
    assert scans(profile.overview(w.raw()), "order_lines") == 1


def test_uniqueness_shuffles_hashes(w):
    text = plan(checks.repeats(w.fact(), ["sales_key"], nulls=False))
    exchange = re.search(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", text).group(1)
    carried = [re.sub(r"#.*", "", c).strip() for c in exchange.split(",")]
    assert carried == ["_groupingexpression", "_groupingexpression", "count"]  # two hashes, never the key


def test_fixed_dimensions_are_broadcast_by_their_known_size(spark, w):
    statuses, regions = dimensions.order_statuses(spark), dimensions.state_regions(spark)
    big = w.staging().join(statuses, "status_detail")
    assert "BroadcastHashJoin" in plan(big)
    assert "BroadcastHashJoin" in plan(dimensions.places(w.staging(), regions))


def test_large_dimension_is_not_broadcast(w, no_broadcast):
    keys = w.places().select("geography_key")
    assert "SortMergeJoin" in plan(join_dimension(w.fact(), keys, "geography_key", broadcast_rows=3))
    assert "BroadcastHashJoin" in plan(join_dimension(w.fact(), keys, "geography_key"))


def test_report_sums_the_fact_before_it_is_shuffled(w, no_broadcast):
    """Without broadcasts every exchange above the fact's first sum carries sums only."""
    tree = plan(reports.cancellation_rate(w.star(), None)).split("\n\n")[0]
    assert tree.index("SortMergeJoin") < tree.rindex("HashAggregate")
    wanted = reports.season_revenue(w.star(), None).collect()
    assert wanted and sum(r["orders"] for r in wanted) == w.fact().count()


@pytest.mark.parametrize("name", ["rpt_city_style_topn", "rpt_cancel_rate_region", "fct_sales", "chk_relationships"])
def test_same_result_without_broadcasts(spark, no_broadcast, name):
    query = entry.queries()[name]
    without = sorted(map(str, query(spark, SMALL).collect()))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(str, query(spark, SMALL).collect())) == without


def test_distinct_counts_over_several_passes(spark):
    columns = [f"c{i}" for i in range(30)]
    rows = spark.range(500).select(*[(F.col("id") % (i + 1)).cast("string").alias(c) for i, c in enumerate(columns)])
    found = counting.distinct_counts(rows, {c: c for c in columns}).first()
    assert found.asDict() == {c: i + 1 for i, c in enumerate(columns)}
    estimated = counting.distinct_counts(rows, {c: c for c in columns}, relative_error=0.05).first()
    assert all(abs(estimated[c] - n) <= 0.2 * n for c, n in found.asDict().items())


def test_no_local_checkpoints_or_driver_collections():
    from pathlib import Path

    for file in (Path(__file__).resolve().parents[1] / "orderloom").rglob("*.py"):
        if "llm" in file.parts:
            continue  # the optional subpackage has Python operators and bounded samples
        source = file.read_text()
        for word in ("localCheckpoint", ".collect(", "toPandas", ".rdd", "pandas_udf", "crossJoin(F."):
            if (file.name, word) == ("records.py", ".collect("):
                continue  # splits that start within quotes, of which it allows a fixed number
            assert word not in source, (file, word)
