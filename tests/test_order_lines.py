"""Lines move before they are rendered as text."""

import glob
import re
import time

import pytest
from pyspark.sql import functions as F

from orderloom.operators.dedup import KEY_HASH, key_hash
from orderloom.plans import fact, profile, staging
from orderloom.plans.benchmark import open_benchmark
from orderloom.sources import csvfiles, order_lines, tables
from tests.conftest import SMALL, plan


def test_stored_lines_are_the_rendered_ones_by_the_hash_of_their_text(spark):
    w = open_benchmark(spark, SMALL)
    stored, wanted = w.raw(), order_lines.raw_order_lines(spark, SMALL)
    assert stored.exceptAll(wanted).count() == wanted.exceptAll(stored).count() == 0
    assert w.lines().where(F.col(KEY_HASH) != key_hash(staging.line_key())).count() == 0


def test_a_large_source_is_not_dealt_anew_and_no_text_moves(spark, monkeypatch):
    monkeypatch.setattr(order_lines, "SPREAD_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        text = plan(staging.staged_lines(order_lines.clustered_order_lines(spark, SMALL)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "RoundRobinPartitioning" not in text
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)
    assert moved and not any("promotion-ids" in columns or "n_name" in columns for columns in moved)
    assert sum(KEY_HASH in columns for columns in moved) == 1  # staging sorts where lines were dealt to


def test_buckets_grow_with_the_source(spark, monkeypatch):
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert order_lines.line_buckets(spark, SMALL) == few
    monkeypatch.setattr(order_lines, "BUCKET_BYTES", order_lines._source_bytes(spark, SMALL) // (3 * few))
    assert order_lines.line_buckets(spark, SMALL) >= 3 * few


def test_rows_are_finished_where_they_were_shuffled_to(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "id % 7 AS k")
    wide = lambda df: df.withColumn("text", F.repeat(F.col("id").cast("string"), 3))
    for name, how in (("plain", {}), ("clustered", {"cluster_by": "k", "buckets": 3}), ("ordered", {"order_by": ["id"]}), ("parts", {"partition_by": "k"})):
        path = str(tmp_path / name)
        assert tables.overwrite(rows, path, finish=wide, measures={"m": F.col("text") == "111"}, **how) == 100
        found = tables.read(spark, path, wide(rows).schema)
        assert {(r["id"], r["k"], r["text"]) for r in found.collect()} == {(i, i % 7, str(i) * 3) for i in range(100)}
        assert tables.commit_of(spark, path).measures == {"m": 1}


def test_compressed_files_hold_the_same_rows(spark, tmp_path, raw_rows, monkeypatch):
    rows = raw_rows(*[{"index": str(i), "ASIN": f'"a{i}", boxed'} for i in range(50)])
    monkeypatch.setattr(csvfiles, "FILE_ROWS", 7)
    csvfiles.write_csv(rows, str(tmp_path / "z"), compressed=True)
    files = list((tmp_path / "z").glob("part-*"))
    assert len(files) >= 50 // 7 and all(f.name.endswith(".csv.gz") for f in files)
    found = csvfiles.read_text_csv(spark, str(tmp_path / "z"))
    assert found.exceptAll(rows).count() == rows.exceptAll(found).count() == 0 and found.count() == 50


def test_exact_duplicates_of_loose_rows_move_as_hashes(raw_rows):
    rows = raw_rows({"index": "1"}, {"index": "2"}, {"index": "3"}, {"index": "4", "ASIN": None}, {"index": "5", "ASIN": None}, {"index": "6", "ASIN": "<NULL>"})
    found = profile.exact_duplicates(rows)
    assert found.first()[0] == 3
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan(found))
    assert moved and not any("ASIN" in columns for columns in moved)


def test_keys_move_as_bytes_in_the_same_order(spark):
    rows = open_benchmark(spark, SMALL).fact()
    narrow = fact.packed(rows)
    assert {narrow.schema[c].dataType.simpleString() for c in ("sales_key", "geography_key")} == {"binary"}
    assert fact.unpacked(narrow).exceptAll(rows).count() == 0 and fact.unpacked(narrow).schema.simpleString() == rows.schema.simpleString()
    assert fact.unpacked(narrow.orderBy(*fact.PLACE_ORDER)).collect() == rows.orderBy(*fact.PLACE_ORDER).collect()


def shuffle_files(spark):
    return [f for top in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for f in glob.glob(f"{top}/**/shuffle_*", recursive=True)]


def test_shuffles_of_a_write_go_when_it_ends(spark, tmp_path):
    def new():
        for _ in range(50):  # executors remove them shortly after
            found = set(shuffle_files(spark)) - before
            if not found:
                break
            time.sleep(0.2)
        return found

    before = set(shuffle_files(spark))
    rows = spark.range(20_000).selectExpr("id % 97 AS k", "id").repartition(5, "k")
    for name, how in (("plain", {}), ("clustered", {"cluster_by": "k", "buckets": 3}), ("ordered", {"order_by": ["id"]}), ("steps", {"cluster_by": "k", "buckets": 3, "in_steps": True})):
        assert tables.overwrite(rows, str(tmp_path / name), **how) == 20_000
        assert not new(), name
        assert len([f for f in (tmp_path / name).iterdir() if f.is_dir()]) == 1  # rows that were laid aside are gone
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_failed_write_in_steps_leaves_nothing(spark, tmp_path):
    rows = spark.range(9).withColumn("x", F.when(F.col("id") == 7, F.raise_error(F.lit("seven")).cast("int")))
    for fails in (rows, spark.range(9).withColumn("x", F.lit(1))):
        with pytest.raises(Exception, match="seven|eight"):
            tables.overwrite(fails, str(tmp_path / "t"), in_steps=True, finish=lambda df: df.withColumn("x", F.raise_error(F.lit("eight")).cast("int")))
    assert not [f for f in tmp_path.glob("t/*") if f.is_dir() and list(f.glob("part-*"))]


def moved_columns(df):
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan(df))


def test_lines_move_without_what_one_number_tells(spark, monkeypatch):
    monkeypatch.setattr(order_lines, "SPREAD_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3k")
    try:
        moved = moved_columns(order_lines.clustered_order_lines(spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [x for x in moved if "l_orderkey" in x]
    assert len(lines) == 3 and not any(c in x for x in lines for c in ("l_linestatus", "l_returnflag", "o_custkey", "o_orderpriority"))
    assert "l_extendedprice" not in lines[-1] and "price" in lines[-1]



def test_lines_meet_products_without_their_address(spark):
    w = open_benchmark(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_lookup = fact.fact_by_lookup(w.staging(), w.dates(), w.products(), w.places(), w.statuses())
        to_products = [x for x in moved_columns(by_lookup) if "order_id" in x][-1]
        assert "ship_city" not in to_products and "at_" not in to_products
        assert by_lookup.exceptAll(w.fact()).count() == w.fact().exceptAll(by_lookup).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_move_without_keys_that_they_tell(spark):
    rows = fact.packed(open_benchmark(spark, SMALL).fact()).repartitionByRange(3, *fact.PLACE_ORDER)
    (moved,) = moved_columns(fact.unpacked(rows))
    assert "geography_key" in moved and "sales_key" not in moved and "product_key" not in moved
