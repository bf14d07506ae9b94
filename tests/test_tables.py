"""Stored tables: commits, clustering, writers at once."""

import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderloom.operators import checks, counting
from orderloom.operators.dedup import KEY_HASH
from orderloom.plans import profile, quality, staging
from orderloom.plans.benchmark import open_benchmark
from orderloom.plans.warehouse import Warehouse
from orderloom.sources import schemas, tables
from tests.conftest import SMALL, plan


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


def test_of_two_writers_one_wins_and_neither_loses_files(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.range(1).schema
    tables.overwrite(spark.range(3), path)
    slow = spark.range(7).where(F.expr("java_method('java.lang.Thread', 'sleep', 1500L) is null or id >= 0"))
    raised = []

    def write():
        try:
            tables.overwrite(slow, path)
        except tables.ConcurrentWrite as lost:
            raised.append(lost)

    writer = threading.Thread(target=write)
    writer.start()
    while len(folders(tmp_path / "t")) < 2:  # the other writer's files
        pass
    tables.overwrite(spark.range(5), path)
    assert writer.is_alive()
    assert tables.read(spark, path, schema).count() == 5
    writer.join()
    assert len(raised) == 1 and "another writer" in str(raised[0])
    assert tables.read(spark, path, schema).count() == 5
    assert tables.commit_of(spark, path).number == 2 and len(folders(tmp_path / "t")) == 2
    tables.overwrite(spark.range(9), path)
    assert tables.read(spark, path, schema).count() == 9


def test_only_one_of_many_makes_a_file(spark, tmp_path):
    path, made = str(tmp_path / "f.json"), []
    threads = [threading.Thread(target=lambda i=i: made.append(i) if tables._create(spark, path, str(i)) else None) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(made) == 1 and (tmp_path / "f.json").read_text() == str(made[0])
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["f.json"]


def test_readers_need_no_success_marker_and_see_no_unfinished_version(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    spark._jsc.hadoopConfiguration().set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        tables.overwrite(spark.range(4), path)
    finally:
        spark._jsc.hadoopConfiguration().unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
        spark.conf.unset("spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert not list((tmp_path / "t").rglob("_SUCCESS"))
    spark.range(100).write.parquet(f"{path}/v00000002-0123abcd")  # a writer that was killed before its commit
    assert tables.read(spark, path, spark.range(1).schema).count() == 4
    assert tables.vacuum(spark, path) == []
    assert tables.vacuum(spark, path, older_than_hours=-1) == ["v00000002-0123abcd"]
    assert len(folders(tmp_path / "t")) == 1 and tables.read(spark, path, spark.range(1).schema).count() == 4


def test_measures_are_counted_by_the_write(spark, tmp_path):
    path = str(tmp_path / "t")
    measures = {"odd": F.col("id") % 2 == 1, "missing": F.col("id").isNull(), "unknown": F.lit(None).cast("boolean")}
    assert tables.overwrite(spark.range(9), path, measures=measures) == 9
    commit = tables.commit_of(spark, path)
    assert commit.rows == 9 and commit.measures == {"odd": 4, "missing": 0, "unknown": 0} and commit.based_on == 0


def test_clustered_rows_are_grouped_in_place(spark, tmp_path):
    path = str(tmp_path / "it's clustered")
    rows = spark.range(1000).selectExpr("id % 37 AS key_hash", "cast(id AS string) AS `a name`")
    tables.overwrite(rows, path, cluster_by="key_hash", buckets=5)
    found = tables.read(spark, path, rows.schema)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, rows.collect()))
    grouped = found.groupBy("key_hash").count()
    assert "Exchange" not in plan(grouped) and grouped.count() == 37
    assert not [t.name for t in spark.catalog.listTables("default") if t.name.startswith("orderloom_")]
    assert tables.overwrite(found.where("key_hash < 3"), path, cluster_by="key_hash", buckets=3) == 82


def test_a_table_with_a_hot_bucket_is_read_as_plain_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "LARGE_BUCKET", 1000)
    path = str(tmp_path / "t")
    rows = spark.range(60_000).selectExpr("if(id % 10 > 0, 0, id) AS key_hash", "uuid() AS value")
    tables.overwrite(rows, path, cluster_by="key_hash", buckets=8)
    assert not tables.commit_of(spark, path).even
    grouped = tables.read(spark, path, rows.schema).groupBy("key_hash").count()
    assert "hashpartitioning" in plan(grouped) and grouped.where("key_hash = 0").first()[1] == 54_001
    even = str(tmp_path / "even")
    tables.overwrite(rows.withColumn("key_hash", F.xxhash64("value")), even, cluster_by="key_hash", buckets=8)
    assert tables.commit_of(spark, even).even


def exchanges(df):
    return [x for x in plan(df).split("\n\n")[0].split("\n") if "Exchange" in x]


def test_clustered_raw_lines_are_not_shuffled(spark):
    w = open_benchmark(spark, SMALL)
    many = staging.staged_lines(w.lines(), w.repeated_lines(), broadcast_rows=0)
    assert exchanges(many) == []
    assert exchanges(counting.repeated_tuples(w.lines(), ["Order ID", "SKU"], within=[KEY_HASH])) == []
    assert exchanges(checks.repeats(w.lines(), ["Order ID", "SKU"], nulls=True, within=[KEY_HASH])) == []
    # one row per task goes to the last sum
    for counted in (profile.duplicate_pairs(w.lines()), profile.exact_duplicates(w.lines(), w.repeated_lines(), 0)):
        assert len(exchanges(counted)) == 1 and "SinglePartition" in plan(counted)
        assert "hashpartitioning" not in plan(counted)
    assert "hashpartitioning" not in plan(quality.staging_count_mismatch(w.lines(), w.staging()))
    assert "hashpartitioning" in plan(profile.duplicate_pairs(w.raw()))


def test_clustered_staging_equals_brute_force(spark, tmp_path, raw_rows):
    rows = raw_rows(*[{"Order ID": f" o{i % 7}", "SKU": f"k{i % 3} ", "index": str(i), "Amount": None if i % 4 else str(i)} for i in range(200)])
    w = Warehouse(spark, str(tmp_path / "wh"), raw=lambda: rows, broadcast_rows=0, buckets=3)
    got = {(r["order_id"], r["sku"]): r["amount"] for r in w.staging().collect()}
    best = {}
    for i in range(200):
        key, rank = (f"o{i % 7}", f"k{i % 3}"), (i % 4 == 0, i)
        best[key] = max(best.get(key, rank), rank)
    assert got == {k: (i if priced else None) for k, (priced, i) in best.items()}
    assert w.raw().columns == schemas.RAW.names and tables.commit_of(spark, w.path("raw", "order_lines")).buckets == 3
