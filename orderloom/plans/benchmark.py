"""The warehouse of one benchmark folder, opened once per session."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orderloom.plans.warehouse import Warehouse
from orderloom.sources.order_lines import benchmark_regions, is_large, joined_order_lines, line_buckets, rendered_lines
from orderloom.sources.tables import shared_folder

_OPENED: dict[tuple[str, str, str], Warehouse] = {}
_SOURCES = ["lineitem", "orders", "customer", "nation", "region", "part"]


def scratch(warehouse: Warehouse, name: str) -> str:
    """Folder for a table that one query writes and reads back: the same for each call on the same input."""
    return f"{warehouse.base}/scratch/{name}"


def _fingerprint(spark: SparkSession, folder: str) -> str:
    """Digest of the source files' paths, sizes and times, from a listing of them."""
    paths = [f"{folder.rstrip('/')}/{name}.parquet" for name in _SOURCES]
    files = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    per_file = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    found = files.agg(F.sum(per_file).alias("digest"), F.count(F.lit(1)).alias("files")).first()
    return f"{found['files']}:{found['digest']}"


def open_benchmark(spark: SparkSession, folder: str) -> Warehouse:
    """Warehouse on the tables in ``folder``; rebuilt when a source file changes."""
    key = (spark.sparkContext.applicationId, folder, _fingerprint(spark, folder))
    if key not in _OPENED:
        _OPENED[key] = Warehouse(
            spark,
            f"{shared_folder(spark)}/orderloom/warehouse-{uuid4().hex}",
            raw=lambda: joined_order_lines(spark, folder),
            regions=lambda: benchmark_regions(spark),
            calendar=None,
            buckets=line_buckets(spark, folder),
            render=lambda lines: rendered_lines(spark, folder, lines),
            raw_in_steps=is_large(spark, folder),
        )
    return _OPENED[key]
