"""Session settings for local runs, and the package for Python workers; a cluster brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package; a cluster has it installed."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def local_session(app: str, cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
