"""Stored tables: full-refresh writes that switch when complete, typed reads, one namespace per layer."""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import NamedTuple
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOCAL_FOLDERS: dict[str, str] = {}
_VERSION = re.compile(r"v(\d{8})-[0-9a-f]{8}$")
_COMMIT = re.compile(r"_commit-(\d{8})\.json$")
_BUCKET = re.compile(r"_(\d{5})\.c\d+\.")
#: A bucket is uneven if it holds over so many bytes and so many times the mean: its rows are then shuffled, not read by one task.
LARGE_BUCKET, UNEVEN = 256 << 20, 4
#: Rows of a row group of a table that is stored in order.
GROUP_ROWS = 1_000_000
#: Of files: keys that are digests hardly shrink with Spark's default.
COMPRESSION = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only local mode, where driver and executors share one machine, may fall back
    to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    session = spark.sparkContext.applicationId
    if session not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[session] = tempfile.mkdtemp(prefix="orderloom-")
    return _LOCAL_FOLDERS[session]


class ConcurrentWrite(RuntimeError):
    """Another writer committed the version that this one was to become."""


class Commit(NamedTuple):
    """What a table's version is: its folder, rows, buckets if it is clustered, and what was counted while it was written."""

    number: int
    based_on: int
    folder: str
    rows: int
    clustered_by: str | None = None
    buckets: int | None = None
    even: bool = True
    measures: dict[str, int] = {}  # noqa: RUF012
    ordered_by: list[str] = []  # noqa: RUF012


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _entries(spark: SparkSession, path: str) -> list:
    place, files = _hadoop(spark, path)
    return list(files.listStatus(place)) if files.exists(place) else []


def _commits(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(named[1]) for x in _entries(spark, path) if (named := _COMMIT.match(x.getPath().getName())))


def _commit_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/_commit-{number:08d}.json"


def _read_commit(spark: SparkSession, path: str, number: int) -> Commit:
    place, files = _hadoop(spark, _commit_path(path, number))
    stream = files.open(place)
    try:
        return Commit(**json.loads(bytes(stream.readAllBytes())))
    finally:
        stream.close()


def commit_of(spark: SparkSession, path: str) -> Commit | None:
    """The latest version of the table at ``path``."""
    numbers = _commits(spark, path)
    return _read_commit(spark, path, numbers[-1]) if numbers else None


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a file with this content unless there is one, in one step; whether it was made.

    The content goes to a file of another name first. On local disks that file gets the
    wanted name as a second link, which fails if the name is taken. Elsewhere it is renamed without
    overwriting, which HDFS and its like do in one step.
    """
    place, files = _hadoop(spark, path)
    if files.getUri().getScheme() == "file":
        wanted = place.toUri().getPath()
        given = f"{wanted}.{uuid4().hex}"
        with open(given, "x") as out:
            out.write(text)
        try:
            os.link(given, wanted)
        except FileExistsError:
            return False
        finally:
            os.unlink(given)
        return True
    given, _ = _hadoop(spark, f"{path}.{uuid4().hex}")
    out = files.create(given, False)
    out.write(text.encode())
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark._sc._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    try:
        spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration()).rename(given, place, how)
    except Py4JJavaError as failed:
        files.delete(given, False)
        if files.exists(place):
            return False
        raise failed
    return True


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the latest version of the table at ``path``."""
    commit = commit_of(spark, path)
    return None if commit is None else f"{path.rstrip('/')}/{commit.folder}"


def _drop(spark: SparkSession, folder: str) -> None:
    place, files = _hadoop(spark, folder)
    files.delete(place, True)


def _even_buckets(spark: SparkSession, folder: str, buckets: int) -> bool:
    """Whether no bucket holds much more than its share, by the sizes of its files."""
    size = [0] * buckets
    for entry in _entries(spark, folder):
        if named := _BUCKET.search(entry.getPath().getName()):
            size[int(named[1])] += entry.getLen()
    return max(size) <= max(LARGE_BUCKET, UNEVEN * sum(size) / buckets)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query that runs inside go when it ends; else they stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _put(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.option("compression", COMPRESSION).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def overwrite(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    cluster_by: str | None = None,
    buckets: int | None = None,
    measures: Mapping[str, Column] | None = None,
    order_by: Sequence[str] = (),
    rows_per_group: int = GROUP_ROWS,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    in_steps: bool = False,
) -> int:
    """Replace the table at ``path`` and return the rows written.

    The rows go to a new version of the table, which readers see once its commit
    record is made: one file per version, numbered one beyond the version the
    writer started from, that only one writer can make. A failed write leaves the
    old rows in place, and a table can be rewritten from its own rows. Of two writers
    at once the second raises :class:`ConcurrentWrite` and removes its own files only. The
    version before stays for readers that opened it; older committed ones are removed.
    Files of writers that were killed stay until :func:`vacuum`.

    The rows, and those for which each condition of ``measures`` holds, are counted
    during the write, so they cost no second scan; :func:`commit_of` has them. With
    ``partition_by``, Spark first rebalances the rows by that column: small
    partitions are merged and a hot value is split over several files. With
    ``cluster_by``, rows of equal values of that column are in the same bucket, and
    joins, groups and windows on it need no exchange; the session catalog holds a table of a
    name of its own for a moment, both to write and to read it. With ``order_by``, files and
    their row groups follow that order, so that a filter on it skips most of them;
    Spark samples the rows first to find even ranges. ``finish`` makes the stored rows, one of each, where
    they were shuffled to, so that less may be shuffled; columns named here are in ``df``, and stay.
    Shuffle files go when the write ends. With ``in_steps``, for a ``df`` that shuffles much itself, its rows are stored for a
    moment before they are shuffled for the table, so that no two of these take room at once.
    """
    with shuffles_removed(df.sparkSession):
        if not in_steps:
            return _overwrite(df, path, partition_by, cluster_by, buckets, measures, order_by, rows_per_group, finish)
        # a name that vacuum knows, in case the writer is killed
        aside = f"{path.rstrip('/')}/v{0:08d}-{uuid4().hex[:8]}"
        try:
            return _overwrite(_put(df, aside), path, partition_by, cluster_by, buckets, measures, order_by, rows_per_group, finish)
        finally:
            _drop(df.sparkSession, aside)


def _overwrite(
    df: DataFrame,
    path: str,
    partition_by: str | None,
    cluster_by: str | None,
    buckets: int | None,
    measures: Mapping[str, Column] | None,
    order_by: Sequence[str],
    rows_per_group: int,
    finish: Callable[[DataFrame], DataFrame] | None,
) -> int:
    spark = df.sparkSession
    numbers = _commits(spark, path)
    based_on = numbers[-1] if numbers else 0
    named = f"v{based_on + 1:08d}-{uuid4().hex[:8]}"
    folder = f"{path.rstrip('/')}/{named}"
    written = Observation()
    finish = finish or (lambda rows: rows)
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(f"m{i}") for i, c in enumerate((measures or {}).values())]]
    if cluster_by is not None:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = finish(df.hint("rebalance", buckets, F.col(cluster_by))).observe(written, *counts).write.option("compression", COMPRESSION)
        table = f"spark_catalog.default.orderloom_{uuid4().hex}"
        # a table of its own name for a moment: the files stay
        writer.bucketBy(buckets, cluster_by).option("path", folder).format("parquet").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")
    else:
        buckets = None
        rows = df if partition_by is None else df.hint("rebalance", F.col(partition_by))
        if order_by:
            rows = df.repartitionByRange(*order_by).sortWithinPartitions(*([partition_by] if partition_by else []), *order_by)
        writer = finish(rows).observe(written, *counts).write.option("compression", COMPRESSION)
        if order_by:
            writer = writer.option("parquet.block.row.count.limit", rows_per_group)
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        writer.parquet(folder)
    found = written.get
    even = buckets is None or _even_buckets(spark, folder, buckets)
    measured = {name: found[f"m{i}"] for i, name in enumerate(measures or {})}
    commit = Commit(based_on + 1, based_on, named, found["rows"], cluster_by, buckets, even, measured, list(order_by))
    # a writer that was overtaken twice finds its number free only if commits were removed, which nobody does
    if not _create(spark, _commit_path(path, commit.number), json.dumps(commit._asdict())):
        _drop(spark, folder)
        raise ConcurrentWrite(f"version {commit.number} of {path} was written by another writer meanwhile")
    for old in numbers[:-1]:
        _drop(spark, f"{path.rstrip('/')}/{_read_commit(spark, path, old).folder}")
    return commit.rows


def vacuum(spark: SparkSession, path: str, older_than_hours: float = 24) -> list[str]:
    """Removes version folders that no commit names and that are older than any running write; returns their names."""
    known = {_read_commit(spark, path, n).folder for n in _commits(spark, path)}
    limit = (time.time() - 3600 * older_than_hours) * 1000
    found = []
    for entry in _entries(spark, path):
        name = entry.getPath().getName()
        if _VERSION.match(name) and name not in known and entry.getModificationTime() < limit:
            _drop(spark, f"{path.rstrip('/')}/{name}")
            found.append(name)
    return found


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table's latest version. One that is clustered in even buckets is read by them."""
    commit = commit_of(spark, path)
    if commit is None:
        raise ValueError(f"no complete table at {path}")
    folder = f"{path.rstrip('/')}/{commit.folder}"
    if commit.buckets is None or not commit.even:
        return spark.read.schema(schema).parquet(folder)
    table = f"spark_catalog.default.orderloom_{uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{commit.clustered_by}`) INTO {commit.buckets} BUCKETS LOCATION '{place}'")
    try:
        return spark.table(table)  # the plan holds files and buckets, so the name may go
    finally:
        spark.sql(f"DROP TABLE {table}")


def publish(spark: SparkSession, base: str, tables: dict[str, dict[str, tuple[str, list[str]]]], prefix: str = "") -> None:
    """Make stored tables queryable by name: ``{layer: {table: (path, columns)}}``.

    Each layer becomes a database called exactly like the layer, after ``prefix``.
    The names are views on the current version of each table; publish again after
    a rebuild.
    """
    for layer, members in tables.items():
        database = f"`{prefix}{layer}`"
        place = f"{base}/databases/{prefix}{layer}".replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{place}'")
        for name, (path, columns) in members.items():
            listed = ", ".join(f"`{c}`" for c in columns)
            folder = (current(spark, path) or path).replace("`", "``")
            spark.sql(f"CREATE OR REPLACE VIEW {database}.`{name}` AS SELECT {listed} FROM parquet.`{folder}`")


def unpublish(spark: SparkSession, layers: list[str], prefix: str = "") -> None:
    """Drop the databases that :func:`publish` made; the tables stay."""
    for layer in layers:
        spark.sql(f"DROP DATABASE IF EXISTS `{prefix}{layer}` CASCADE")
