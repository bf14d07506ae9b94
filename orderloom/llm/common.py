"""Shared helpers: column clean-up, stored intermediates, hashed words of whole texts.

Words are runs of bytes other than space and \\t..\\r, with A-Z lower-cased. Both
rules are ASCII-only, so they hold on UTF-8 bytes and a batch of texts is cut and
hashed with a handful of array operations instead of one Python step per word.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.sources.tables import shared_folder

#: Bytes of text that are hashed at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18
#: Share of all rows (one in so many) from which a class is too large to be dealt by its key.
LARGE = 1_000

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package; a cluster has it installed."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


#: Folders made since each of the :func:`scratch` blocks that are open began.
_MADE: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    path = f"{shared_folder(spark)}/llm/{name}-{uuid4().hex}"
    for made in _MADE:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession, *keep: str) -> Iterator[None]:
    """Removes the intermediate folders that the block made when it ends, but for those in ``keep``.

    What the block returns must have been written by then: operators return frames
    that still read their intermediates.
    """
    made: list[str] = []
    _MADE.append(made)
    try:
        yield
    finally:
        _MADE.remove(made)
        for path in made:
            if path not in keep:
                place = spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """Bounds the batches that tasks hand to Python, for jobs that run inside."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, n_bytes)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id long, text string) of any table with these columns; null texts are empty, other columns go."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def joined_classes(rows: DataFrame, classes: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the columns of ``classes``, which has one row per ``key`` and the number of its rows in ``size``; a left join.

    Classes of more than one in ``LARGE`` of all rows can't be more than ``LARGE``: these
    are broadcast. Rows they match take part in the shuffle under keys of their own, so no task gets
    a large class. ``classes`` is read three times, so it must be stored rows.
    """
    others = [c for c in classes.columns if c != key]
    total = classes.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) * LARGE > total
    few = classes.where(large).select(key, F.struct(*others).alias("__large"))
    rest = classes.where(~large).select(key, F.struct(*others).alias("__small"), F.lit(0).alias("__strand"))
    spread = F.when(F.col("__large").isNull(), 0).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))).cast("int")
    found = rows.join(F.broadcast(few), key, "left").withColumn("__strand", spread).join(rest, [key, "__strand"], "left")
    return found.select(*rows.columns, *[F.coalesce(F.col("__large")[c], F.col("__small")[c]).alias(c) for c in others])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_table(lower: bool) -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    values = mix((codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    separator = np.zeros(256, bool)
    separator[[32, *range(9, 14)]] = True
    values[separator] = 0
    return values, ~separator


_VALUES, _IN_WORD = _byte_table(lower=True)
_STEP = 0x5851F42D4C957F2D
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, for n positions at least."""
    if len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.multiply.accumulate(factors)
    return _POWERS


def slices(array: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about SLICE_BYTES: (index of the first, bytes, offsets of the texts in them)."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if len(array) == 0:
        return
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(array):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(array))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of every word of consecutive texts, the texts' offsets among them, first byte and length of each."""
    inside = _IN_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    bounds = np.searchsorted(starts, offsets)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), bounds, starts, starts
    power, inverse = _powers(len(data))
    sums = np.add.reduceat(_VALUES[data] * power[: len(data)], starts)
    lengths = np.add.reduceat(inside, starts, dtype=np.int64)
    return mix(sums * inverse[starts]), bounds, starts, lengths


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of consecutive texts, and the texts' offsets among the words."""
    return word_spans(data, offsets)[:2]


def texts_of_batch(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column.fill_null("") if column.null_count else column


def sampled(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows with the smallest hashes of ``key``, never more; all rows of a smaller table.

    The hash alone thins the table out before anything is sorted, so each task hands on
    its share of the sample and no more.
    """
    total = df.count()
    hashed = F.xxhash64(key)
    if total > rows:
        df = df.where(F.pmod(hashed, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * rows / total + 20 / total)))
    return df.orderBy(hashed).limit(rows)
