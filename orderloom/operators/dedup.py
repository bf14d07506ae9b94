"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.functions.text import column

KEY_HASH = "key_hash"
# Key hashes sent to every executor at most: 16 bytes each in a hash table of longs, about 64 MB.
HASH_ROWS = 4_000_000


def clustering(df: DataFrame) -> list[str]:
    """The columns that rows are stored by, of those that carry the hash of their key."""
    return [KEY_HASH] if KEY_HASH in df.columns else []


def key_hash(keys: Sequence[Column]) -> Column:
    return F.xxhash64(*keys).alias(KEY_HASH)


def repeated_key_hashes(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Hashes of the keys that occur more than once.

    Two different keys may share a hash, so a few unique keys can be among them;
    a repeated key is never missing. Eight bytes per row are counted, before the
    shuffle and after it; rows stored by the hash are counted in place.
    """
    hashes = df.select(KEY_HASH if clustering(df) else key_hash(keys)).groupBy(KEY_HASH).agg(F.count(F.lit(1)).alias("rows"))
    return hashes.where(F.col("rows") > 1).select(KEY_HASH)


def with_repeated_key(
    df: DataFrame, keys: Sequence[Column], repeated: DataFrame, present: bool = True, broadcast_rows: int = HASH_ROWS
) -> DataFrame:
    """Rows whose key hash is in ``repeated``, or those whose is not.

    ``repeated`` is broadcast if a count shows that it fits; beyond that the join
    is left to Spark.
    """
    fits = repeated.limit(broadcast_rows + 1).count() <= broadcast_rows
    hashes = repeated.select(F.col(KEY_HASH).alias("_repeated"))
    hashes = F.broadcast(hashes) if fits else hashes
    own = F.col(KEY_HASH) if clustering(df) else F.xxhash64(*keys)
    return df.join(hashes, own == F.col("_repeated"), "left_semi" if present else "left_anti")


def keep_first(
    df: DataFrame,
    keys: Sequence[Column],
    order: Sequence[Column],
    repeated: DataFrame | None = None,
    broadcast_rows: int = HASH_ROWS,
) -> DataFrame:
    """First row per key by ``order``; remaining ties go by the columns, left to right.

    Written as ``row_number() = 1`` so that Spark puts a group limit before the
    shuffle: each map task sends at most one row per key, however hot the key.

    With the table ``repeated`` from :func:`repeated_key_hashes`, only rows of
    repeated keys are sorted and shuffled; all others pass through in place. If it
    is too large to broadcast, few rows may be spared that way, and the group
    limit alone does the work: one exchange, of one row per key and task. Rows that
    are stored by the hash of their key are sorted where they are, without an exchange.
    """
    ties = [column(c).asc_nulls_last() for c in df.columns]
    by_key = Window.partitionBy(*clustering(df), *keys).orderBy(*order, *ties)

    def first(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_rank", F.row_number().over(by_key)).where(F.col("_rank") == 1).drop("_rank")

    if repeated is None or repeated.limit(broadcast_rows + 1).count() > broadcast_rows:
        return first(df)
    found = first(with_repeated_key(df, keys, repeated, True, broadcast_rows))
    if clustering(df):
        # few rows: a file per bucket of them would weigh more in the splits of later readers than all other rows
        found = found.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)
    return with_repeated_key(df, keys, repeated, False, broadcast_rows).unionByName(found)


def collapse_max(df: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """One row per key with the maximum of each attribute, taken independently.

    ``max`` of a string sorts its input. Distinct tuples are found first, by
    hashing, so that only the few tuples left per key are sorted.
    """
    tuples = df.select(*map(column, [*keys, *attributes])).distinct()
    return tuples.groupBy(*map(column, keys)).agg(*[F.max(column(a)).alias(a) for a in attributes])
