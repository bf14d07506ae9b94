"""Rows beside the row that follows them in key order, with one shuffle of the texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import ship, texts

#: Buckets of consecutive ids for each shuffle partition, so that hashing them spreads evenly.
BUCKETS_PER_PARTITION = 4
LEAST = -(1 << 63)


def with_next(docs: DataFrame, work: Callable[[list, list[str], list[str]], pa.RecordBatch], schema: str, batch_rows: int = 256) -> DataFrame:
    """Calls ``work(ids, texts, next texts)`` for runs of documents in ascending id order; rows without id come first.

    The text after the last is the first. Rows that share an id follow each other in
    text order. The ids are cut into buckets of about equal size; each bucket also
    gets the first text of the next one, so no window over all rows is needed. Only
    the buckets' first ids, a fixed number per shuffle partition, reach the driver; a
    row's bucket is found by bisection among them.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(LEAST)).alias("key"), "doc_id", "text")
    n = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_range = rows.select("key").repartitionByRange(n, "key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("first"))
    firsts = sorted(r["first"] for r in by_range.collect())
    if not firsts:
        return spark.createDataFrame([], schema)

    cuts = np.array(firsts, np.int64)

    @F.pandas_udf("int")
    def place(key):
        """Twice the number of the key's bucket, and one more if the key is the bucket's first."""
        own = key.to_numpy()
        at = np.searchsorted(cuts, own, "right") - 1
        return type(key)((2 * at + (cuts[at] == own)).astype(np.int32))

    placed = rows.withColumn("place", place("key"))
    bucket = F.shiftright("place", 1)
    own = placed.select(bucket.alias("bucket"), "key", F.lit(False).alias("tail"), "doc_id", "text")
    head = placed.where(F.col("place") % 2 == 1).groupBy("key", "place").agg(F.min("text").alias("text"))
    head = head.select(
        F.when(bucket > 0, bucket - 1).otherwise(len(firsts) - 1).alias("bucket"), "key", F.lit(True).alias("tail"), F.lit(None).cast("long").alias("doc_id"), "text"
    )
    parts = max(1, n // BUCKETS_PER_PARTITION)
    dealt = own.unionByName(head).repartition(parts, "bucket").sortWithinPartitions("bucket", "tail", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: tuple | None = None
        for whole in batches:
            for at in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(at, batch_rows)
                rows = list(zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True))
                if left is not None:
                    rows.insert(0, left)
                left = rows[-1]
                pairs = [(a[2], a[3], b[3]) for a, b in zip(rows, rows[1:], strict=False) if not a[1]]
                if pairs:
                    yield work(*map(list, zip(*pairs, strict=True)))

    return dealt.mapInArrow(run, schema)
