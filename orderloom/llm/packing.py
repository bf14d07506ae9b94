"""Packing documents into sequences as a cutting-stock problem.

A document of n tokens fills ``n // length`` sequences by itself; its remainder, if
any, is one uncut item. The items' histogram has at most length-1 rows whatever the
input, and so goes to the driver. There a linear program over patterns (how many items
of which lengths share a sequence) is solved by column generation: its dual prices
value the lengths, a knapsack over the sequence length finds the pattern worth most,
and the pattern enters the basis until none is worth more than a sequence. Patterns
are used a whole number of times, items left over are placed by first fit decreasing.

The result, counts of patterns, is a table of a few rows per length. Items are ranked
within their length, hot lengths in several strands, and each finds its pattern, the
sequence and its place in it by its rank: a join with that table, no search per item.

Null texts are empty and have the end id only. A very long text fills sequences by
itself. Repeated rows are packed each. Items of equal length are interchangeable: ties
are ranked by row. Every id is in exactly one piece. Extra columns are ignored; an empty
table has no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm import token_ids
from orderloom.llm.common import ship, stored

LENGTH = 1024
#: Pivots of the linear program, at most; it also ends within this share of the lower bound, or one sequence.
PIVOTS, GAP = 3_000, 1e-3
#: Step of lengths in the linear program; rounding up costs an item less than one step.
GRAIN = 2
#: Patterns that one knapsack adds, and that are kept of the earlier ones.
PER_ROUND, POOL = 40, 2_000


def _knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int, wanted: int) -> list[np.ndarray]:
    """Counts per length of patterns of high value: for each of some lengths the best pattern that has it, the best of all first."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    usable = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        n = usable[room]
        best[room] = best[room - 1]
        if n:
            values = best[room - lengths[:n]] + prices[:n]
            k = int(values.argmax())
            if values[k] > best[room] + 1e-12:
                best[room], choice[room] = values[k], k
    out = []
    for lead in np.argsort(-(prices + best[capacity - lengths]), kind="stable")[:wanted].tolist():
        counts, room = np.zeros(len(lengths), np.int64), capacity - int(lengths[lead])
        counts[lead] = 1
        while room > 0:
            if choice[room] < 0:
                room -= 1
            else:
                counts[choice[room]] += 1
                room -= int(lengths[choice[room]])
        out.append(counts)
    return out


def _first_fit(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns of first fit decreasing and how often each is used."""
    left, out = demand.astype(np.int64).copy(), []
    while left.any():
        column, room = np.zeros(len(lengths), np.int64), capacity
        for k in np.flatnonzero(left)[::-1].tolist():
            column[k] = min(left[k], room // lengths[k])
            room -= int(column[k] * lengths[k])
        held = column > 0
        times = int((left[held] // column[held]).min())
        out.append((column, times))
        left -= times * column
    return out


def _price(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Basic patterns (columns) and their amounts in the linear program's solution."""
    n = len(lengths)
    columns = np.diag(capacity // lengths).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    amounts = inverse @ demand
    bound = float(lengths @ demand) / capacity
    pool = np.array([x for x, _ in _first_fit(lengths, demand, capacity)], float).T
    for _ in range(PIVOTS):
        if amounts.sum() <= bound + max(1.0, bound * GAP):
            break
        prices = inverse.sum(axis=0)
        values = prices @ pool
        best = int(values.argmax())
        if values[best] <= 1 + 1e-7:
            fresh = np.array(_knapsack(prices, lengths, capacity, PER_ROUND), float).T
            if prices @ fresh[:, 0] <= 1 + 1e-7:
                break
            pool = np.concatenate((pool[:, np.argsort(-values)[:POOL]], fresh), axis=1)
            continue
        column = pool[:, best]
        change = inverse @ column
        rows = np.flatnonzero(change > 1e-9)
        out = rows[int((amounts[rows] / change[rows]).argmin())]
        step = amounts[out] / change[out]
        amounts = np.maximum(amounts - step * change, 0)
        amounts[out] = step
        pivot = inverse[out] / change[out]
        inverse -= np.outer(change, pivot)
        inverse[out] = pivot
        columns[:, out] = column
    return columns, amounts


def _rounded(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """The linear program's patterns a whole number of times, and first fit for what is left."""
    columns, amounts = _price(lengths, demand, capacity)
    left, out = demand.astype(np.int64).copy(), []
    for k in np.argsort(-amounts, kind="stable"):
        column = columns[:, k].astype(np.int64)
        held = column > 0
        times = min(int(amounts[k] + 1e-6), int((left[held] // column[held]).min()))
        if times > 0:
            out.append((column, times))
            left -= times * column
    return out + _first_fit(lengths, left, capacity)


def patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int = LENGTH, grain: int = GRAIN) -> list[tuple[np.ndarray, int]]:
    """Patterns (counts per length) and how often each is used; together they hold every item exactly once.

    The linear program counts lengths in steps of ``grain``, rounded up; then each
    pattern takes the step's real lengths in turn, the longest first.
    """
    if len(lengths) == 0:
        return []
    steps, of = np.unique(-(-lengths // grain), return_inverse=True)
    members = [np.flatnonzero(of == k)[::-1].tolist() for k in range(len(steps))]
    left = demand.astype(np.int64).copy()
    out = []
    for column, times in _rounded(steps, np.bincount(of, demand).astype(np.int64), capacity // grain):
        wanted = [(k, int(column[k])) for k in np.flatnonzero(column)]
        while times > 0:
            exact, together = np.zeros(len(lengths), np.int64), times
            for k, each in wanted:
                while members[k] and left[members[k][0]] == 0:
                    members[k].pop(0)
                if left[members[k][0]] >= each:
                    exact[members[k][0]] = each
                    together = min(together, int(left[members[k][0]]) // each)
                else:  # the last of a length go with the next length
                    together = 1
                    for i in members[k]:
                        exact[i] = min(each, left[i])
                        each -= int(exact[i])
            out.append((exact, together))
            left -= together * exact
            times -= together
    return out


def _strand_sums(rows: DataFrame, keys: list[str], amount: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over the rows before, within ``keys``; each key is worked in strands."""
    spark = rows.sparkSession
    strands = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("strand", F.pmod(F.xxhash64("row"), F.lit(strands)))
    totals = dealt.groupBy("strand", *keys).agg(F.sum(amount).alias("total"))
    across = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("strand").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("strand", *keys, F.coalesce(F.sum("total").over(across), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("strand", *keys).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumn("own", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return own.join(totals, ["strand", *keys]).withColumn(name, F.col("own") + F.col("earlier")).drop("strand", "own", "earlier")


def pack(sizes: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pieces (row, start, length, sequence_id, offset) of rows of ``sizes`` (row long, tokens long > 0)."""
    spark = sizes.sparkSession
    sized = sizes.select("row", "tokens", F.expr(f"tokens div {length}").alias("full"), F.expr(f"tokens % {length}").alias("item"))
    histogram = sized.where("item > 0").groupBy("item").count().orderBy("item").toPandas()  # fewer than ``length`` rows
    lengths = histogram["item"].to_numpy(np.int64)
    table, first, used = [], 0, np.zeros(len(lengths), np.int64)
    for column, times in patterns(lengths, histogram["count"].to_numpy(np.int64), length):
        offset = 0
        for k in np.flatnonzero(column)[::-1].tolist():
            each = int(column[k])
            table.append((int(lengths[k]), int(used[k]), int(used[k] + each * times), first, each, offset))
            used[k] += each * times
            offset += each * int(lengths[k])
        first += times
    places = spark.createDataFrame(table, "size long, low long, high long, first long, each long, base long")
    # a few rows per length; the histogram bounds them
    items = _strand_sums(sized.where("item > 0").withColumn("one", F.lit(1)), ["item"], "one", "rank")
    at = F.col("rank") - F.col("low")
    items = items.join(F.broadcast(places), (F.col("item") == F.col("size")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).select(
        "row",
        (F.col("full") * length).alias("start"),
        F.col("item").alias("length"),
        (F.col("first") + F.floor(at / F.col("each"))).alias("sequence_id"),
        (F.col("base") + at % F.col("each") * F.col("item")).alias("offset"),
    )
    whole = _strand_sums(sized.where("full > 0"), [], "full", "before")
    whole = whole.select("row", "before", F.posexplode(F.sequence(F.lit(1).cast("long"), "full"))).select(
        "row", (F.col("pos").cast("long") * length).alias("start"), F.lit(length).cast("long").alias("length"),
        (F.col("before") + F.col("pos") + first).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return items.unionByName(whole)


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """(row, doc_id, ids binary): little-endian 32-bit ids of each whole text, the end id included."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in token_ids.runs(batches, path):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], ["row", "doc_id", "ids"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    return rows.mapInArrow(run, "row long, doc_id long, ids binary")


def sequences(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids binary), for writing them out."""
    rows = stored(tokenized(docs, path), "ids")
    pieces = pack(rows.select("row", F.expr("octet_length(ids) div 4").cast("long").alias("tokens")), length)
    cut = pieces.join(rows, "row").selectExpr("sequence_id", "offset", "substring(ids, cast(4 * start + 1 as int), cast(4 * length as int)) AS part")
    return cut.groupBy("sequence_id").agg(F.expr("array_sort(collect_list(struct(offset, part)))").alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.part))").alias("ids")
    )


def packed(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of the packed documents."""
    crcs = f"transform(sequence(0, (octet_length(ids) - 1) div {4 * length}), k -> crc32(substring(ids, {4 * length} * k + 1, {4 * length})))"
    rows = tokenized(docs, path).selectExpr("row", "doc_id", "cast(octet_length(ids) div 4 as long) AS tokens", f"{crcs} AS crcs")
    rows = stored(rows, "sizes")
    pieces = pack(rows.select("row", "tokens"), length).join(rows, "row")
    return pieces.selectExpr("doc_id", "start", "length", f"crcs[cast(start div {length} as int)] AS ids_crc32", "tokens AS doc_tokens", "sequence_id", "offset")
