"""Values that occur more than once, found by a counting sketch before anything is shuffled.

Every row's key hash has a slot among many, which fall into pieces. A task hands on the slots
that it hit, as their distances, two bytes or so each, and those that it hit twice. A piece is merged by one task in
a sketch of two bits per slot, "hit" and "hit twice", where a slot that was handed on twice is hit
twice. A key alone in its slot occurs once, so only rows of slots that were hit
twice can be repeats, and only these go on to an exact count. On a table of unique keys
that is a few per cent of the rows at most, in place of a hash of every row; a slot shared by
different keys costs a row more, never a result.

Slots are so many that different keys share few of them, whatever the rows; what is sent to tasks are the
slots that were hit twice, 32 MB at most. A piece that has more than its share of these, as where most
keys repeat, lets all its rows through, and their count is the plain one. Rows go through Python in Arrow batches of
one number each, twice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.text import column
from orderloom.operators.counting import tuple_hashes
from orderloom.session import ship

#: Slots at most, slots for each row below that, and slots of a piece, which one task merges at a time.
MOST_SLOTS, SLOTS_PER_ROW, PIECE = 1 << 42, 32, 1 << 26
#: Slots hit twice that are sent to tasks at most, eight bytes each; hashes that a task holds before it hands them on.
MOST_TWICE, HELD = 4 << 20, 4 << 20


def _set(bits: np.ndarray, slots: np.ndarray) -> None:
    """Sets the bits of slots that are sorted and different."""
    if len(slots):
        at = slots >> 3
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        bits[at[starts]] |= np.bitwise_or.reduceat((1 << (slots & 7)).astype(np.uint8), starts)


def _has(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0


class Sketch:
    """Two bits for each of some slots."""

    def __init__(self, slots: int) -> None:
        self.hit, self.twice = np.zeros(slots >> 3, np.uint8), np.zeros(slots >> 3, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        slots, times = np.unique(hashes & (len(self.hit) * 8 - 1), return_counts=True)
        _set(self.twice, slots[(times > 1) | _has(self.hit, slots)])
        _set(self.hit, slots)

    def merge(self, hit: np.ndarray, twice: np.ndarray) -> None:
        self.twice |= twice | (self.hit & hit)
        self.hit |= hit


def _distances(slots: np.ndarray) -> bytes:
    """Ascending slots of a piece as their distances, the lowest bytes of all first, so that the empty high ones compress."""
    return np.diff(slots, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _slots(distances: bytes) -> np.ndarray:
    return np.frombuffer(distances, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1).cumsum(dtype=np.int64)


def _handed_on(slots: int, width: int, hashes: list[np.ndarray]) -> pa.RecordBatch:
    """(piece, hit, again): by piece, the slots of some hashes and those that several of them have."""
    hit, times = np.unique(np.concatenate(hashes) & (slots - 1), return_counts=True)
    pieces, starts = np.unique(hit // width, return_index=True)
    ends = np.append(starts[1:], len(hit))
    own = [(hit[a:b] - piece * width, times[a:b] > 1) for piece, a, b in zip(pieces.tolist(), starts.tolist(), ends.tolist(), strict=True)]
    columns = [pa.array(pieces, pa.int32()), pa.array([_distances(x) for x, _ in own], pa.binary()), pa.array([_distances(x[y]) for x, y in own], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["piece", "hit", "again"])


def _sketched(slots: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            if sum(map(len, held)) >= HELD:
                yield _handed_on(slots, width, held)
                held = []
        if held:
            yield _handed_on(slots, width, held)

    return run


def _set_bits(bits: np.ndarray) -> np.ndarray:
    """The slots whose bits are set, ascending."""
    at = np.flatnonzero(bits)
    where, which = np.nonzero(np.unpackbits(bits[at, None], axis=1, bitorder="little"))
    return at[where] * 8 + which


def _merged(width: int, most: int):
    """Pieces that arrive in order: the slots of each that were hit twice, or NULL if these are more than ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sketch = None, None

        def finished() -> Iterator[pa.RecordBatch]:
            if sketch is not None:
                found = _set_bits(sketch.twice)
                columns = [pa.array([now], pa.int32()), pa.array([_distances(found) if len(found) <= most else None], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["piece", "twice"])

        for batch in batches:
            for piece, hit, again in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if piece != now:
                    yield from finished()
                    now, sketch = piece, Sketch(width)
                sketch.add(_slots(hit))
                _set(sketch.twice, _slots(again))
        yield from finished()

    return run


def slots_for(rows: int) -> int:
    """A power of two of slots, so that few of so many different keys share one, and a quarter of ``MOST_TWICE`` slots are shared at most."""
    wanted = min(MOST_SLOTS, max(max(1, rows) * SLOTS_PER_ROW, 2 * rows * rows // MOST_TWICE))
    return max(8, 1 << (wanted - 1).bit_length())


AGAIN = "_again"


def marked(df: DataFrame, keys: Sequence[Column], slots: int | None = None) -> DataFrame:
    """``df`` with a column ``_again``: false only where the row's key occurs once.

    The sketch is made when this is called. Without ``slots`` the rows are counted first.
    """
    spark = df.sparkSession
    ship(spark)
    slots = slots_for(df.count()) if slots is None else slots
    key, width = F.xxhash64(*keys), min(slots, PIECE)
    number = slots // width
    pieces = df.select(key.alias("key")).mapInArrow(_sketched(slots, width), "piece int, hit binary, again binary")
    pieces = pieces.repartition("piece").sortWithinPartitions("piece")
    # twice the share of a piece at most, so a bounded size; one partition, as each is a job of its own here
    merged = pieces.mapInArrow(_merged(width, 2 * MOST_TWICE // number), "piece int, twice binary").repartition(1)
    merged = sorted(merged.toLocalIterator(), key=lambda row: row["piece"])
    whole = np.zeros(number, bool)
    whole[[row["piece"] for row in merged if row["twice"] is None]] = True
    found = [row["piece"] * width + _slots(row["twice"]) for row in merged if row["twice"]]
    known = spark.sparkContext.broadcast((whole, np.concatenate([np.zeros(0, np.int64), *found])))

    @F.arrow_udf("boolean")
    def twice(hashes: pa.Array) -> pa.Array:
        whole, found = known.value
        own = hashes.to_numpy() & (slots - 1)
        again = whole[own // width]
        if len(found):
            again |= found[np.minimum(np.searchsorted(found, own), len(found) - 1)] == own
        return pa.array(again)

    return df.withColumn(AGAIN, twice(key))


def repeated_counts(df: DataFrame, columns: Sequence[str], nulls: bool = True, count: str = "row_count") -> DataFrame:
    """Row counts of the key tuples that occur more than once, without the tuples; NULL is a value if ``nulls``."""
    rows = df if nulls else df.dropna(subset=list(columns))
    hashes = tuple_hashes(columns)
    found = marked(rows.select(*map(column, columns)), [part for k in columns for part in (column(k), column(k).isNull())])
    return found.where(AGAIN).groupBy(*hashes).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1).select(count)


def top_values_of_many(df: DataFrame, columns: Sequence[str], k: int, null_label: str = "<NULL>") -> DataFrame:
    """(column_name, value, count): the ``k`` most frequent values of each column, ties to the smaller value.

    For columns of very many values. Values that may occur again are counted exactly;
    of all others, which occur once, each task hands on its ``k`` smallest of a column.
    """
    cells = df.select(*[F.coalesce(column(c).cast("string"), F.lit(null_label)).alias(c) for c in columns])
    pairs = cells.unpivot([], [column(c) for c in columns], "column_name", "value")
    both = marked(pairs, [F.col("column_name"), F.col("value")], slots_for(df.count() * len(columns)))
    counted = both.where(AGAIN).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    by_value = Window.partitionBy("column_name").orderBy("value")
    singles = both.where(~F.col(AGAIN)).withColumn("_place", F.row_number().over(by_value)).where(F.col("_place") <= k)
    singles = singles.select("column_name", "value", F.lit(1).cast("bigint").alias("count"))
    by_count = Window.partitionBy("column_name").orderBy(F.desc("count"), "value")
    ranked = counted.unionByName(singles).withColumn("_rank", F.row_number().over(by_count))
    return ranked.where(F.col("_rank") <= k).drop("_rank")
