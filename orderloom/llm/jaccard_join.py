"""N-gram Jaccard join by parity sketches.

A text's set holds the hashes of its distinct word shingles. Its parity sketch is a
wide bit vector in which every shingle toggles one bit, so the Hamming distance of
two sketches never exceeds the size of the symmetric difference of the sets. Sets of
sizes a and b with a Jaccard similarity of at least p/100 differ in at most
``(100 - p) * (a + b) / (100 + p)`` shingles.

Sizes fall into bands ``[2^j, 2^(j+1))``. Band j cuts the sketch into segments; a set
of the band, and a larger one that may still link with a member, keeps the segments
with a toggled bit, each as a 64-bit signature of its content. If at most d shingles
differ, at most d segments do, so (pigeonhole) of any d+1 of a set's segments one is
equal in the other set. Both sides therefore emit their first d+1 segments in one
global order (frequent contents last; before them, by the total length of their
shingles, what hardly meets by chance first), and every linked pair
shares the smallest segment that they have in common. A set with too few segments to promise this emits
all of them and a mark that meets the other sets of this sort. The order decides only
how many pairs are looked at, never which are found.

Pairs are screened by the Hamming distance of their folded sketches, and those that
may still link are verified on the whole sets. In the first round each signature's smallest
set (its hub) is compared with all others; then the sets of a signature that are in
different components are compared with each other, except where their distances
to the hub prove by the triangle inequality that they can't link. So copies cost a
comparison each, not one per pair, and no link between components is lost.

Empty texts and null texts have an empty set and link with nothing. Very long texts are
read whole; a text is a slice of its own if it is longer than others together. Repeated rows and
repeated ids are rows of their own. Ties between hubs go to the smaller set id, and every
component takes its smallest id. Extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import arrow_batches, mix, ship, slices, stored, texts, texts_of_batch, word_spans
from orderloom.llm.components import components

#: Bits per shared signature in the filter that selects sets worth keeping, and its bits at most (64 MiB).
#: Beyond that size it lets more through; what it lets through is joined exactly.
BITS_EACH, FILTER_BITS = 32, 1 << 29
PIECE_BITS = 1 << 19
#: Ids of sets to verify that are broadcast at most (counted; about 32 MB); beyond it the sets are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Rows of ids and numbers that one task takes at least.
ROWS_PER_TASK = 50_000
#: Sets that one task takes at least, once few are left.
SETS_PER_TASK = 2_500
#: Members of a hub that are compared with each other at a time, on either side.
BLOCK = 1_024
#: Bytes of a batch of texts or pairs of sets that a worker holds.
BATCH_BYTES = 8 << 20
#: Signature contents that are put last because many sets have them: at most so many are broadcast, the most frequent first.
FREQUENT = 100_000
#: Different sets that are counted together in a task, and how many must have a content for it to be a candidate for these.
COUNTED_TOGETHER, FREQUENT_AMONG_THEM = 5_000, 3

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


_LENGTH = np.uint64(15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of consecutive texts, and the texts' offsets among them.

    The lowest four bits of a hash tell the length of the shingle's words: long ones
    hardly meet by chance.
    """
    words, bounds, _, lengths = word_spans(data, offsets)
    n = np.diff(bounds)
    sizes = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    full = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width if len(full) else 0):
        full += mix(words[k : k + len(full)] + _ODD[k % 5])
        full *= _ODD[0]
    total = np.concatenate(([0], np.cumsum(lengths)))
    full = mix(full) & ~_LENGTH | np.clip((total[width:] - total[:-width])[: len(full)] // 3 - 2, 0, 15).astype(np.uint64)
    kept = [0]
    for i, (count, end, size) in enumerate(zip(n.tolist(), ends.tolist(), sizes.tolist(), strict=True)):
        if size == 0:
            kept.append(kept[-1])
            continue
        at = bounds[i]
        if count >= width:
            own = np.sort(full[at : at + size])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        else:
            own = np.full(1, count, np.uint64)
            for k in range(count):
                own = mix(own * _ODD[1] + words[at + k : at + k + 1])
            own |= _LENGTH
        out[kept[-1] : kept[-1] + len(own)] = own
        kept.append(kept[-1] + len(own))
    return out[: kept[-1]], np.array(kept, np.int64)


def _allowed(total: np.ndarray, percent: int) -> np.ndarray:
    return (100 - percent) * total // (100 + percent)


def signatures(hashes: np.ndarray, bounds: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each band: (index of the set, signature, signatures that the set must emit), in the sets' order of emission."""
    n = np.diff(bounds)
    if not n.any():
        return
    bands = np.zeros(len(n), np.int64)
    while (larger := n >= 2 ** (bands + 1)).any():
        bands[larger] += 1
    for band in range(int(bands.max()) + 1):
        most = 2 ** (band + 1) - 1
        home = (bands == band) & (n > 0)
        guest = (bands == band + 1) & (n * percent <= most * 100)
        own = np.flatnonzero(home | guest)
        if not len(own):
            continue
        size = n[own]
        partner = np.where(home[own], size * 100 // percent, most)
        need = _allowed(size + partner, percent) + 1
        at = np.repeat(bounds[:-1][own] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        token = hashes[at]
        of = np.repeat(np.arange(len(own)), size)
        segments = np.uint64(max(2**band * 400 * (100 - percent) // (100 * percent), 64))  # a set fills about twice the d+1 that it emits
        segment = ((token >> np.uint64(32)) * segments) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], (segment[1:] != segment[:-1]) | (of[1:] != of[:-1]))))
        content = np.bitwise_xor.reduceat(mix(token | np.uint64(0xFFFFFFFF00000000)), first)
        weight = np.add.reduceat((token & _LENGTH) + np.uint64(1), first).astype(np.int64)
        toggled = content != 0
        first, content, weight = first[toggled], content[toggled], np.minimum(weight[toggled], 63)
        signature = mix(content + mix(segment[first] * np.uint64(64) + np.uint64(band)) + weight.astype(np.uint64))
        of = of[first]
        order = np.argsort((of << 6) + 63 - weight, kind="stable")  # segments in order among equals
        of, signature = of[order], signature[order]
        few = np.flatnonzero(np.bincount(of, minlength=len(own)) < need)
        mark = mix(np.full(len(few), band + (1 << 62), np.uint64))
        of, signature = np.concatenate((of, few)), np.concatenate((signature, mark))
        if len(few):
            order = np.argsort(of, kind="stable")
            of, signature = of[order], signature[order]
        yield own[of], signature, need[of]


def emitted(of: np.ndarray, signature: np.ndarray, need: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which signatures a set emits: the first ``need`` in segment order, frequent ones only after all others."""
    at = np.searchsorted(frequent, signature)
    common = np.zeros(len(signature), bool)
    if len(frequent):
        common = frequent[np.minimum(at, len(frequent) - 1)] == signature
    begins = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    lengths = np.diff(np.append(begins, len(of)))

    def place(flags: np.ndarray) -> np.ndarray:
        counts = np.cumsum(flags)
        before = np.repeat(counts[begins] - flags[begins], lengths)
        return counts - before

    rare_place = place(~common)
    keep = ~common & (rare_place <= need)
    if common.any():
        rare = np.repeat(np.add.reduceat((~common).astype(np.int64), begins), lengths)
        late = np.flatnonzero(common & (rare < need))
        if len(late):
            order = np.lexsort((signature[late], rank[at[late]], of[late]))
            late = late[order]
            starts = np.flatnonzero(np.concatenate(([True], of[late][1:] != of[late][:-1])))
            within = np.arange(len(late)) - np.repeat(starts, np.diff(np.append(starts, len(late))))
            keep[late[within < (need - rare)[late]]] = True
    return keep


def _set_ids(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit id per set: equal sets, equal ids. 0 for the empty set."""
    n = np.diff(bounds)
    ids = np.zeros(len(n), np.uint64)
    full = n > 0
    if full.any():
        ids[full] = mix(np.add.reduceat(mix(hashes ^ np.uint64(0x5BF03635)), bounds[:-1][full]) + n[full].astype(np.uint64) * _ODD[3])
    return ids


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


_EMPTY = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _per_batch(work, width: int, last=None):
    """A function for mapInArrow that hands ``work`` the sets of each run of texts, and calls ``last`` after each batch and at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in slices(texts_of_batch(batch)):
                hashes, bounds = shingle_sets(data, offsets, width)
                yield from work(batch.slice(first, len(offsets) - 1), hashes, bounds)
            if last is not None:
                yield from last(False)
        if last is not None:
            yield from last(True)

    return run


def _different(ids: np.ndarray, seen: set[int]) -> np.ndarray:
    """Marks the first set of each id that isn't in ``seen``, and adds it there."""
    one = np.zeros(len(ids), bool)
    found, places = np.unique(ids, return_index=True)
    new = [(k, i) for k, i in zip(found.tolist(), places.tolist(), strict=True) if k not in seen]
    seen.update(k for k, _ in new)
    one[[i for _, i in new]] = True
    return one


def _describe(percent: int, width: int):
    """Rows (doc_id, size, set id), and the contents (signature, times) that several different sets have."""
    names = ["doc_id", "n_shingles", "set_id", "signature", "times"]
    found: list[np.ndarray] = []
    seen: set[int] = set()

    def work(batch, hashes, bounds):
        n, ids = np.diff(bounds), _set_ids(hashes, bounds)
        empty = pa.nulls(len(n), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n), _long(ids), empty, empty], names)
        one = _different(ids, seen)
        found.extend(signature[one[of]] for of, signature, _ in signatures(hashes, bounds, percent))

    def last(end: bool):
        if found and (end or len(seen) >= COUNTED_TOGETHER):
            signature, times = np.unique(np.concatenate(found), return_counts=True)
            signature, times = signature[times >= FREQUENT_AMONG_THEM], times[times >= FREQUENT_AMONG_THEM]
            found.clear()
            seen.clear()
            empty = pa.nulls(len(signature), pa.int64())
            yield pa.RecordBatch.from_arrays([empty, empty, empty, _long(signature), pa.array(times)], names)

    return _per_batch(work, width, last)


def _emit(percent: int, frequent, rank, width: int):
    seen: set[int] = set()  # of copies in a batch one emits

    def work(batch, hashes, bounds):
        ids = _set_ids(hashes, bounds)
        one = _different(ids, seen)
        for of, signature, need in signatures(hashes, bounds, percent):
            keep = emitted(of, signature, need, frequent, rank) & one[of]
            yield pa.RecordBatch.from_arrays([_long(signature[keep]), _long(ids[of[keep]])], ["signature", "set_id"])

    def last(end: bool):
        if end or len(seen) >= COUNTED_TOGETHER:
            seen.clear()
        return ()

    return _per_batch(work, width, last)


def _places(signature: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three places of each signature in a filter of a power of two bits."""
    last = np.uint64(bits - 1)
    return [(x & last).astype(np.int64) for x in (signature, signature >> np.uint64(32), mix(signature + _ODD[2]))]


def _filter(shared: DataFrame) -> np.ndarray:
    """Filter of the signatures in ``shared``, as bytes; its pieces are filled apart."""
    wanted, bits = shared.count() * BITS_EACH, PIECE_BITS
    while bits < min(wanted, FILTER_BITS):
        bits *= 2

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.concatenate(_places(batch.column(0).to_numpy().view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array(places // PIECE_BITS), pa.array((places % PIECE_BITS).astype(np.int32))], ["piece", "bit"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            pieces, bit = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for piece in np.unique(pieces).tolist():
                filled = np.zeros(PIECE_BITS, bool)
                filled[bit[pieces == piece]] = True
                packed = np.packbits(filled, bitorder="little")
                found[piece] = found[piece] | packed if piece in found else packed
        for piece, packed in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()), pa.array([packed.tobytes()], pa.binary())], ["piece", "bits"])

    placed = shared.select("signature").mapInArrow(split, "piece long, bit int").repartition(F.col("piece"))
    whole = np.zeros((bits // PIECE_BITS, PIECE_BITS // 8), np.uint8)
    for row in placed.mapInArrow(fill, "piece long, bits binary").toLocalIterator():  # FILTER_BITS / 8 bytes in all, at most
        whole[row["piece"]] |= np.frombuffer(row["bits"], np.uint8)
    return whole.reshape(-1)


def _sketch(hashes: np.ndarray) -> bytes:
    """Parity sketch folded to between four and eight bits a shingle, a power of two."""
    width = 64
    while width < 4 * len(hashes):
        width *= 2
    toggles = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(toggles.astype(np.uint8), bitorder="little").tobytes()


def _screen(percent: int):
    """Pairs with the Hamming distance of their sketches, and whether they may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_a, size_b = (batch.column(k).to_numpy() for k in (2, 3))
            apart = []
            for x, y in zip(batch.column(4), batch.column(5), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
                if len(a) < len(b):
                    a, b = b, a
                folded = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
                apart.append(int(np.bitwise_count(folded ^ b).sum()))
            apart = np.array(apart, np.int64)
            close = (np.minimum(size_a, size_b) * 100 >= np.maximum(size_a, size_b) * percent) & (apart <= _allowed(size_a + size_b, percent))
            least = 2.0 * apart / np.maximum(size_a + size_b + apart, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(least), pa.array(close)], ["a", "b", "size_a", "size_b", "least", "close"])

    return run


def _screened(pairs: DataFrame, briefs: DataFrame, percent: int, tasks: int) -> DataFrame:
    """(a, b, size_a, size_b, least, close): ``least`` is a lower bound of the Jaccard distance."""
    a = briefs.select(F.col("set_id").alias("a"), F.col("size").alias("size_a"), F.col("sketch").alias("x"))
    b = briefs.select(F.col("set_id").alias("b"), F.col("size").alias("size_b"), F.col("sketch").alias("y"))
    both = pairs.join(a, "a").coalesce(tasks).join(b, "b").select("a", "b", "size_a", "size_b", "x", "y").coalesce(tasks)
    return both.mapInArrow(_screen(percent), "a long, b long, size_a long, size_b long, least double, close boolean")


def _gather(percent: int, frequent, rank, filled):
    def work(batch, hashes, bounds):
        ids, known = _set_ids(hashes, bounds), filled.value
        one = _different(ids, set())
        ofs, found = [], []
        for of, signature, need in signatures(hashes, bounds, percent):
            keep = np.flatnonzero(emitted(of, signature, need, frequent, rank) & one[of])
            hit = np.ones(len(keep), np.uint8)
            for at in _places(signature[keep], 8 * len(known)):
                hit &= known[at >> 3] >> (at & 7).astype(np.uint8)
            keep = keep[hit == 1]
            ofs.append(of[keep])
            found.append(signature[keep])
        if not ofs:
            return
        of, signature = np.concatenate(ofs), np.concatenate(found)
        order = np.argsort(of, kind="stable")
        of, signature = of[order], signature[order]
        own, starts = np.unique(of, return_index=True)
        if not len(own):
            return
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(of)).astype(np.int32)), _long(signature))
        whole = [hashes[bounds[i] : bounds[i + 1]] for i in own.tolist()]
        sets = pa.array([x.tobytes() for x in whole], pa.binary())
        sketches = pa.array([_sketch(x) for x in whole], pa.binary())
        sizes = pa.array(np.diff(bounds)[own])
        yield pa.RecordBatch.from_arrays([_long(ids[own]), sizes, lists, sketches, sets], ["set_id", "size", "signatures", "sketch", "hashes"])

    return work


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of intersections of the pairs' sets."""
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        both, na, nb = [], [], []
        for x, y in zip(left, right, strict=True):
            a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            union = np.sort(np.concatenate((a, b)), kind="stable")
            both.append(int(np.count_nonzero(union[1:] == union[:-1])))
            na.append(len(a))
            nb.append(len(b))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(na, pa.int64()), pa.array(nb, pa.int64())], ["a", "b", "shared", "size_a", "size_b"])


def _verified(pairs: DataFrame, sets: DataFrame, tasks: int) -> DataFrame:
    """(a, b, shared, size_a, size_b) of stored pairs of set ids; only the sets in a pair are shuffled."""
    needed = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    few = needed.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    sets = sets.join(F.broadcast(needed) if few else needed, "set_id", "left_semi").groupBy("set_id").agg(F.first("hashes").alias("hashes"))
    with_a = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("hashes").alias("x")), "a").coalesce(tasks)
    with_both = with_a.join(sets.select(F.col("set_id").alias("b"), F.col("hashes").alias("y")), "b").coalesce(tasks)
    return with_both.select("a", "b", "x", "y").mapInArrow(_compare, "a long, b long, shared long, size_a long, size_b long")


def jaccard_classes(docs: DataFrame, width: int = 5, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_id, component_id), a row per row of ``docs``.

    Two rows link when ``100 * |intersection| >= percent * |union|`` of their sets of
    ``width``-word shingles; with fewer words the whole sequence is one shingle.
    ``component_id`` is the smallest id that is reachable by links, the row's own
    included. ``set_id`` is 64 bits wide; equal sets share it.
    """
    if not 70 <= percent <= 100:
        raise ValueError("percent must be from 70 to 100")
    ship(docs.sparkSession)
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return _classes(texts(docs, key, text), width, percent)


def _still_open(far: DataFrame, labels: DataFrame, tasks: int) -> DataFrame:
    """Members, with their component's label, of hubs whose members are in several components."""
    placed = far.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("label", F.coalesce("label", "set_id")).coalesce(tasks)
    split = placed.groupBy("hub").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("hub")
    return stored(placed.join(split, "hub").coalesce(tasks), "open")


def _close_pairs(left: DataFrame, briefs: DataFrame, percent: int, tasks: int) -> DataFrame:
    """(a, b): members of one hub, in different components, that may link by size, triangle inequality and sketch.

    Members outside a hub's largest component are held against all of its members,
    in blocks of a bounded size, inside the tasks; only pairs that may link come out.
    """
    limit = 1 - percent / 100 + 1e-9
    counts = left.groupBy("hub", "label").count()
    groups = counts.groupBy("hub").agg(F.max_by("label", F.struct("count", "label")).alias("main"), F.sum("count").alias("n"), F.max("count").alias("most_in_one"))
    groups = groups.select(
        "hub", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("data_blocks"), F.ceil((F.col("n") - F.col("most_in_one")) / BLOCK).cast("int").alias("query_blocks")
    )
    rows = stored(left.join(groups, "hub").join(briefs.select("set_id", "sketch"), "set_id").coalesce(tasks), "blocks")
    own = lambda n: F.pmod(F.xxhash64("set_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    values = ("set_id", "label", "size", "least", "most", "sketch")
    data = rows.select("hub", own("data_blocks").alias("d"), every("query_blocks").alias("q"), *values)
    asked = rows.where("label <> main").select(F.col("hub").alias("to"), every("data_blocks").alias("at"), own("query_blocks").alias("by"), *[F.col(c).alias(f"q_{c}") for c in values])

    def meet(held: pa.Table, asking: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        if held.num_rows and asking.num_rows:
            ids, label, size = (held.column(c).to_numpy() for c in ("set_id", "label", "size"))
            least, most = (held.column(c).to_numpy() for c in ("least", "most"))
            folded = _Folded(held.column("sketch").to_pylist())
            for row in asking.to_pylist():
                n = row["q_size"]
                may = (label != row["q_label"]) & (np.minimum(size, n) * 100 >= np.maximum(size, n) * percent)
                may &= (least - row["q_most"] <= limit) & (row["q_least"] - most <= limit)
                near = np.flatnonzero(may)
                if len(near):
                    near = near[folded.apart(np.frombuffer(row["q_sketch"], np.uint8), near) <= _allowed(size[near] + n, percent)]
                    out_a.append(np.minimum(ids[near], row["q_set_id"]))
                    out_b.append(np.maximum(ids[near], row["q_set_id"]))
        empty = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([empty, *out_a]), "b": np.concatenate([empty, *out_b])})

    return data.groupBy("hub", "d", "q").cogroup(asked.groupBy("to", "at", "by")).applyInArrow(meet, "a long, b long").distinct()


class _Folded:
    """Sketches of several widths, folded to a common one when they are compared."""

    def __init__(self, sketches: list[bytes]) -> None:
        self._width = np.array([len(x) for x in sketches])
        self._place = np.zeros(len(sketches), np.int64)
        self._by: dict[tuple[int, int], np.ndarray] = {}
        for w in np.unique(self._width).tolist():
            own = np.flatnonzero(self._width == w)
            self._place[own] = np.arange(len(own))
            self._by[w, w] = np.frombuffer(b"".join(sketches[i] for i in own.tolist()), np.uint8).reshape(-1, w)

    def apart(self, sketch: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Hamming distances between a sketch and some of these."""
        out = np.zeros(len(rows), np.int64)
        for w in np.unique(self._width[rows]).tolist():
            at = np.flatnonzero(self._width[rows] == w)
            to = min(w, len(sketch))
            if (w, to) not in self._by:
                whole = self._by[w, w]
                self._by[w, to] = np.bitwise_xor.reduce(whole.reshape(len(whole), -1, to), axis=1)
            one = np.bitwise_xor.reduce(sketch.reshape(-1, to), axis=0)
            out[at] = np.bitwise_count(self._by[w, to][self._place[rows[at]]] ^ one).sum(axis=1)
        return out


def _classes(rows: DataFrame, width: int, percent: int) -> DataFrame:
    spark = rows.sparkSession
    described = stored(rows.mapInArrow(_describe(percent, width), "doc_id long, n_shingles long, set_id long, signature long, times long"), "sets")
    counted = described.where("times is not null").groupBy("signature").agg(F.sum("times").alias("times"))
    steps = counted.groupBy(F.floor(4 * F.log2("times")).alias("step")).count().orderBy(F.desc("step")).toPandas()
    enough = steps["step"][steps["count"].cumsum() <= FREQUENT]
    top = counted.where(F.floor(4 * F.log2("times")) >= (int(enough.min()) if len(enough) else 1 << 30)).toPandas()  # FREQUENT rows at most
    top = top.sort_values(["times", "signature"], ascending=[False, True], ignore_index=True)
    frequent = top["signature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(frequent)
    frequent, rank = frequent[order], (len(order) - order).astype(np.int64)

    described = described.where("n_shingles is not null")
    emission = rows.mapInArrow(_emit(percent, frequent, rank, width), "signature long, set_id long")
    shared = stored(
        emission.groupBy("signature").agg(F.min("set_id").alias("hub"), F.max("set_id").alias("top")).where("hub < top").select("signature", "hub"), "shared"
    )
    filled = spark.sparkContext.broadcast(_filter(shared))
    gathered = rows.mapInArrow(_per_batch(_gather(percent, frequent, rank, filled), width), "set_id long, size long, signatures array<long>, sketch binary, hashes binary")
    gathered = stored(gathered, "gathered")
    # few sets are left: so many tasks as they fill, not as all documents would
    tasks = 8 + gathered.count() // SETS_PER_TASK
    sets = gathered.select("set_id", "hashes")
    briefs = stored(gathered.groupBy("set_id").agg(F.first("size").alias("size"), F.first("sketch").alias("sketch")).coalesce(tasks), "briefs")

    linked = f"100 * shared >= {percent} * (size_a + size_b - shared)"
    members = gathered.select("set_id", F.explode("signatures").alias("signature")).join(shared, "signature").coalesce(tasks)
    stars = members.where("set_id <> hub").select(F.col("hub").alias("a"), F.col("set_id").alias("b")).distinct()
    stars = stored(_screened(stars, briefs, percent, tasks), "stars")
    known = stored(_verified(stars.where("close").select("a", "b"), sets, tasks), "known")
    edges = known.where(linked).select("a", "b")
    labels = components(edges)

    distance = F.expr("1.0d - shared / (size_a + size_b - shared)")
    far = stars.join(known.select("a", "b", distance.alias("exact")), ["a", "b"], "left").select(
        F.col("a").alias("hub"), F.col("b").alias("set_id"), F.coalesce("exact", "least").alias("least"), F.coalesce("exact", F.lit(1.0)).alias("most"), F.col("size_b").alias("size")
    )
    far = stored(far.coalesce(tasks), "far")
    # the member nearest to a hub is likelier to be in the middle of its group: a second hub
    left = _still_open(far, labels, tasks)
    middle = left.groupBy("hub").agg(F.min(F.struct("most", "least", "set_id", "label")).alias("m"))
    second = left.join(middle, "hub").where("set_id <> m.set_id and label <> m.label")
    second = second.select(F.least("set_id", "m.set_id").alias("a"), F.greatest("set_id", "m.set_id").alias("b")).distinct()
    second = stored(_screened(second, briefs, percent, tasks).where("close").select("a", "b"), "pairs")
    second = stored(_verified(second, sets, tasks).where(linked).select("a", "b"), "second")
    edges = edges.union(second)
    if not second.isEmpty():
        labels = components(edges, labels)
    rest = stored(_close_pairs(_still_open(far, labels, tasks), briefs, percent, tasks), "pairs")
    rest = stored(_verified(rest, sets, tasks).where(linked).select("a", "b"), "rest")
    if not rest.isEmpty():
        labels = components(edges.union(rest), labels)

    rows_per_task = 8 + described.count() // ROWS_PER_TASK
    full = described.where("n_shingles > 0")
    first = full.groupBy("set_id").agg(F.min("doc_id").alias("first")).coalesce(rows_per_task)
    by_set = first.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("label", F.coalesce("label", "set_id")).coalesce(rows_per_task)
    lowest = by_set.groupBy("label").agg(F.min("first").alias("component_id")).coalesce(rows_per_task)
    ids = stored(by_set.join(lowest, "label").select("set_id", "component_id").coalesce(rows_per_task), "ids")
    full = full.join(ids, "set_id").select("doc_id", "n_shingles", "set_id", "component_id")
    empty = described.where("n_shingles = 0").select("doc_id", "n_shingles", "set_id", F.col("doc_id").alias("component_id"))
    return full.unionAll(empty)
