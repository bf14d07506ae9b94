"""Approximate nearest neighbours by multi-index hashing.

Unit vectors are rotated so that their signs lose least (iterative quantisation, fitted
on a bounded sample) and the signs make a binary code of up to 64 bits. A code is cut
into substrings, and each substring position has an index of its own: a table of
(position, value, row), dealt by groups of neighbouring values. Two codes within Hamming distance r agree in one of m substrings
up to t_j bits whenever the t_j + 1 sum to more than r (pigeonhole). So a query probes, per
position, every value within t_j bits of its own in the groups that hold them, and
gets every code within the radius; what is farther is dropped by its whole distance, a
pair is kept at the first position that finds it, and the rest is ranked by the cosine
of the original vectors. The width of the substrings is the one with the least
probes and retrieved rows for the number of rows there are.

The radius is the ``reach`` quantile of the distances that true neighbours have in the
sample. Neighbours in the whole table are nearer than in its sample, so recall only
grows with the table. Queries that find fewer than ``k`` rows are compared with all rows.

Equal vectors are indexed once, with their k + 1 smallest ids: no other copy can be
among a query's k nearest. Vectors of each length are a search of their own. The vectors
move to their block once; a query's vector moves to the blocks that hold its
candidates. A task holds one block's vectors and reads the queries one after the other.
Groups of values that many rows share are dealt in parts.

Vectors that are null, empty, zero, or that hold null or non-finite components take no
part, nor do rows without id; very small and very large components are scaled by
powers of two first, which changes no digit of a cosine. Equal scores are ordered by the
smaller id. A row is never its own neighbour, its copies are, also under the same id.
Other columns are ignored, an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import arrow_batches, sampled, ship, stored

#: Rows that the rotation is fitted on, at most; a hash of the row selects them.
SAMPLE = 10_000
#: Rows of a block of vectors, and of a group of neighbouring index values, on average.
BLOCK, GROUP_ROWS = 4_096, 200_000
#: Found rows that a task holds before it hands on the queries' lists of them; bytes of the batches that tasks read.
HANDED_ROWS, BATCH_BYTES = 1 << 20, 16 << 20
REACH = 0.97
#: Substring widths that are considered, probes per position at most, and retrieved rows that a probe costs as much as.
WIDTHS, MOST_PROBES, PROBE_COST = range(8, 17), 4_096, 50


def rotation(sample: np.ndarray, bits: int, rounds: int = 40, seed: int = 5) -> np.ndarray:
    """Projection to ``bits`` axes whose signs lose least: principal axes, then a rotation found by turns."""
    axes = np.linalg.svd(sample, full_matrices=False)[2][:bits].T
    if axes.shape[1] < bits:
        axes = np.pad(axes, ((0, 0), (0, bits - axes.shape[1])))
    low = sample @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.sign(low @ turn).T @ low)
        turn = (u @ v).T
    return axes @ turn


def codes(unit: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Signs after the rotation as the bits of one number per vector."""
    signs = np.packbits(unit @ turn > 0, axis=1, bitorder="little")
    return np.pad(signs, ((0, 0), (0, 8 - signs.shape[1]))).copy().view("<u8")[:, 0]


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, so that their largest components are near 1."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _unit(vectors: np.ndarray) -> np.ndarray:
    near = scaled(vectors)
    return near / np.linalg.norm(near, axis=1, keepdims=True)


def thresholds(radius: int, positions: int) -> list[int]:
    """Bits by which each substring may differ so that codes within the radius agree in one at least; -1: not needed."""
    each, more = divmod(radius + 1, positions)
    return [each + (j < more) - 1 for j in range(positions)]


def substrings(bits: int, radius: int, rows: int) -> list[tuple[int, int, int]]:
    """(first bit, width, bits that may differ) of the positions, of the width with the least probes and retrieved rows."""

    def cut(width: int) -> list[tuple[int, int, int]]:
        count = -(-bits // width)
        widths = [bits // count + (j < bits % count) for j in range(count)]
        firsts = [sum(widths[:j]) for j in range(count)]
        return [(f, w, min(w, t)) for f, w, t in zip(firsts, widths, thresholds(radius, count), strict=True) if t >= 0]

    def probes(w: int, t: int) -> int:
        return sum(comb(w, n) for n in range(t + 1))

    found = [cut(w) for w in WIDTHS]
    fit = [x for x in found if max(probes(w, t) for _, w, t in x) <= MOST_PROBES]
    return min(fit or found[:1], key=lambda x: sum(probes(w, t) * (PROBE_COST + rows / 2**w) for _, w, t in x))


def _masks(width: int, t: int) -> np.ndarray:
    return np.array([sum(1 << b for b in bits) for n in range(t + 1) for bits in combinations(range(width), n)], np.uint64)


def _value(code: str, first: int, width: int) -> Column:
    return F.shiftrightunsigned(F.col(code), first).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def candidates(data: DataFrame, queries: DataFrame, radius: int, positions: list[tuple[int, int, int]], rows: int) -> DataFrame:
    """(query_row, among array<long>): the rows of (row, code) within the radius of a query (query_row, query_code), each once.

    Neighbouring values of a position share a group of about ``GROUP_ROWS`` rows. A query
    goes to the groups that hold values it probes, and gets a list from each. A task holds
    the rows of one group, and lists of bounded size together, however many queries there are.
    """
    groups = max(1, rows // GROUP_ROWS)
    shifts = [max(0, w - groups.bit_length() + 1) for _, w, _ in positions]
    values = [F.struct(F.lit(j).alias("position"), _value("code", f, w).alias("value"), F.shiftright(_value("code", f, w), k).alias("group")) for j, ((f, w, _), k) in enumerate(zip(positions, shifts, strict=True))]
    index = data.select("row", "code", F.inline(F.array(*values)))
    # groups that hold many more rows are dealt in parts; there are as many groups as the positions have values, at most
    large = index.groupBy("position", "group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 4 * GROUP_ROWS)
    large = F.broadcast(large.select("position", "group", F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("parts")))
    part = F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0)).cast("int").alias("part")
    index = index.join(large, ["position", "group"], "left").select("position", "group", part, "value", "row", "code")

    def probed(j: int) -> Column:
        (f, w, t), k = positions[j], shifts[j]
        # values that differ above the shift are other groups: masks that differ there only
        masks = sorted({int(m) >> k for m in _masks(w, t)})
        own = F.shiftright(_value("query_code", f, w), k)
        return F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: F.struct(F.lit(j).alias("position"), own.bitwiseXOR(m).alias("group")))

    asked = queries.select("query_row", "query_code", F.inline(F.concat(*map(probed, range(len(positions)))))).join(large, ["position", "group"], "left")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("to")
    # names of their own: both sides may come from one table
    asked = asked.select(F.col("position").alias("at"), F.col("group").alias("of"), parts, "query_row", "query_code")

    # the rows of a group come before its queries, so a task holds one group's rows and a batch of queries
    own = index.select("position", "group", "part", F.lit(False).alias("asked"), "value", "row", "code")
    theirs = asked.select(F.col("at").alias("position"), F.col("of").alias("group"), F.col("to").alias("part"), F.lit(True).alias("asked"), F.lit(0).alias("value"), F.col("query_row").alias("row"), F.col("query_code").alias("code"))
    tasks = int(data.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.unionByName(theirs).repartition(tasks, "position", "group", "part").sortWithinPartitions("position", "group", "part", "asked")
    return dealt.mapInArrow(_met(positions, shifts, radius), "query_row long, among array<long>")


class Group:
    """Rows of neighbouring values at one position, in the order of the values."""

    def __init__(self, rows: pa.Table, position: tuple[int, int, int], shift: int) -> None:
        self.first, self.width, t = position
        self.shift, self.masks = shift, _masks(self.width, t)
        values = rows.column("value").to_numpy()
        order = np.argsort(values, kind="stable")
        self.group = int(values[0]) >> shift
        self.rows, self.codes = rows.column("row").to_numpy()[order], rows.column("code").to_numpy().view(np.uint64)[order]
        self.bounds = np.searchsorted(values[order], (self.group << shift) + np.arange((1 << shift) + 1))

    def near(self, code: np.uint64, radius: int, before: list[tuple[int, int, int]]) -> np.ndarray:
        """Rows within the radius of a code that a probe finds here, but for those that a position before this one finds."""
        probes = ((code >> np.uint64(self.first)) & np.uint64((1 << self.width) - 1)) ^ self.masks
        probes = (probes[probes >> np.uint64(self.shift) == self.group]).astype(np.int64) - (self.group << self.shift)
        size = self.bounds[probes + 1] - self.bounds[probes]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.bounds[probes] - ends + size, size)
        differ = self.codes[at] ^ code
        near = np.bitwise_count(differ) <= radius
        for f, w, most in before:
            # the same pair may meet in several positions: the first one counts
            near &= np.bitwise_count((differ >> np.uint64(f)) & np.uint64((1 << w) - 1)) > most
        return self.rows[at[near]]


def _met(positions: list[tuple[int, int, int]], shifts: list[int], radius: int):
    """For mapInArrow over a group's rows and then the queries that go there, group after group: (query_row, among), ``HANDED_ROWS`` or so at a time."""

    def lists(queries: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
        among = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
        return pa.RecordBatch.from_arrays([pa.array(queries, pa.int64()), among], ["query_row", "among"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts, held = None, [], None
        queries, found, handed = [], [], 0
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)])
            bounds = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *bounds.tolist()], [*bounds.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if tuple(keys[:3, a].tolist()) != place:
                    place, parts, held = tuple(keys[:3, a].tolist()), [], None
                rows, position = batch.slice(a, b - a), place[0]
                if not keys[3, a]:
                    parts.append(rows)
                elif parts:
                    held = held or Group(pa.Table.from_batches(parts), positions[position], shifts[position])
                    for query, code in zip(rows.column("row").to_pylist(), rows.column("code").to_numpy().view(np.uint64), strict=True):
                        near = held.near(code, radius, positions[:position])
                        if len(near):
                            queries.append(query)
                            found.append(near)
                            handed += len(near)
                        if handed >= HANDED_ROWS:
                            yield lists(queries, found)
                            queries, found, handed = [], [], 0
        yield lists(queries, found)

    return run


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _block(rows: np.ndarray, blocks: int) -> np.ndarray:
    return (rows ^ (rows >> 33)) % blocks


def _by_block(blocks: int):
    """For mapInArrow: lists of rows cut into those of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries, numbers, lists = [], [], []
            for query, among in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = among.values.to_numpy(zero_copy_only=False)
                of = _block(rows, blocks)
                order = np.argsort(of, kind="stable")
                found, first = np.unique(of[order], return_index=True)
                lists += np.split(rows[order], first[1:])
                numbers.append(found)
                queries += [query] * len(found)
            if queries:
                ends = pa.array(np.cumsum([0, *map(len, lists)]).astype(np.int32))
                listed = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lists)))
                yield pa.RecordBatch.from_arrays([pa.array(queries, pa.int64()), pa.array(np.concatenate(numbers).astype(np.int32)), listed], ["query_row", "block", "among"])

    return run


class Block:
    """Vectors of a block, with the ids and rows of each one's copies."""

    def __init__(self, rows: pa.Table) -> None:
        order = np.argsort(rows.column("row").to_numpy())
        self.rows = rows.column("row").to_numpy()[order]
        self.vectors = scaled(_matrix(rows.column("vector"))[order])
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))
        copies = rows.column("copies").to_pylist()
        self.copies = [copies[i] for i in order.tolist()]

    def nearest(self, own: int, query: np.ndarray, among: np.ndarray | None, k: int) -> list[tuple[float, int]]:
        """(cosine, id) of the ``k`` rows nearest to the query, without the query's own row, of all vectors or some."""
        at = np.arange(len(self.rows)) if among is None else np.searchsorted(self.rows, among)
        vector = scaled(query[None, :])[0]
        score = np.einsum("ij,j->i", self.vectors[at], vector) / (self.norms[at] * np.sqrt(np.einsum("i,i->", vector, vector)))
        if len(score) > k + 1:  # the query itself may be one of them; equal scores are all looked at
            few = score >= np.partition(score, -(k + 1))[-(k + 1)]
            at, score = at[few], score[few]
        found = [(-s, c["vec_id"]) for i, s in zip(at.tolist(), score.tolist(), strict=True) for c in self.copies[i] if c["row"] != own]
        return [(-s, i) for s, i in sorted(found)[:k]]


def _ranked(k: int):
    """For mapInArrow over a block's vectors and then its requests, block after block: each query's nearest in the block."""
    kinds = {"query_row": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, held = None, [], None
        for batch in batches:
            out: list[tuple] = []
            numbers, asked = batch.column("block").to_numpy(), batch.column("asked").to_numpy(zero_copy_only=False)
            bounds = np.flatnonzero((np.diff(numbers) != 0) | (asked[1:] != asked[:-1])) + 1
            for a, b in zip([0, *bounds.tolist()], [*bounds.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if numbers[a] != number:
                    number, parts, held = numbers[a], [], None
                rows = batch.slice(a, b - a)
                if not asked[a]:
                    parts.append(rows)
                elif parts:
                    held = held or Block(pa.Table.from_batches(parts))
                    ids, own, among = rows.column("vec_id"), rows.column("row"), rows.column("among")
                    for i, query in enumerate(_matrix(rows.column("vector"))):
                        some = among[i].values.to_numpy(zero_copy_only=False) if among[i].is_valid else None
                        out += [(own[i].as_py(), ids[i].as_py(), j, s) for s, j in held.nearest(own[i].as_py(), query, some, k)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))

    return run


def _nearest(data: DataFrame, requests: DataFrame, tasks: int, k: int) -> DataFrame:
    """(query_row, query_id, vec_id, score, rank) of requests (block, row, vec_id, vector, among) on the blocks of data (block, row, vector, copies)."""
    none = F.lit(None)
    ours = data.select("block", F.lit(False).alias("asked"), "row", none.cast("long").alias("vec_id"), "vector", "copies", none.cast("array<long>").alias("among"))
    no_copies = none.cast(data.schema["copies"].dataType).alias("copies")
    theirs = requests.select("block", F.lit(True).alias("asked"), "row", "vec_id", "vector", no_copies, "among")
    dealt = ours.unionByName(theirs).repartition(tasks, "block").sortWithinPartitions("block", "asked")
    found = dealt.mapInArrow(_ranked(k), "query_row long, query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k)


def search(rows: DataFrame, is_query: str, k: int = 5, key: str = "vec_id", vector: str = "embedding", reach: float = REACH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest cosine found for each row that meets ``is_query``."""
    spark = rows.sparkSession
    ship(spark)
    plain = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    sound = F.expr("vector is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vector, x -> x <> 0)")
    plain = plain.where(sound & F.col("vec_id").isNotNull())
    # one read gives each row a number that stays
    kept = stored(plain.withColumn("row", F.monotonically_increasing_id()), "vectors")
    lengths = kept.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy("n").toLocalIterator()
    whole = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for n, total in [(int(x["n"]), int(x["rows"])) for x in lengths]:
        whole = whole.unionByName(_search_length(kept.where(F.size("vector") == n), n, total, is_query, k, reach))
    return whole


def _search_length(kept: DataFrame, dims: int, total: int, is_query: str, k: int, reach: float) -> DataFrame:
    """The search among the ``total`` vectors of one length."""
    spark = kept.sparkSession
    sample = sampled(kept, "row", SAMPLE).select("vector").toArrow()
    unit = _unit(_matrix(sample.column("vector")))
    bits = max(8, min(64, dims // 8 * 8))
    turn = rotation(unit, bits)
    known = codes(unit, turn)
    probe = np.arange(0, len(unit), max(1, len(unit) // 200))
    cosine = unit[probe] @ unit.T
    cosine[np.arange(len(probe)), probe] = -2
    true = np.argsort(-cosine, axis=1)[:, : min(k, max(1, len(unit) - 1))]
    radius = int(np.quantile(np.bitwise_count(known[probe][:, None] ^ known[true]), reach))
    # a cosine is all that counts, so the radius reaches at least a quarter of the bits
    radius = min(bits, max(radius, bits // 4))

    # equal vectors once, with the smallest ids of their copies
    smallest = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id", "row"))
    few = kept.withColumn("place", smallest).where(F.col("place") <= k + 1)
    copies = F.array_sort(F.collect_list(F.struct("vec_id", "row"))).alias("copies")
    distinct = few.groupBy("vector").agg(copies).select("vector", "copies", F.col("copies")[0]["row"].alias("row"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                of = codes(_unit(_matrix(batch.column("vector"))), turn)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of.view(np.int64))], [*batch.schema.names, "code"])

    blocks = -(-total // BLOCK)
    block = F.pmod(F.col("row").bitwiseXOR(F.shiftright("row", 33)), F.lit(blocks)).cast("int").alias("block")
    data = distinct.mapInArrow(coded, "vector array<double>, copies array<struct<vec_id: bigint, row: bigint>>, row long, code long")
    data = stored(data.select("*", block), "coded-vectors")
    queries = kept.where(is_query).select("row", "vec_id", "vector").mapInArrow(coded, "row long, vec_id long, vector array<double>, code long")
    queries = stored(queries, "queries")
    asked = queries.select(F.col("row").alias("query_row"), F.col("code").alias("query_code"))
    lists = candidates(data.select("row", "code"), asked, radius, substrings(bits, radius, total), total)
    lists = lists.mapInArrow(_by_block(blocks), "query_row long, block int, among array<long>")
    wanted = lists.groupBy("query_row", "block").agg(F.flatten(F.collect_list("among")).alias("among"))
    requests = wanted.join(queries.withColumnRenamed("row", "query_row"), "query_row").withColumnRenamed("query_row", "row")
    tasks = max(1, min(blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    with arrow_batches(spark, BATCH_BYTES):
        near = stored(_nearest(data, requests, tasks, k), "nearest")
    enough = near.where(F.col("rank") == min(k, total - 1)).select(F.col("query_row").alias("row"))
    short = stored(queries.join(enough, "row", "left_anti") if total > 1 else queries.limit(0), "short-queries")
    # queries whose radius holds fewer than k rows meet every block
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    rest = _nearest(data, short.select(every, "row", "vec_id", "vector", F.lit(None).cast("array<long>").alias("among")), tasks, k)
    near = near.join(short.select(F.col("row").alias("query_row")), "query_row", "left_anti").unionByName(rest, allowMissingColumns=True)
    return near.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
