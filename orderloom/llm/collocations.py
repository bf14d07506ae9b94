"""Phrase collocations from an FM-index per shard of words.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line breaks, and into words at
spaces and tabs. A task gathers the word ids of its texts, by language, into shards of about
``SHARD_WORDS`` words, with a separator between pieces. A shard's index is the
Burrows-Wheeler transform of its words in both directions, sorted by as many words as
phrases need. A phrase is a pair of intervals: of the places where it begins, sorted
by what follows, and of those where it ends, sorted by what precedes. Reading the
transforms over an interval gives all its left and right extensions with their
counts; a right extension's own intervals follow from the number of smaller symbols
and from ranks in the other transform. So phrases are enumerated level by level, and
counts, as well as the count of the strongest left and right extension, are summed across shards.

A phrase of at least ``least`` occurrences has frequent parts only. Hence words are
counted first, then pairs of frequent words, then triples of frequent pairs (both by
hash), and the last pass enumerates what frequent words, pairs and triples leave.
Shards send their counts in lists, one per bucket of hashes, and a task adds up those of its
buckets. Filters of ``FILTER_BITS`` bits tell frequent parts; what they wrongly let through is
counted exactly and dropped then, so hashes and the filters' size never change a result.

Everything is per language; a null language is ``und``. Null and empty texts have no words.
A piece is never cut, so a very long text is read in parts and a shard holds at most
its limit and one piece more. Repeated rows count each time. Ties of cuts go to the
shorter first part, ties of phrases to more occurrences, then to UTF-8 order. Extra
columns are ignored; an empty table gives an empty one. Counts up to 10^15 are exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import arrow_batches, mix, ship, stored

#: Words of a shard; bytes of text that are split at a time, and of a batch.
SHARD_WORDS, PART_BYTES, BATCH_BYTES = 1 << 20, 1 << 20, 4 << 20
#: Rows that a task takes up before it merges them.
MERGED_ROWS = 1 << 20
#: Bits of a filter of frequent parts (8 MiB); whole pieces of Spark's bitmaps.
FILTER_BITS, PIECE_BITS = 1 << 26, 1 << 15
#: Languages whose sizes are broadcast at most; parts over which counts are spread in joins and phrases before ranking.
BROADCAST_LANGS, STRANDS, RANK_PARTS = 100_000, 8, 64

_SEPARATOR = b"\xff"  # no byte of UTF-8
_TABLE = bytearray(range(256))
_TABLE[65:91] = range(97, 123)
for _mark in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_mark] = 0xFF
_TABLE[9] = 32
_TABLE = bytes(_TABLE)
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Shard:
    """Word ids of one language's texts, pieces between separators (0)."""

    def __init__(self) -> None:
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[_SEPARATOR]
        self.parts: list[np.ndarray] = [np.zeros(1, np.int32)]
        self.size = 0

    def add(self, part: bytes) -> None:
        words = part.replace(_SEPARATOR, b" \xff ").split()
        self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def close(self) -> tuple[np.ndarray, list[bytes]]:
        return np.concatenate([*self.parts, np.zeros(1, np.int32)]), list(self.ids)


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """(language, word ids, words) of shards of a task's rows (lang, text)."""
    open_: defaultdict[str, Shard] = defaultdict(Shard)
    for batch in batches:
        rows: defaultdict[str, list[bytes]] = defaultdict(list)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            rows[lang].append(text)
        for lang, texts in rows.items():
            data = _SEPARATOR.join(texts).translate(_TABLE)
            for part, closed in _parts(data):
                open_[lang].add(part)
                if closed and open_[lang].size >= SHARD_WORDS:
                    yield lang, *open_.pop(lang).close()
            if lang in open_:
                open_[lang].add(_SEPARATOR)
        if sum(x.size for x in open_.values()) >= SHARD_WORDS:
            while open_:
                lang, shard = open_.popitem()
                yield lang, *shard.close()
    for lang, shard in open_.items():
        yield lang, *shard.close()


def _parts(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """Parts of the data, cut between words, and whether a part ends with its piece."""
    start = 0
    while len(data) - start > PART_BYTES:
        end, closed = data.rfind(_SEPARATOR, start, start + PART_BYTES), True
        if end <= start:
            end, closed = data.rfind(b" ", start, start + PART_BYTES), False
        if end <= start:
            after = [x for x in (data.find(_SEPARATOR, start + 1), data.find(b" ", start + 1)) if x >= 0]
            end = min(after, default=len(data))
        yield data[start:end], closed
        start = end
    yield data[start:], True


class Transform:
    """Burrows-Wheeler transform of symbols, sorted by the next ``span`` of them, with ranks."""

    def __init__(self, text: np.ndarray, span: int) -> None:
        order = np.argsort(_ranks(text, span), kind="stable")
        self.before = text[order - 1]  # text[-1] before the first: both ends are separators
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text))))
        self._places: np.ndarray | None = None

    def start(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the interval begins that ``symbol`` in front of an interval from ``at`` has."""
        n = len(self.before)
        if self._places is None:
            order = np.argsort(self.before, kind="stable")
            self._places = self.before[order].astype(np.int64) * n + order
        return np.searchsorted(self._places, symbol * n + at)

    def extensions(self, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, symbol, count, places of smaller symbols) of what stands before intervals."""
        ends = np.cumsum(size)
        width = int(self.before.max()) + 1
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)
        keys = np.repeat(np.arange(len(size)) * width, size) + self.before[places]
        keys.sort()
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        count = np.diff(np.append(begins, len(keys)))
        interval, symbol = np.divmod(keys[begins], width)
        return interval, symbol, count, begins - (ends - size)[interval]


def _ranks(text: np.ndarray, span: int) -> np.ndarray:
    """Ranks of all places by their next ``span`` symbols."""
    ranks, have = text, 1
    while have < span:
        step = min(have, span - have)
        shifted = np.append(ranks[step:], np.zeros(step, ranks.dtype))
        ranks = np.unique(ranks.astype(np.int64) * (int(ranks.max()) + 1) + shifted, return_inverse=True)[1]
        have += step
    return ranks


@dataclass
class Level:
    """Phrases of one length: a row of word ids each, counts, counts of the strongest extensions to either side."""

    words: np.ndarray
    n: np.ndarray
    left: np.ndarray
    right: np.ndarray


def phrases(text: np.ndarray, depth: int, keep=None) -> Iterator[Level]:
    """Phrases of 2 to ``depth`` words by extending intervals to the right; ``keep(words)`` tells which go on."""
    following, preceding = Transform(text[::-1], max(depth - 1, 1)), Transform(text, max(depth - 1, 1)) if depth > 2 else None
    counts = np.bincount(text)
    words = np.flatnonzero(counts)
    words = words[words > 0]
    size, ends = counts[words], following.first[words]
    begins = preceding.first[words] if preceding else ends
    words = words[:, None]
    for length in range(1, depth + 1):
        left, right = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if length < depth:
            interval, symbol, n, smaller = following.extensions(ends, size)
            real = symbol > 0
            interval, symbol, n, smaller = interval[real], symbol[real], n[real], smaller[real]
            np.maximum.at(right, interval, n)
        if length > 1:
            if length < depth:
                of, to, m, _ = preceding.extensions(begins, size)
                np.maximum.at(left, of[to > 0], m[to > 0])
            yield Level(words, size, left, right)
        if length == depth:
            return
        longer = np.concatenate((words[interval], symbol[:, None]), 1)
        going = np.ones(len(longer), bool) if keep is None else keep(longer)
        interval, symbol, longer = interval[going], symbol[going], longer[going]
        if length + 1 < depth:
            begins = begins[interval] + smaller[going]
            ends = following.start(symbol, ends[interval])
        words, size = longer, n[going]


class Filter:
    """A set of hashes as bits; it may hold more, never less."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(len(self.bits) * 8 - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    @staticmethod
    def of(hashes: DataFrame) -> Filter:
        """Filter of the column ``hash``; its pieces are filled apart, FILTER_BITS / 8 bytes in all."""
        at = F.col("hash").bitwiseAND(FILTER_BITS - 1)
        piece = F.shiftright(at, PIECE_BITS.bit_length() - 1).alias("piece")
        pieces = hashes.groupBy(piece).agg(F.bitmap_construct_agg(at.bitwiseAND(PIECE_BITS - 1)).alias("bits"))
        whole = np.zeros((FILTER_BITS // PIECE_BITS, PIECE_BITS // 8), np.uint8)
        for row in pieces.toLocalIterator():
            whole[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
        return Filter(whole.reshape(-1))


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """Spark's xxhash64(lang, word) of each word; 0 stands for the separator, the first of them."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.array([0, *(xxhash.xxh64_intdigest(x, seed) for x in words[1:])], np.uint64)


def phrase_hashes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A hash of each row of word ids."""
    found = mix(hashes[words[:, 0]])
    for k in range(1, words.shape[1]):
        found = mix(found * _ODD + hashes[words[:, k]])
    return found


def _frequent_runs(text: np.ndarray, hashes: np.ndarray, frequent: Filter, pairs: Filter | None) -> np.ndarray:
    """The shard with separators in place of rare words and, where pairs are known, between rare pairs; single words go."""
    text = np.where(frequent.has(hashes)[text], text, 0)
    if pairs is not None:
        apart = ~pairs.has(mix(mix(hashes[text[:-1]]) * _ODD + hashes[text[1:]]))
        apart |= (text[:-1] == 0) | (text[1:] == 0)
        lone = np.append(True, apart) & np.append(apart, True)
        text[lone] = 0
        wide = np.zeros(2 * len(text), text.dtype)
        wide[::2] = text
        kept = np.ones(len(wide), bool)
        kept[1::2] = np.append(apart & (text[:-1] > 0) & (text[1:] > 0), False)
        text = wide[kept]
    return text[(text > 0) | (np.append(1, text[:-1]) > 0)]


def _rows(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, word, n) of words with at least ``least`` occurrences; the null word has all words of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, words in shards(batches):
            n = np.bincount(ids, minlength=len(words))
            listed = pa.array([None, *words[1:]], pa.binary()).cast(pa.string())
            n[0] = n[1:].sum()
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), listed, pa.array(n)], ["lang", "word", "n"])

    counted = _rows(docs).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= least) | F.col("word").isNull())


def _buckets(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the hashes by their bucket, and where each of the ``n`` buckets ends in it."""
    bucket = ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int64)
    return np.argsort(bucket, kind="stable"), np.cumsum(np.bincount(bucket, minlength=n))


def _dealt(lists: dict[str, pa.Array], hashes: np.ndarray, n: int) -> pa.RecordBatch:
    """A row per bucket with its part of each column, as lists: a shuffle of few long rows in place of many short ones."""
    order, ends = _buckets(hashes, n)
    offsets = pa.array(np.append(0, ends).astype(np.int32))
    columns = [pa.array(np.arange(n, dtype=np.int32))]
    columns += [pa.ListArray.from_arrays(offsets, x.take(pa.array(order))) for x in lists.values()]
    batch = pa.RecordBatch.from_arrays(columns, ["bucket", *lists])
    return batch.filter(pa.array(np.diff(ends, prepend=0) > 0))


def _summed(dealt: DataFrame, keys: list[str], sums: list[str], least: int, schema: str, n: int) -> DataFrame:
    """Sums by key of lists dealt into buckets, where the first sum is at least ``least``; a task holds its bucket's keys."""

    def merged(parts: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(parts).group_by(keys, use_threads=False).aggregate([(x, "sum") for x in sums])
        return found.select([*keys, *[f"{x}_sum" for x in sums]]).rename_columns([*keys, *sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        held = distinct = 0
        for batch in batches:
            flat = {x: batch.column(batch.schema.get_field_index(x)) for x in (*keys, *sums)}
            flat = {x: y.flatten() for x, y in flat.items()}
            parts.append(pa.table({x: y.cast(pa.int64()) if x in sums else y for x, y in flat.items()}))  # sums are long
            held += parts[-1].num_rows
            if held > distinct + MERGED_ROWS:
                parts = [merged(parts)]
                held = distinct = parts[0].num_rows
        if parts:
            found = merged(parts)
            yield from found.filter(pc.greater_equal(found[sums[0]], least)).to_batches()

    return dealt.repartition(n, "bucket").mapInArrow(run, schema)


def _hashed_counts(docs: DataFrame, length: int, filters: list, least: int) -> DataFrame:
    """Hashes of phrases of one length, of frequent parts, with at least ``least`` occurrences (of all with that hash)."""
    n = _partitions(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [x.value for x in filters]
        for lang, ids, words in shards(batches):
            hashes = word_hashes(lang, words)
            text = _frequent_runs(ids, hashes, known[0], known[1] if length > 2 else None)
            for level in phrases(text, length):
                if level.words.shape[1] == length and len(level.n):
                    found = phrase_hashes(level.words, hashes)
                    yield _dealt({"hash": pa.array(found.view(np.int64)), "n": pa.array(level.n.astype(np.int32))}, found, n)

    dealt = _rows(docs).mapInArrow(run, "bucket int, hash array<long>, n array<int>")
    return _summed(dealt, ["hash"], ["n"], least, "hash long, n long", n).select("hash")


def _partitions(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def phrase_counts(docs: DataFrame, words: DataFrame, least: int, depth: int) -> DataFrame:
    """(lang, phrase, length, n, left, right) of phrases of 2 to ``depth`` words with at least ``least`` occurrences.

    ``left`` and ``right`` sum each shard's strongest extension, so a phrase's
    extensions to that side have no more occurrences.
    """
    n = _partitions(docs)
    context = docs.sparkSession.sparkContext
    filters = [context.broadcast(Filter.of(words.where("word is not null").select(F.xxhash64("lang", "word").alias("hash"))))]
    for length in range(2, min(depth, 3) + 1):
        filters.append(context.broadcast(Filter.of(_hashed_counts(docs, length, filters, least))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [x.value for x in filters]
        for lang, ids, words in shards(batches):
            hashes = word_hashes(lang, words)

            def keep(longer: np.ndarray) -> np.ndarray:
                # the first words were looked at before; the last two or three are new
                last = min(longer.shape[1], len(known))
                return known[last - 1].has(phrase_hashes(longer[:, -last:], hashes))

            for level in phrases(_frequent_runs(ids, hashes, known[0], known[1]), depth, keep):
                if len(level.n):
                    joined = pa.array([b" ".join(map(words.__getitem__, x)) for x in level.words.tolist()], pa.binary()).cast(pa.string())
                    rows = {"lang": pa.array([lang] * len(joined)), "phrase": joined, "length": pa.array(np.full(len(joined), level.words.shape[1], np.int32))}
                    rows |= {name: pa.array(x.astype(np.int32)) for name, x in (("n", level.n), ("left", level.left), ("right", level.right))}
                    yield _dealt(rows, phrase_hashes(level.words, hashes), n)

    lists = "bucket int, lang array<string>, phrase array<string>, length array<int>, n array<int>, left array<int>, right array<int>"
    dealt = _rows(docs).mapInArrow(run, lists)
    schema = "lang string, phrase string, length int, n long, left long, right long"
    return _summed(dealt, ["lang", "phrase", "length"], ["n", "left", "right"], least, schema, n)


def _part(first: bool):
    k = "k" if first else "k - length"
    return F.expr(f"substring_index(phrase, ' ', {k})")


def collocations(docs: DataFrame, least: int = 100, depth: int = 5, top: int = 2_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by their weakest cut.

    Phrases of 2 to ``depth`` words with a >= ``least`` occurrences; l and r count the
    parts of the cut and n all words of the language, score is floor(1000 * a * n / (l * r)).
    Phrases within a longer one of as many occurrences are left out.
    """
    if not 2 <= depth <= 5:
        raise ValueError("depth is 2 to 5")
    spark = docs.sparkSession
    with arrow_batches(spark, BATCH_BYTES):
        words = stored(word_counts(docs, least), "words")
        found = stored(phrase_counts(docs, words, least, depth), "phrases")
    # one word more has as many occurrences: only where the strongest extensions allow it
    longer = found.where("length > 2").select(
        "lang",
        "n",
        F.explode(F.expr("array(substring_index(phrase, ' ', length - 1), substring_index(phrase, ' ', 1 - length))")).alias("phrase"),
    )
    inside = found.where("left >= n or right >= n").join(longer, ["lang", "phrase", "n"], "left_semi").select("lang", "phrase")
    candidates = found.join(inside, ["lang", "phrase"], "left_anti")
    # counts of both parts; frequent parts stand in many cuts, so counts go over all strands
    counts = found.select("lang", F.col("phrase").alias("part"), "n").union(words.where("word is not null").select("lang", "word", "n"))
    counts = counts.withColumn("strand", F.explode(F.sequence(F.lit(0), F.lit(STRANDS - 1))))
    cuts = candidates.select("lang", "phrase", "length", F.col("n").alias("a"), F.explode(F.expr("sequence(1, length - 1)")).alias("k"))
    cuts = cuts.withColumns({"first": _part(True), "rest": _part(False), "strand": F.pmod(F.xxhash64("phrase"), F.lit(STRANDS)).cast("int")})
    cuts = cuts.join(counts.withColumnsRenamed({"part": "first", "n": "l"}), ["lang", "first", "strand"])
    cuts = cuts.join(counts.withColumnsRenamed({"part": "rest", "n": "r"}), ["lang", "rest", "strand"])
    sizes = words.where("word is null").select("lang", "n")
    if sizes.limit(BROADCAST_LANGS + 1).count() <= BROADCAST_LANGS:
        sizes = F.broadcast(sizes)
    cuts = cuts.join(sizes, "lang")
    big = {x: f"cast({x} as decimal(15, 0))" for x in "anlr"}
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * {big['a']} * {big['n']}) div ({big['l']} * {big['r']})")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(weakest).select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    scored = scored.withColumn("part", part)
    scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
