"""Alignment of two tokenizers over a corpus, each distinct text once.

Documents are shuffled by their full text and counted, so every distinct text is
tokenised and aligned once, however many copies it has. Tokenizer A is byte-level BPE
on the text with a space in front; tokenizer B is a piece model, which puts that space
there itself. Both cut the same bytes, so their tokens are two partitions of one line:
where both have an end a group ends, and every stretch between neighbouring ends of
either one is the overlap of one A token with one B token (a link).

A pair of ids counts in as many documents as hold it linked: the copies of a distinct text weigh
each of its pairs, and the weights are summed by pair. A text's measures come from
joining its pairs to these counts, and documents get them by the digest of their text.

Words are aligned once per task: a single space or line break between characters that
are no white space ends a group of both tokenizers, so texts are put together from
their words' ids, links and groups. Pieces with other white space are aligned as wholes.

Texts that are null or empty, or whose tokens do not give back their bytes (those with
U+2581, which B reads as a space), have no tokens: zeros and an empty string. Very long texts go in
runs of ``RUN`` words. Repeated rows and ids are rows of their own, each a document.
Ties: all B ids that share an A id's highest count are best. Extra columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import piece_bpe
from orderloom.llm.common import arrow_batches, joined_classes, ship, stored, texts
from orderloom.llm.token_ids import ByteTokens

#: Bits of an id in a pair of ids.
ID_BITS = 20
#: Distinct pairs that are broadcast at most (counted; some 60 MB); beyond it pairs are joined by a shuffle, over so many strands.
BROADCAST_PAIRS, STRANDS = 1_000_000, 16
#: Rows aligned at a time; words of a row at a time; bytes of a batch; words that a task remembers.
ROWS, RUN, BATCH_BYTES, KNOWN_WORDS = 128, 1 << 18, 8 << 20, 250_000
#: Longer words are not remembered.
LONG_WORD = 48

_ODD_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


class Tokens:
    """Both tokenizers with the bytes of their ids and the ids' decimal digits; of fixed size, one per process."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.a = ByteTokens(byte_path, special_as_text=True)
        self.b = piece_bpe.vocabulary(piece_path)
        size = self.a.tokenizer.get_vocab_size()
        if max(size, self.b.size) > 1 << ID_BITS:
            raise ValueError(f"vocabularies of at most {1 << ID_BITS} ids are needed")
        byte_of = {c: b for b, c in _byte_letters().items()}
        names = [self.a.tokenizer.id_to_token(i) for i in range(size)]
        self.a_bytes = Ragged([bytes(byte_of[c] for c in x) if all(c in byte_of for c in x) else x.encode() for x in names])
        self.b_bytes = Ragged(self.b.bytes_of)
        self.digits = Ragged([b"%d," % i for i in range(max(size, self.b.size))])


class Ragged:
    """Byte strings by number, for gathering many at once."""

    def __init__(self, strings: list[bytes]) -> None:
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.width = np.array([len(x) for x in strings], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.width)[:-1]))

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the strings one after the other, and where each ends."""
        width = self.width[numbers]
        ends = np.cumsum(width)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[numbers] - ends + width, width)], ends


@lru_cache(maxsize=1)
def _tokens(byte_path: str, piece_path: str) -> Tokens:
    return Tokens(byte_path, piece_path)


class Aligner:
    """Tokens of both kinds, links and groups of words; a word starts with its space or line break."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.of = _tokens(byte_path, piece_path)
        self.cuts = self.of.b.breaks_apart
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.odd: dict[str, int] = {}
        self.long: list[str] = []  # of these, the words that are too long to stay
        self.groups: list[bytes] = []  # per word: its groups as text
        self.numbers = np.zeros((0, 4), np.int64)  # per word: A tokens, B tokens, groups, links; -1 without tokens
        self.links = np.zeros(0, np.int64)  # pairs of ids, word by word
        self.starts = np.zeros(1, np.int64)

    def add(self, words: list[str], a_ids: list[bytes]) -> range:
        """Aligns new words; returns their numbers."""
        of = self.of
        b_ids = of.b.encode_escaped([x.replace(" ", piece_bpe.SPACE) for x in words])
        data = [x.encode() for x in words]
        a, b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in (a_ids, b_ids))
        n_a, n_b = (np.array([len(x) // 4 for x in ids], np.int64) for ids in (a_ids, b_ids))
        size = np.array([len(x) for x in data], np.int64)
        whole = self._faithful(data, size, a, n_a, of.a_bytes) & self._faithful(data, size, b, n_b, of.b_bytes)
        a, b = a[np.repeat(whole, n_a)], b[np.repeat(whole, n_b)]
        # ends of A tokens and B tokens on the line of all bytes
        ends = np.cumsum(np.where(whole, size, 0))
        marks = np.zeros(int(ends[-1]) + 1, np.uint8)
        marks[np.cumsum(of.a_bytes.width[a])] |= 1
        marks[np.cumsum(of.b_bytes.width[b])] |= 2
        marks[0] = 0
        at = np.flatnonzero(marks)
        mark = marks[at]
        of_a, of_b = np.cumsum(mark & 1, dtype=np.int64), np.cumsum(mark >> 1, dtype=np.int64)
        links = a[of_a - (mark & 1)] << ID_BITS | b[of_b - (mark >> 1)]
        both = mark == 3
        link_ends = np.searchsorted(at, ends, "right")
        group_ends = np.append(0, np.cumsum(both))[link_ends]
        first = len(self.groups)
        self.groups.extend(self._written(a, b, of_a[both], of_b[both], group_ends))
        counts = np.stack([n_a, n_b, np.diff(group_ends, prepend=0), np.diff(link_ends, prepend=0)], 1)
        counts[~whole] = -1
        self.numbers = np.concatenate((self.numbers, counts))
        self.links = np.concatenate((self.links, links))
        self.starts = np.concatenate((self.starts, self.starts[-1] + link_ends))
        return range(first, len(self.groups))

    @staticmethod
    def _faithful(data: list[bytes], size: np.ndarray, ids: np.ndarray, n: np.ndarray, bytes_of: Ragged) -> np.ndarray:
        """Whether the ids of each word give back its bytes."""
        found, ends = bytes_of.joined(ids)
        cuts = np.append(0, ends)[np.append(0, np.cumsum(n))]
        wanted = b"".join(data)
        if (np.diff(cuts) == size).all() and found.tobytes() == wanted:
            return np.ones(len(data), bool)
        joined = found.tobytes()
        return np.array([joined[i:j] == x for x, (i, j) in zip(data, pairwise(cuts.tolist()), strict=True)], bool)

    def _written(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, group_ends: np.ndarray) -> list[bytes]:
        """Groups of each word as text; a group ends after so many tokens of A and of B."""
        if not len(a_ends):
            return [b""] * len(group_ends)
        # tokens in the order in which they are written: A tokens of a group, then its B tokens
        n_a, n_b = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
        order = np.zeros(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(b_ends - n_b, n_a)] = a
        order[np.arange(len(b)) + np.repeat(a_ends, n_b)] = b
        text, ends = self.of.digits.joined(order)
        last = ends[a_ends + b_ends - 1] - 1  # where the sign after a group stands
        text[last] = ord(";")
        text[ends[a_ends + b_ends - n_b - 1] - 1] = ord("|")
        data, cuts = text.tobytes(), np.append(0, last + 1)[np.append(0, group_ends)].tolist()
        return [data[i : max(i, j - 1)] for i, j in pairwise(cuts)]

    def learn(self, cut: list[list[str]]) -> None:
        """Numbers of new words that follow a single space, given without it, or start with a line break."""
        new = list(set(chain.from_iterable(cut)).difference(self.known))
        regular = [x for x in new if _regular(x)]
        self.known.update(dict.fromkeys(new, -1))
        if regular:
            words = [x if x[0] == "\n" else " " + x for x in regular]
            self.known.update(zip(regular, self.add(words, self.of.a.pieces(words)), strict=True))
        self.long += [x for x in new if len(x) > LONG_WORD]

    def numbers_of(self, words: list[str]) -> list[int]:
        """Numbers of words as they stand, of any white space."""
        if new := list(set(words).difference(self.odd)):
            self.odd.update(zip(new, self.add(new, self.of.a.whole(new)), strict=True))
            self.long += [x for x in new if len(x) > LONG_WORD]
        return list(map(self.odd.__getitem__, words))

    def runs(self, whole: list[str]) -> Iterator[tuple[int, list[int]]]:
        """(text, numbers of its words) run by run; a text has one run unless it is very long."""
        cut = [x.replace("\n", " \n").split(" ") if self.cuts and len(x) <= RUN else [] for x in whole]
        self.learn(cut)
        for i, words in enumerate(cut):
            numbers = list(map(self.known.__getitem__, words))
            if words and -1 not in numbers:
                yield i, numbers
            elif whole[i]:
                pieces = _odd_words(" " + whole[i]) if self.cuts else iter([" " + whole[i]])
                while run := list(islice(pieces, RUN)):
                    yield i, self.numbers_of(run)

    def trim(self) -> None:
        """Keeps what is remembered within its bounds."""
        if len(self.groups) > KNOWN_WORDS or len(self.known) > 2 * KNOWN_WORDS:
            self.forget()
        for x in self.long:
            self.known.pop(x, None)
            self.odd.pop(x, None)
        self.long.clear()

    def measured(self, whole: list[str]) -> list[tuple[np.ndarray, bytes | None, np.ndarray, np.ndarray]]:
        """Per text: its four numbers, digest of its groups, its distinct pairs and how often each is linked."""
        totals = np.zeros((len(whole), 4), np.int64)
        digests = [hashlib.sha256() for _ in whole]
        begun, faulty = np.zeros(len(whole), bool), np.zeros(len(whole), bool)
        keys: list[np.ndarray] = []
        times: list[np.ndarray] = []
        for i, run in self.runs(whole):
            words = np.array(run)
            found = self.numbers[words]
            faulty[i] |= bool((found[:, 0] < 0).any())
            totals[i] += found.sum(0)
            if begun[i]:
                digests[i].update(b";")
            digests[i].update(b";".join(map(self.groups.__getitem__, run)))
            begun[i] = True
            width = np.maximum(found[:, 3], 0)
            ends = np.cumsum(width)
            pairs, n = np.unique(self.links[np.arange(ends[-1]) + np.repeat(self.starts[words] - ends + width, width)], return_counts=True)
            keys.append(pairs | i << 2 * ID_BITS)
            times.append(n)
        key = np.concatenate([np.zeros(0, np.int64), *keys])
        n = np.concatenate([np.zeros(0, np.int64), *times])
        if len(key) and (key[1:] <= key[:-1]).any():  # a very long text has several runs
            key, of = np.unique(key, return_inverse=True)
            n = np.bincount(of, n).astype(np.int64)
        bounds = np.searchsorted(key, np.arange(len(whole) + 1) << 2 * ID_BITS)
        pairs = key & (1 << 2 * ID_BITS) - 1
        none = np.zeros(0, np.int64)
        return [
            (np.zeros(4, np.int64), None, none, none) if faulty[i] or not begun[i] else (totals[i], digests[i].hexdigest(), pairs[j:k], n[j:k])
            for i, (j, k) in enumerate(pairwise(bounds.tolist()))
        ]


def _byte_letters() -> dict[int, str]:
    """The public letters of byte-level vocabularies: printable bytes stand for themselves, others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _regular(word: str) -> bool:
    body = word[1:] if word[:1] == "\n" else word
    return bool(body) and not body[0].isspace() and not body[-1].isspace()


def _odd_words(text: str) -> Iterator[str]:
    start = 0
    for cut in _ODD_CUT.finditer(text):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


_ALIGNED = "digest string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def aligned_texts(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """A row per distinct text that has characters: its digest, number of documents, numbers, pairs of ids and how often each is linked."""
    spark = docs.sparkSession
    ship(spark)
    piece_bpe.vocabulary(piece_path)  # a model of another kind fails here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = aligner.measured(batch.column(2).to_pylist())
                aligner.trim()
                numbers = np.stack([x[0] for x in found])
                ends = pa.array(np.cumsum([0, *[len(x[2]) for x in found]]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        *[pa.array(numbers[:, k]) for k in range(4)],
                        pa.array([x[1] or "" for x in found], pa.string()),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x[2] for x in found]))),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x[3] for x in found]).astype(np.int32))),
                    ],
                    ["digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    distinct = texts(docs).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    with arrow_batches(spark, BATCH_BYTES):
        return stored(distinct.select(F.sha2("text", 256).alias("digest"), "copies", "text").mapInArrow(run, _ALIGNED), "aligned-texts")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, n, best): documents in which the ids are linked, and whether n is the highest of the A id."""
    counts = aligned.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("n"))
    counts = counts.select("pair", F.shiftright("pair", ID_BITS).alias("a"), F.col("pair").bitwiseAND((1 << ID_BITS) - 1).alias("b"), "n")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))  # at most a row per id of A
    return counts.join(highest, "a").select("pair", "a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))


def measures(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = aligned_texts(docs, byte_path, piece_path)
    counts = stored(pair_counts(aligned), "pair-counts").select("pair", "n", "best")
    uses = aligned.select("digest", F.inline(F.arrays_zip("pairs", "times")))
    if counts.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS:
        uses = uses.join(F.broadcast(counts), uses["pairs"] == counts["pair"])
    else:  # frequent pairs are in most texts: their rows go over all strands
        uses = uses.withColumn("strand", F.pmod(F.xxhash64("digest"), F.lit(STRANDS)).cast("int"))
        strands = counts.withColumn("strand", F.explode(F.sequence(F.lit(0), F.lit(STRANDS - 1))))
        uses = uses.withColumnRenamed("pairs", "pair").join(strands, ["pair", "strand"])
    sums = uses.groupBy("digest").agg(F.sum(F.col("times") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"))
    found = stored(aligned.drop("pairs", "times").join(sums, "digest", "left"), "text-measures")
    rows = texts(docs).select("doc_id", F.sha2("text", 256).alias("digest"))
    wanted = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    out = joined_classes(rows, found, "digest", "copies")
    return out.select("doc_id", *[F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x) for x in wanted], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
