"""Byte-level BPE by dynamic programming over prefixes.

The merges give every byte string one encoding, and a sequence of tokens is an
encoding exactly if each two neighbours are what the merges make of their bytes.
Hence each prefix of a piece has one last token: the token that ends there and forms
such a pair with the last token of the prefix before it. ``Encoding`` stores these
last tokens. Appending bytes goes on from the table, and an edit keeps the table up to
its first byte, so neither starts over; reading the table from its end gives the ids.

Text is first cut by the splitting pattern, and each match is encoded by itself.
Strings of special tokens are ordinary text. Null texts are empty, the empty text has
no ids. Decoding joins the tokens' bytes, which gives the text back exactly. Very long
texts are encoded whole, in time proportional to their length. Repeated rows and ids are
rows of their own, extra columns are ignored, an empty table gives an empty one; there are
no ties, as every prefix has one last token.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import ship, texts_of_batch
from orderloom.llm.pieces import LONG_PIECE, Pieces

#: Rows that a worker encodes at a time; matches of the pattern and pairs of tokens that it remembers.
ROWS, KNOWN_WORDS, KNOWN_PAIRS = 256, 1_000_000, 1 << 20


class Vocabulary:
    """Token bytes by id, the merges' ranks, and the test of neighbouring tokens."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.pattern = regex.compile(pattern)
        #: verdicts by left * 2**32 + right; left is one less than 0 for a token that stands alone
        self.pairs: dict[int, bool] = {}
        # tokens spelt from their end: (node * 256 + byte) -> node, and the token that ends at a node
        self.ending: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        for token, rank in self.ranks.items():
            node = 0
            for byte in reversed(token):
                after = self.ending.get(node << 8 | byte)
                if after is None:
                    after = self.ending[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                node = after
            self.token_at[node] = rank

    def _merged(self, data: bytes) -> list[int]:
        """Ids of a few bytes by merging the lowest rank first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            least = min((x for x in ranked if x is not None), default=None)
            if least is None:
                break
            at = ranked.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[x] for x in parts]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the merges keep the two tokens apart and whole; ``left`` is -1 at the start of a piece."""
        if len(self.pairs) >= KNOWN_PAIRS:
            self.pairs.clear()
        alone = left < 0
        known = self._merged(self.bytes_of[right] if alone else self.bytes_of[left] + self.bytes_of[right]) == ([right] if alone else [left, right])
        self.pairs[left << 32 | right] = known
        return known


class Encoding:
    """Last token of every prefix of one piece of bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self._of = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        begin, of, last = len(self.data), self._of, self.last
        ending, token_at, pairs = of.ending, of.token_at, of.pairs
        self.data = data = self.data + more
        for end in range(begin, len(data)):
            node, start = 0, end
            # tokens that end here, from the shortest on; one of them has the right neighbour
            while start >= 0:
                node = ending.get(node << 8 | data[start])
                if node is None:
                    raise ValueError(f"no token ends at byte {end + 1}; the vocabulary lacks a single byte")
                token = token_at[node]
                if token >= 0:
                    left = last[start - 1] if start else -1
                    known = pairs.get(left << 32 | token)
                    if known or (known is None and of.neighbours(left, token)):
                        last.append(token)
                        break
                start -= 1
            else:
                raise ValueError(f"no token ends at byte {end + 1}; the vocabulary lacks a single byte")

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Puts ``new`` in place of the bytes from ``start`` to ``stop``; prefixes up to ``start`` are kept."""
        rest = self.data[stop:]
        self.data = self.data[:start]
        del self.last[start:]
        self.append(new + rest)

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end -= len(self._of.bytes_of[out[-1]])
        return out[::-1]


@lru_cache(maxsize=2)
def _worker(path: str, pattern: str) -> tuple[Vocabulary, Pieces]:
    """One per Python worker, so that batches share what it remembers."""
    vocabulary = Vocabulary(path, pattern)

    words: dict[str, bytes] = {}

    def word(text: str) -> bytes:
        if (known := words.get(text)) is None:
            known = np.array(Encoding(vocabulary, text.encode()).ids(), "<u4").tobytes()
            if len(text) <= LONG_PIECE:
                if len(words) >= KNOWN_WORDS:
                    words.clear()
                words[text] = known
        return known

    def each(texts: list[str]) -> list[bytes]:
        return [b"".join(map(word, vocabulary.pattern.findall(x))) for x in texts]

    return vocabulary, Pieces(each, each)


def encode(texts: list[str], path: str, pattern: str) -> list[np.ndarray]:
    """Ids of each text."""
    return [np.frombuffer(x, "<u4") for x in _worker(path, pattern)[1](texts)]


def decode(ids: list[np.ndarray], path: str, pattern: str) -> list[bytes]:
    bytes_of = _worker(path, pattern)[0].bytes_of
    return [b"".join(map(bytes_of.__getitem__, x.tolist())) for x in ids]


def coded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) per row: ids of the whole text, and the bytes they decode to."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids = encode(texts_of_batch(batch).to_pylist(), path, pattern)
                ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                values = np.concatenate(ids).astype(np.int32) if len(ids) else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), lists, pa.array(decode(ids, path, pattern), pa.binary())], ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
