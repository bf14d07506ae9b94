"""SentencePiece encoding of whole texts by vectorised merge rounds.

Text is escaped as the library does it (a space in front, spaces as U+2581) and its
characters are laid out as one flat array of symbols. Two neighbours that no piece
holds side by side can never end up in one piece, so every such place begins a new
segment. In each round all segments find their pair of lowest rank at once
(a segmented minimum), join its occurrences from the left without overlap, and the
arrays are compacted; segments without a pair leave. Joining all occurrences at once is
what the library's queue does one by one, unless the joined piece can form a pair of no
higher rank than its own. Such pieces are known beforehand, and of their pairs only a
segment's leftmost is joined per round. Segments of over ``LONG`` symbols would need too many
rounds; they take the same merges in the same order from a heap.

Characters that are no piece fall back to the byte pieces of their UTF-8. Texts are
cut before spaces and around line breaks where no piece spans the cut, and a bounded
store, emptied at the end of each task, keeps the ids of pieces of text seen before.

Null texts are empty; the empty text has no ids but begin and end. Very long texts
are cut into runs of ``RUN`` pieces of text that are encoded one after the other. Repeated rows
and ids are rows of their own, extra columns are ignored, an empty table gives an
empty one, and equal ranks are joined from the left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.common import ship, texts, texts_of_batch

#: Rows that a worker encodes at a time, and pieces of text of a row.
ROWS, RUN = 256, 1 << 18
#: Pieces of text that a worker remembers within a task; longer ones are not remembered.
KNOWN_PIECES, LONG_PIECE = 250_000, 48
#: Symbols from which a segment takes its merges from a heap.
LONG = 1_024
#: Bits of a symbol: ids of pieces, and after them all code points.
SYMBOL_BITS = 21
#: Rank of a pair that no piece joins.
NONE = np.iinfo(np.int32).max

SPACE = "▁"
#: What the library writes for the unknown id.
UNKNOWN = " \u2047 "
_CUT = re.compile(r" *[^ \n]+| +|\n")


class PieceVocabulary:
    """Pieces, their ranks, and the joins of a model whose text is not normalised and that has byte pieces."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = self.size = model.vocab_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        names = [model.id_to_piece(i) for i in range(n)]
        self.is_byte = np.array([model.is_byte(i) for i in range(n)])
        byte_ids = np.flatnonzero(self.is_byte)
        if len(byte_ids) != 256 or n > (1 << SYMBOL_BITS) - 0x110000:
            raise ValueError(f"{path}: a model with 256 byte pieces and less than {(1 << SYMBOL_BITS) - 0x110000} pieces is needed")
        self.byte_id = np.zeros(256, np.int64)
        for i in byte_ids.tolist():
            self.byte_id[int(names[i][1:-1], 16)] = i
        self.silent = np.array([model.is_control(i) for i in range(n)])
        self.bytes_of = [
            b"" if self.silent[i] else bytes([int(names[i][1:-1], 16)]) if self.is_byte[i] else names[i].replace(SPACE, " ").encode() for i in range(n)
        ]
        self.bytes_of[model.unk_id()] = UNKNOWN.encode()
        self.ids = {names[i]: i for i in range(n) if not (self.silent[i] or self.is_byte[i] or model.is_unknown(i) or model.is_unused(i))}
        self.spaced = np.zeros(n, bool)
        self.spaced[[i for x, i in self.ids.items() if x[0] == SPACE]] = True
        scores = np.array([model.get_score(i) for i in range(n)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self._prepare()
        probe = ["", " a  b ", "\n", "tokens of <s> 12345 ", SPACE + "ñ 日本\t🙂\0"]
        if [[self.begin, *np.frombuffer(x, "<u4").tolist(), self.end] for x in self.encode(probe)] != model.encode(probe, add_bos=True, add_eos=True):
            raise ValueError(f"{path}: not a BPE model with an identity normaliser, a dummy prefix and byte pieces")

    def _prepare(self) -> None:
        self.char_symbol = np.arange(0x110000, dtype=np.int64) + self.size
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.char_symbol[ord(piece)] = i
        joins: dict[int, int] = {}
        bigrams: set[int] = set()
        self.leftmost = np.zeros(self.size, bool)
        for piece, i in self.ids.items():
            bigrams.update(ord(a) << SYMBOL_BITS | ord(b) for a, b in zip(piece, piece[1:], strict=False))
            for at in range(1, len(piece)):
                parts = [int(self.char_symbol[ord(x)]) if len(x) == 1 else self.ids.get(x) for x in (piece[:at], piece[at:])]
                if None not in parts:
                    joins[parts[0] << SYMBOL_BITS | parts[1]] = i
                    for part in parts:
                        if part < self.size and self.rank[i] <= self.rank[part]:
                            self.leftmost[part] = True
        self._joins = joins
        self.join_keys = np.array(sorted(joins), np.int64)
        self.join_ids = np.array([joins[k] for k in self.join_keys.tolist()], np.int64)
        self.bigrams = np.array(sorted(bigrams), np.int64)
        self.breaks_apart = not any("\n" in x and len(x) > 1 for x in self.ids) and not any(SPACE in x.lstrip(SPACE) for x in self.ids)
        self.lengths = np.array([len(x) for x in self.bytes_of], np.int64)
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece that joins each pair of symbols, and its rank; NONE where there is none."""
        keys = left << SYMBOL_BITS | right
        at = np.minimum(np.searchsorted(self.join_keys, keys), len(self.join_keys) - 1)
        piece = self.join_ids[at]
        return piece, np.where(self.join_keys[at] == keys, self.rank[piece], NONE)

    def _rounds(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left when no pair remains, and the place of each one's first character."""
        place = np.arange(len(symbols))
        piece, rank = np.zeros(len(symbols), np.int64), np.full(len(symbols), NONE, np.int32)
        piece[:-1], rank[:-1] = self._pair(symbols[:-1], symbols[1:])
        rank[:-1][first[1:]] = NONE
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(first)
            sizes = np.diff(np.append(starts, len(symbols)))
            least = np.minimum.reduceat(rank, starts)
            if (least == NONE).any():
                over = np.repeat(least == NONE, sizes)
                done.append((symbols[over], place[over]))
                symbols, place, piece, rank, first = (x[~over] for x in (symbols, place, piece, rank, first))
                sizes, least = sizes[least < NONE], least[least < NONE]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == np.repeat(least, sizes))
            # every second one of hits side by side, from the left; the last symbol of a segment is no hit
            nth = np.arange(len(hits))
            begins = np.append(True, np.diff(hits) > 1)
            chosen = (nth - np.maximum.accumulate(np.where(begins, nth, 0))) % 2 == 0
            if self.leftmost[piece[hits]].any():
                segment = np.searchsorted(np.cumsum(sizes), hits, "right")
                chosen &= ~self.leftmost[piece[hits]] | np.append(True, np.diff(segment) > 0)
            hits = hits[chosen]
            symbols[hits] = piece[hits]
            kept = np.ones(len(symbols), bool)
            kept[hits + 1] = False
            symbols, place, piece, rank, first = (x[kept] for x in (symbols, place, piece, rank, first))
            hits -= np.arange(len(hits))
            changed = np.concatenate((hits, hits[~first[hits]] - 1))
            rank[changed] = NONE
            changed = changed[changed + 1 < len(symbols)]
            changed = changed[~first[changed + 1]]
            piece[changed], rank[changed] = self._pair(symbols[changed], symbols[changed + 1])
        if not done:
            return symbols, place
        symbols, place = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(place)
        return symbols[order], place[order]

    def _heap(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """Symbols left of one segment and their first places, merging the lowest rank first, from the left."""
        n, joins, rank = len(symbols), self._joins, self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n

        def found(i: int) -> tuple[int, int, int, int] | None:
            j = after[i]
            piece = joins.get(symbols[i] << SYMBOL_BITS | symbols[j]) if j < n else None
            return None if piece is None else (int(rank[piece]), i, symbols[i], symbols[j])

        queue = [x for x in map(found, range(n)) if x is not None]
        heapify(queue)
        while queue:
            _, i, left, right = heappop(queue)
            j = after[i] if alive[i] else n
            if j >= n or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], alive[j], after[i] = joins[left << SYMBOL_BITS | right], False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (pair := found(k)) is not None:
                    heappush(queue, pair)
        places = [i for i in range(n) if alive[i]]
        return [symbols[i] for i in places], places

    def encode_escaped(self, words: list[str]) -> list[bytes]:
        """Ids of each string, in which spaces are U+2581 already, as little-endian 32-bit integers."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        if not len(points):
            return [b""] * len(words)
        ends = np.cumsum([len(x) for x in words])
        first = np.zeros(len(points), bool)
        first[0] = True
        first[ends[:-1][ends[:-1] < len(points)]] = True
        keys = points[:-1] << SYMBOL_BITS | points[1:]
        if len(self.bigrams):
            first[1:] |= self.bigrams[np.minimum(np.searchsorted(self.bigrams, keys), len(self.bigrams) - 1)] != keys
        else:
            first[:] = True
        symbols = self.char_symbol[points]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(points)))
        if (long := np.flatnonzero(sizes > LONG)).size:
            parts, places = [], []
            for k in long.tolist():
                got = self._heap(symbols[starts[k] : starts[k] + sizes[k]].tolist())
                parts.append(got[0])
                places.append(np.array(got[1]) + starts[k])
            short = np.repeat(sizes <= LONG, sizes)
            left, at = self._rounds(symbols[short], first[short])
            symbols = np.concatenate((left, *parts))
            place = np.concatenate((np.flatnonzero(short)[at], *places))
            order = np.argsort(place)
            symbols, place = symbols[order], place[order]
        else:
            symbols, place = self._rounds(symbols, first)
        # characters without a piece as the byte pieces of their UTF-8
        point = symbols - self.size
        width = np.where(point < 0, 1, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))
        ids = np.repeat(symbols, width)
        if (bare := np.repeat(point, width) >= 0).any():
            nth = (np.arange(len(ids)) - np.repeat(np.cumsum(width) - width, width))[bare]
            of, bytes_ = np.repeat(point, width)[bare], np.repeat(width, width)[bare]
            lead = np.where(bytes_ == 1, 0, (0xFF << (8 - bytes_)) & 0xFF)
            ids[bare] = self.byte_id[np.where(nth == 0, lead, 0x80) | (of >> 6 * (bytes_ - 1 - nth)) & np.where(nth == 0, 0x7F, 0x3F)]
        bounds = np.append(0, np.cumsum(width))[np.searchsorted(place, np.append(0, ends))] * 4
        data, cuts = ids.astype("<u4").tobytes(), bounds.tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode(self, whole: list[str], known: dict[str, bytes] | None = None) -> list[bytes]:
        """Ids of each text without begin and end; ``known`` keeps those of its pieces of text."""
        known = {} if known is None else known
        if not self.breaks_apart:
            return self.encode_escaped([SPACE + x.replace(" ", SPACE) if x else "" for x in whole])
        out = []
        # an escape sign in a text is a space; a text of many pieces goes in runs
        escaped = [" " + x.replace(SPACE, " ") if x else "" for x in whole]
        small = [_CUT.findall(x) if len(x) <= RUN else None for x in escaped]
        long = self.learn({y for x in small if x is not None for y in x}, known)
        for text, cut in zip(escaped, small, strict=True):
            if cut is None:
                out.append(b"".join(self._long(text, known)))
            else:
                out.append(b"".join(map(known.__getitem__, cut)))
        for x in long:
            del known[x]
        return out

    def _long(self, text: str, known: dict[str, bytes]) -> Iterator[bytes]:
        cuts = (m[0] for m in _CUT.finditer(text))
        while run := list(islice(cuts, RUN)):
            long = self.learn(set(run), known)
            yield b"".join(map(known.__getitem__, run))
            for x in long:
                del known[x]

    def learn(self, pieces: set[str], known: dict[str, bytes]) -> list[str]:
        """Puts the ids of pieces of text into ``known``; returns the new ones that are too long to stay there."""
        new = list(pieces.difference(known))
        known.update(zip(new, self.encode_escaped([x.replace(" ", SPACE) for x in new]), strict=True))
        return [x for x in new if len(x) > LONG_PIECE]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of ids: byte pieces as UTF-8 with U+FFFD for what is none, escapes as spaces, the first space gone."""
        if not ids:
            return []
        flat = np.concatenate(ids).astype(np.int64)
        width = self.lengths[flat]
        ends = np.append(0, np.cumsum(width))
        source = np.arange(ends[-1]) + np.repeat(self.starts[flat] - ends[:-1], width)
        data = self.flat[source].tobytes()
        cuts = ends[np.append(0, np.cumsum([len(x) for x in ids]))].tolist()
        out = []
        for x, a, b in zip(ids, cuts, cuts[1:], strict=False):
            try:
                # a piece without text parts the byte pieces before it from those after it
                text = self._repaired(x) if (self.lengths[x[1:-1]] == 0).any() else data[a:b].decode()
            except UnicodeDecodeError:
                text = self._repaired(x)
            heard = x[~self.silent[x]][:1]
            out.append(text[1:] if len(heard) and self.spaced[heard[0]] else text)
        return out

    def _repaired(self, ids: np.ndarray) -> str:
        """Text of ids whose runs of byte pieces are not all UTF-8."""
        out, run = [], b""
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.bytes_of[i]
                continue
            while run:
                try:
                    out.append(run.decode())
                    run = b""
                except UnicodeDecodeError as bad:
                    out.append(run[: bad.start].decode() + "�")
                    run = run[bad.start + 1 :]
            out.append(self.bytes_of[i].decode() if i >= 0 else "")
        return "".join(out)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> PieceVocabulary:
    """One per process."""
    return PieceVocabulary(path)


def coded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids binary, decoded string) per row: little-endian 32-bit ids with begin and end, and the text they decode to."""
    ship(docs.sparkSession)
    vocabulary(path)  # a model of another kind fails here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = vocabulary(path)
        begin, end = (np.array([x], "<u4").tobytes() for x in (of.begin, of.end))
        known: dict[str, bytes] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                if len(known) > KNOWN_PIECES:
                    known.clear()
                ids = [begin + x + end for x in of.encode(texts_of_batch(batch).to_pylist(), known)]
                decoded = of.decode([np.frombuffer(x, "<u4") for x in ids])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"]
                )

    return texts(docs).mapInArrow(run, "doc_id long, ids binary, decoded string")
