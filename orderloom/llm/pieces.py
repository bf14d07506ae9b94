"""Encode many texts through a bounded store of the pieces they share.

A single space or line break between two characters that are no white space always
starts a new match of the tokenizers' splitting pattern, so a text may be cut before
each, its pieces encoded apart and their ids joined. Texts with other runs of spaces
are encoded whole. The store only saves time: what it returns is what the encoder
returned.

Arrow cuts a batch of texts and numbers its distinct pieces, so only these are looked
up one by one; the ids of all occurrences are gathered from one array.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers; beyond it the store starts anew. Longer pieces are not remembered.
KNOWN_PIECES, LONG_PIECE = 800_000, 48
#: Begins a piece that has no space before it; texts that hold it are encoded whole. Letters that marks may follow.
_MARKED, _LETTERS = "\0", "a-zA-ZÀ-ÖØ-öø-ɏ"


def _cuttable(piece: str) -> bool:
    """Whether more than a line break is there, and no white space around that."""
    body = piece.strip()
    return bool(body) and len(body) == len(piece) - (piece[0] == "\n")


class Pieces:
    """``encode`` maps strings, each starting with its space or line break, to their ids as little-endian 32-bit integers.

    Where no match of the pattern holds a letter and one of ``marks`` after it, texts are cut there too.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], encode_whole: Callable[[list[str]], list[bytes]], marks: str = "") -> None:
        self._encode, self._encode_whole, self._marks = encode, encode_whole, marks
        self._clear()

    def _clear(self) -> None:
        self._known: dict[str, int] = {}  # the place of each piece, -1 if it leaves its text uncut
        self._ids = np.zeros(0, "<u4")  # of all pieces, one after the other
        self._ends, self._used = np.zeros(1, np.int64), 1  # the first place holds no ids

    def _add(self, found: list[bytes]) -> range:
        """Keeps the ids of some pieces; their places."""
        first, used = self._used, self._used + len(found)
        begin = int(self._ends[first - 1])
        ends = begin + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)
        end = int(ends[-1]) if found else begin
        if used > len(self._ends):
            self._ends = np.concatenate((self._ends, np.zeros(used, np.int64)))
        if end > len(self._ids):
            self._ids = np.concatenate((self._ids, np.zeros(end, "<u4")))
        self._ends[first:used], self._ids[begin:end] = ends, np.frombuffer(b"".join(found), "<u4")
        self._used = used
        return range(first, used)

    def _places(self, pieces: list[str]) -> np.ndarray:
        known = self._known
        places = list(map(known.get, pieces))
        if new := [x for x, place in zip(pieces, places, strict=True) if place is None]:
            known.update(dict.fromkeys(new, -1))
            fresh = [x for x in new if _cuttable(x)]
            after = [x for x in fresh if x[0] == _MARKED] if self._marks else []
            plain = [x for x in fresh if x[0] != _MARKED] if after else fresh
            known.update(zip(plain, self._add(self._encode([x if x[0] == "\n" else " " + x for x in plain])), strict=True))
            known.update(zip(after, self._add(self._encode_whole([x[1:] for x in after])), strict=True))
            places = [known[x] if place is None else place for x, place in zip(pieces, places, strict=True)]
        return np.array(places, np.int64)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        if len(self._known) > KNOWN_PIECES:
            self._clear()
        # a line break is a cut and stays with what follows it; the first piece has no such start
        barred = [k for k, x in enumerate(texts) if _MARKED in x] if self._marks else []
        spaced = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n")
        if barred:
            spaced = pc.if_else(np.isin(np.arange(len(texts)), barred), "", spaced)
        if self._marks:
            spaced = pc.replace_substring_regex(spaced, f"([{_LETTERS}])([{re.escape(self._marks)}])", rf"\1 {_MARKED}\2")
        cut = pc.split_pattern(spaced, " ")
        bounds, coded = cut.offsets.to_numpy(), cut.flatten().dictionary_encode()
        codes, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)
        first = bounds[:-1]
        heads = distinct.take(codes.take(first)).tolist()
        occurs = np.bincount(codes, minlength=len(distinct)) > np.bincount(codes.take(first), minlength=len(distinct))
        pieces = distinct[occurs]
        long = np.fromiter(map(len, pieces), np.int64, len(pieces)) > LONG_PIECE
        places = np.zeros(len(distinct), np.int64)
        kinds = np.flatnonzero(occurs)
        places[kinds[~long]] = self._places(pieces[~long].tolist())
        kept, forgotten = self._used, pieces[long].tolist()
        places[kinds[long]] = self._places(forgotten)
        at = places.take(codes)
        at[first] = 0
        joined = np.minimum.reduceat(at, first) >= 0
        joined &= (np.diff(bounds) == 1) | np.fromiter(map(_cuttable, heads), bool, len(heads))
        joined[barred] = False
        rows = np.flatnonzero(joined)
        at[first[rows]] = self._add(self._encode_whole([heads[k] for k in rows.tolist()]))
        # -1 of texts that are encoded whole reads the place without ids
        np.maximum(at, 0, out=at)
        begins = self._ends.take(at - 1, mode="clip")
        sizes = self._ends.take(at) - begins
        ends = np.cumsum(sizes)
        ids = self._ids.take(np.repeat(begins - ends + sizes, sizes) + np.arange(int(ends[-1]))).tobytes()
        bounds = np.concatenate(([0], 4 * ends)).take(bounds).tolist()
        out = [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        whole = np.flatnonzero(~joined).tolist()
        for i, own in zip(whole, self._encode_whole([texts[i] for i in whole]), strict=True):
            out[i] = own
        self._used = kept
        for x in forgotten:
            del self._known[x]
        return out
