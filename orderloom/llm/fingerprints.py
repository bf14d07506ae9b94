"""Document fingerprints from closed syncmers.

A k-mer of the text's bytes is a closed syncmer if the smallest hash among its inner
s-mers is the first or the last of them. Whether a k-mer is chosen depends on nothing
around it, so an unchanged passage keeps its anchors wherever it moves. A fingerprint
holds all anchors in text order, or, if ``anchors`` is given, those with the smallest
hashes; of equal hashes the first place counts. It is written as "~" and the base64 of
the number of anchors and their hashes, four bytes each (high byte first), and of the
distances of their byte positions from the one before: a byte below 255 ends a distance,
255 adds to it. Eight hex digits of hash and eight of position for each anchor are read
as well. A text without any syncmer, such as one shorter than k bytes, has one anchor
made of the whole text; the empty text has the empty fingerprint.

The likeness of two fingerprints is the share of anchors that match in the same order
(the longest run of matches that ascends in both), as Dice's coefficient from 0 to 1.
Equal texts have equal fingerprints and likeness 1, two empty ones included. Null texts
are empty. Work per document is linear in its length; nothing is cut off. Repeated rows
and ids are rows of their own, extra columns are ignored, an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm import common
from orderloom.llm.common import mix, slices
from orderloom.llm.neighbours import with_next

#: Bytes of an anchor's window and of its inner strings: two of k - s + 1 places are anchors. At these the
#: fingerprint has two thirds of its text's size; at a window of 16 bytes it has 1.2 times that.
K, S = 24, 6

#: Distinct hashes of the anchors in text order, and their byte positions.
Anchors = tuple[np.ndarray, np.ndarray]


def _anchors(data: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 32-bit hashes of the closed syncmers of consecutive texts, as if they were one."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    power, inverse = common._powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    inner = mix((sums[s:] - sums[:-s]) * inverse[: len(data) - s + 1])
    width, have = k - s + 1, 1
    least = inner
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    at = np.flatnonzero((inner[:n] == least[:n]) | (inner[width - 1 : width - 1 + n] == least[:n]))
    return at, (mix((sums[at + k] - sums[at]) * inverse[at]) >> np.uint64(32)).astype(np.uint32)


def _taken(documents: list[str], k: int, s: int, anchors: int | None) -> list[Anchors]:
    out = []
    for _, data, offsets in slices(pa.array(documents, pa.large_string())):
        at, hashes = _anchors(data, k, s)
        lows, highs = np.searchsorted(at, offsets[:-1]), np.searchsorted(at, offsets[1:] - k, "right")
        for low, high, begin, end in zip(lows.tolist(), highs.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            own = hashes[low:high]
            if begin == end:
                out.append((np.zeros(0, np.uint32), np.zeros(0, np.int64)))
                continue
            if high <= low:
                out.append((np.array([int(hashlib.sha256(data[begin:end].tobytes()).hexdigest()[:8], 16)], np.uint32), np.zeros(1, np.int64)))
                continue
            # of equal hashes the first place counts
            order = np.argsort(own, kind="stable")
            order = np.sort(order[np.concatenate(([True], own[order][1:] != own[order][:-1]))][:anchors])
            out.append((own[order], at[low:high][order] - begin))
    return out


def _written(taken: Anchors) -> str:
    hashes, places = taken
    if not len(hashes):
        return ""
    full, rest = np.divmod(np.diff(places, prepend=0), 255)
    steps = np.full(int(full.sum()) + len(rest), 255, np.uint8)
    steps[np.cumsum(full + 1) - 1] = rest
    return "~" + base64.b64encode(len(hashes).to_bytes(4, "big") + hashes.astype(">u4").tobytes() + steps.tobytes()).decode()


def _read(fingerprint: str) -> Anchors:
    if not fingerprint.startswith("~"):
        pairs = np.frombuffer(bytes.fromhex(fingerprint), ">u4").reshape(-1, 2)
        return pairs[:, 0].astype(np.uint32), pairs[:, 1].astype(np.int64)
    raw = base64.b64decode(fingerprint[1:])
    n = int.from_bytes(raw[:4], "big")
    steps = np.frombuffer(raw, np.uint8, offset=4 + 4 * n)
    return np.frombuffer(raw, ">u4", n, 4).astype(np.uint32), np.cumsum(steps, dtype=np.int64)[steps < 255]


def fingerprints(documents: list[str], k: int = K, s: int = S, anchors: int | None = None) -> list[str]:
    return [_written(x) for x in _taken(documents, k, s, anchors)]


def _split(fingerprint: str) -> dict[int, int]:
    hashes, places = _read(fingerprint)
    return dict(zip(hashes.tolist(), places.tolist(), strict=True))


def _alike(one: Anchors, other: Anchors, anchors: int | None) -> float:
    if np.array_equal(one[0], other[0]) and np.array_equal(one[1], other[1]):
        return 1.0
    shared, a, b = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    union = len(one[0]) + len(other[0]) - len(shared)
    if anchors is not None and union > anchors:
        least = shared <= np.union1d(one[0], other[0])[anchors - 1]
        a, b, union = a[least], b[least], anchors
    if not len(a):
        return 0.0
    places = other[1][b][np.argsort(one[1][a], kind="stable")]
    found = len(places)
    if (places[1:] <= places[:-1]).any():
        ends: list[int] = []
        for x in places.tolist():
            at = bisect_left(ends, x)
            ends[at : at + 1] = [x]
        found = len(ends)
    jaccard = found / union
    return 2 * jaccard / (1 + jaccard)


def likeness(one: str, other: str, anchors: int | None = None) -> float:
    return _alike(_read(one), _read(other), anchors)


def half_replaced(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprinted(docs: DataFrame, k: int = K, s: int = S, anchors: int | None = None) -> DataFrame:
    """Per row its fingerprint, that of its text with the last half replaced by the next text's beginning, and likenesses.

    "Next" is in ascending doc_id order, rows without id first and rows that share an
    id in text order; after the last comes the first. An empty table has no rows.
    """

    def work(ids: list, own: list[str], following: list[str]) -> pa.RecordBatch:
        edited = [half_replaced(x, y) for x, y in zip(own, following, strict=True)]
        prints = _taken([*own, following[-1]], k, s, anchors)
        next_prints = prints[1:]  # but where a bucket of ids ends inside the run
        odd = [i for i in range(len(own) - 1) if following[i] != own[i + 1]]
        for i, x in zip(odd, _taken([following[i] for i in odd], k, s, anchors), strict=True):
            next_prints[i] = x
        changed = _taken(edited, k, s, anchors)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(x) for x in own], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
                pa.array([_written(x) for x in prints[:-1]], pa.string()),
                pa.array([_written(x) for x in changed], pa.string()),
                pa.array([_alike(x, y, anchors) for x, y in zip(prints, changed, strict=False)], pa.float64()),
                pa.array([_alike(x, y, anchors) for x, y in zip(prints, next_prints, strict=False)], pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return with_next(docs, work, SCHEMA)
