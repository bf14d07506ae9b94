"""Toxicity: a classifier whose score must not change when identity terms are swapped.

Features are the distinct words of a text (Unicode letters with their marks, case
folded) and the words' first four to eight letters; scripts written without blanks have
all their runs of one to six letters instead, at every position. Which features count is decided by a likelihood-ratio test
against the labels, in one distributed aggregation. A logistic model on them is fitted
by full-batch descent, with some features hidden at each step so that a single word can
decide, on

    mean log loss + ridge * |w|^2 + fairness * mean (z(x) - z(x'))^2

where x' is the same labelled sentence with every identity term replaced by its
counterpart of the same kind. A term that stands in many toxic texts, but isn't what
makes them toxic, so loses its weight to the words beside it.

At most ``TRAINING_ROWS`` labelled rows are used to fit, chosen by a hash of their ids, and
at most ``FEATURES`` features, those of the largest likelihood ratio (of equal ones the smaller
hash); every text is scored whole, however long. Other columns pass through, one named
``toxic_score`` is replaced; an empty table gives an empty one. Null texts are empty; the score of a text without any known
feature is the share of toxic rows that the model expects among such texts. Without
labels, or with one class only, the score is the smoothed share of toxic labels. Rows
are scored one by one, so repeated rows have equal scores. An id labelled twice is
toxic if any of its labels says so.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import common
from orderloom.llm.common import mix, sampled, ship, slices, texts, texts_of_batch

#: Labelled rows that are used to fit, at most.
TRAINING_ROWS = 10_000
#: Features of the model, at most.
FEATURES = 4_096
#: Least number of training rows with a feature, and least likelihood ratio of its association with the label.
LEAST_ROWS, LEAST_RATIO = 3, 15.0
PREFIXES = (4, 5, 6, 7, 8)
#: Lengths of the runs of letters in scripts without blanks.
GRAMS = (1, 2, 3, 4, 5, 6)
#: Share of a row's features that a step of training sees.
SHOWN = 0.7

#: Identity terms by kind; within a kind each stands for any other in a neutral sentence. Fixed values, to be extended by the caller.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("girls", "boys"), ("female", "male"), ("mother", "father"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("american", "german", "french", "spanish", "mexican", "chinese", "indian", "turkish"), ("immigrant", "citizen", "refugee"),
    ("old", "young"), ("deaf", "blind", "disabled"), ("frau", "mann"), ("frauen", "männer"), ("femme", "homme"), ("femmes", "hommes"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("christ", "muslim", "jude"), ("chrétien", "musulman", "juif"), ("cristiano", "musulmán", "judío"),
)


@dataclass
class Model:
    """Features as sorted hashes, their weights, and the offset."""

    offset: float
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))


#: Thai, Lao, Tibetan, Myanmar, Khmer, New Tai Lue and Tai Tham, kana, Han, Yi, Javanese, Myanmar and Tai Viet, kana halves and supplements, Han.
_WITHOUT_BLANKS = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
    (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x323AF),
)
_NONE, _LETTER, _DENSE, _MARK = range(4)
_POINTS = 0x323B1  # no letters from the last on


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Folded form and kind of each code point."""
    folded, kinds = np.arange(_POINTS, dtype=np.uint32), np.zeros(_POINTS, np.uint8)
    for point in range(_POINTS):
        char = chr(point)
        if char.isalpha():
            kinds[point] = _LETTER
            low = char.casefold()
            folded[point] = ord(low if len(low) == 1 else char.lower()[0])
        elif unicodedata.category(char)[0] == "M":
            kinds[point] = _MARK
    for first, last in _WITHOUT_BLANKS:
        part = kinds[first : last + 1]
        part[part == _LETTER] = _DENSE
    return folded, kinds


def _points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of consecutive texts in UTF-8, and the texts' offsets among them."""
    if not len(data) or data.max() < 128:
        return data, offsets
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = data[at].astype(np.uint32)
    wide = np.flatnonzero(points >= 0xC0)
    lead = points[wide]
    after = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.uint32) & 0x3F
    second, third, fourth = (after[at[wide] + k] for k in (1, 2, 3))
    four = ((lead & 7) << 18) | (second << 12) | (third << 6) | fourth
    points[wide] = np.where(lead < 0xE0, ((lead & 0x1F) << 6) | second, np.where(lead < 0xF0, ((lead & 0xF) << 12) | (second << 6) | third, four))
    return np.minimum(points, _POINTS - 1), np.searchsorted(at, offsets)


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of consecutive texts, not yet distinct, and the index of the text of each."""
    points, offsets = _points(data, offsets)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    folded, kinds = _tables()
    kind, points = kinds[points], folded[points]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    if (marks := kind == _MARK).any():
        # a mark belongs to the letter before it; without one it is no letter
        kind[heads[marks[heads]]] = _NONE
        base = np.maximum.accumulate(np.where(kind == _MARK, 0, np.arange(len(kind))))
        kind = kind[base]
    change = np.concatenate(([True], kind[1:] != kind[:-1]))
    change[heads] = True
    starts = np.flatnonzero(change)
    stops = np.append(starts[1:], len(kind))
    kind = kind[starts]
    power, inverse = common._powers(len(points))
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[: len(points)], out=sums[1:])

    def hashed(begins: np.ndarray, ends: np.ndarray, tag: int = 0) -> np.ndarray:
        return mix((sums[ends] - sums[begins]) * inverse[begins] + np.uint64(tag << 56))

    words, dense = kind == _LETTER, kind == _DENSE
    begins, ends = starts[words], stops[words]
    of = np.searchsorted(offsets, begins, "right") - 1
    hashes, owners = [hashed(begins, ends)], [of]
    for n in PREFIXES:
        long = ends - begins > n
        hashes.append(hashed(begins[long], begins[long] + n, n))
        owners.append(of[long])
    if dense.any():
        lengths = stops[dense] - starts[dense]
        ends = np.repeat(stops[dense], lengths)
        begins = ends - np.repeat(np.cumsum(lengths), lengths) + np.arange(len(ends))
        of = np.searchsorted(offsets, begins, "right") - 1
        for n in GRAMS:
            fits = ends - begins >= n
            hashes.append(hashed(begins[fits], begins[fits] + n, 64 + n))
            owners.append(of[fits])
    return np.concatenate(hashes), np.concatenate(owners)


def _known(hashes: np.ndarray, of: np.ndarray, features: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, place of the feature) of the known features."""
    if not len(features) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    maybe = np.zeros(1 << 16, bool)
    maybe[(features & np.uint64(0xFFFF)).astype(np.int64)] = True
    hit = np.flatnonzero(maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    place = np.minimum(np.searchsorted(features, hashes[hit]), len(features) - 1)
    same = features[place] == hashes[hit]
    pairs = np.unique(of[hit[same]] * len(features) + place[same])
    return pairs // len(features), pairs % len(features)


def _swapper():
    kinds = {term: kind for kind in IDENTITY_TERMS for term in kind}
    pattern = re.compile(r"\b(?:" + "|".join(sorted(kinds, key=len, reverse=True)) + r")\b", re.IGNORECASE)

    def swap(text: str) -> str:
        def other(found: re.Match) -> str:
            kind = kinds[found[0].lower()]
            return kind[(kind.index(found[0].lower()) + 1) % len(kind)]

        return pattern.sub(other, text)

    return swap


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, rows, toxic rows) of each batch."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for first, data, offsets in slices(texts_of_batch(batch)):
            hashes, of = word_features(data, offsets)
            order = np.lexsort((of, hashes))
            hashes, of = hashes[order], of[order]
            new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1]))) if len(hashes) else np.zeros(0, bool)
            hashes, of = hashes[new], of[new]
            found, starts, rows = np.unique(hashes, return_index=True, return_counts=True)
            if len(found):
                bad = np.add.reduceat(toxic[first + of].astype(np.int64), starts)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(rows), pa.array(bad)], ["feature", "rows", "toxic"])


def _rows(features: np.ndarray):
    swap = _swapper()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, column = batch.num_rows, texts_of_batch(batch)
            swapped = pa.array([swap(x) for x in column.to_pylist()], pa.string())
            out = [[[] for _ in range(n)], [[] for _ in range(n)]]
            for side, array in zip(out, (column, swapped), strict=True):
                for first, data, offsets in slices(array):
                    for i, place in zip(*_known(*word_features(data, offsets), features, n), strict=True):
                        side[first + i].append(place)
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), *(pa.array(x, pa.list_(pa.int64())) for x in out)], ["toxic", "own", "swapped"])

    return run


def _matrix(lists: list) -> tuple[np.ndarray, np.ndarray]:
    of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return of, np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(of) else np.zeros(0, np.int64)


def gradient(
    w: np.ndarray, b: float, toxic: np.ndarray, shown: tuple, own: tuple, swapped: tuple, ridge: float, fairness: float, counts: np.ndarray | None = None
) -> np.ndarray:
    """Gradient by the weights and the offset of mean log loss + ridge * |w|^2 + fairness * mean (z(x) - z(x'))^2.

    ``shown``, ``own`` and ``swapped`` list (row, feature): of the features that the loss
    sees, of all, and of those of the swapped sentences. Rows not in ``counts`` have no loss.
    """
    n, size = len(toxic), len(w)
    (rk, ck), (ro, co), (rs, cs) = shown, own, swapped
    z = np.bincount(rk, w[ck], n)
    error = (1 / (1 + np.exp(-np.clip(z + b, -30, 30))) - toxic) / n
    if counts is not None:
        error = np.where(counts, error, 0.0)
    pull = 2 * fairness / n * (np.bincount(ro, w[co], n) - np.bincount(rs, w[cs], n))
    g = np.bincount(ck, error[rk], size) + np.bincount(co, pull[ro], size) - np.bincount(cs, pull[rs], size) + 2 * ridge * w
    return np.append(g, error.sum())


def _descend(toxic: np.ndarray, own: list, swapped: list, size: int, ridge: float, fairness: float, steps: int, seed: int = 9) -> tuple[float, np.ndarray]:
    n = len(toxic)
    (ro, co), (rs, cs) = _matrix(own), _matrix(swapped)
    has = np.bincount(ro, minlength=n) > 0
    random = np.random.default_rng(seed)
    w, b = np.zeros(size), float(np.log((toxic.sum() + 1) / (n - toxic.sum() + 1)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        # some features are hidden at each step, so that none relies on the others
        seen = random.random(len(co)) < SHOWN
        shown = ro[seen], co[seen]
        blind = has & (toxic > 0) & (np.bincount(shown[0], minlength=n) == 0)
        g = gradient(w, b, toxic, shown, (ro, co), (rs, cs), ridge, fairness, ~blind)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return float(b), w


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, ridge: float = 2e-6, fairness: float = 1.0, steps: int = 600) -> Model:
    """Fit on at most ``rows`` of the labelled rows of ``labels`` (doc_id, toxic)."""
    ship(docs.sparkSession)
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    marked = marked.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = sampled(marked, "doc_id", rows).toPandas()  # at most ``rows`` pairs of numbers
    n, bad = len(chosen), int(chosen["toxic"].sum())
    if bad in (0, n):
        return Model(float(np.log((bad + 1) / (n - bad + 1))))
    small = docs.sparkSession.createDataFrame(chosen)
    sample = texts(docs).join(F.broadcast(small), "doc_id").select("doc_id", "toxic", "text")
    counted = sample.mapInArrow(_count, "feature long, rows long, toxic long")
    counted = counted.groupBy("feature").agg(F.sum("rows").alias("rows"), F.sum("toxic").alias("toxic"))
    share = bad / n
    with_toxic = F.col("toxic") * F.log(F.col("toxic") / (F.col("rows") * share))
    clean = F.col("rows") - F.col("toxic")
    with_clean = F.when(clean > 0, clean * F.log(clean / (F.col("rows") * (1 - share)))).otherwise(0.0)
    ratio = (2 * (with_toxic + with_clean)).alias("ratio")
    top = counted.where((F.col("rows") >= LEAST_ROWS) & (F.col("toxic") > F.col("rows") * share)).select("feature", ratio)
    top = top.where(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "feature").limit(FEATURES).toPandas()
    features = np.sort(top["feature"].to_numpy(np.int64).view(np.uint64))
    known = sample.mapInArrow(_rows(features), "toxic int, own array<long>, swapped array<long>").toPandas()
    if not len(known):
        return Model(float(np.log((bad + 1) / (n - bad + 1))))
    offset, weights = _descend(known["toxic"].to_numpy(float), list(known["own"]), list(known["swapped"]), len(features), ridge, fairness, steps)
    return Model(offset, features, weights)


def scorer(model: Model):
    """A function of a text column that gives the score, 0 to 1; null texts count as empty."""

    @F.pandas_udf("double")
    def scored(series):
        out = np.full(len(series), model.offset)
        for first, data, offsets in slices(pa.array(series.fillna(""), pa.string())):
            of, place = _known(*word_features(data, offsets), model.features, len(offsets) - 1)
            out[first : first + len(offsets) - 1] += np.bincount(of, model.weights[place], len(offsets) - 1)
        return type(series)(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return scored


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``toxic_score`` (0 to 1); a column of that name is replaced."""
    ship(docs.sparkSession)
    return docs.withColumn("toxic_score", scorer(model)(F.col("text").cast("string")))
