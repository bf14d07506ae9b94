"""Language-model scores from a hidden Markov model.

Words are counted over all training texts. The most frequent ones are emitted as
symbols of their own, every other word as the class of its last two bytes, so the
alphabet with which the chain is trained has a fixed size. In the last round the
expected counts of every other training word in every state are added up as well, as a
table of words: in a state, a word then has the class's probability times its share of
the class there; an unseen word has the share of one unseen type. Counts by state are
drawn towards the usual shares of the states, the more the rarer the word is; a word that
occurs once tells no states apart and has the usual shares. So every training word has emissions of its own, and the
vocabulary is as large as the corpus.

Baum-Welch runs over all training texts, each as a whole: the forward recursion leaves
its vector at the start of every window, and the windows are then done from the last to
the first, each forward again from there and backward from the vector of the next one.
So many texts are advanced at once, memory is bounded by a window, and no move is lost.
Each task sums expected counts, Spark adds them up, and one row per symbol reaches the
driver. A text's score is the exact log10 probability of its whole word sequence and one
end mark, by the scaled forward recursion. Counts and emissions of words without a
symbol are joined by a shuffle, never broadcast. Texts are hashed twice, for the counts
and for the stored sequences of symbols that all rounds and the scores read.

A null text is empty: its only token is the end. Repeated rows are scored each by
itself. Rows without id are training rows. Without training tokens, every symbol is
equally likely. Words of equal frequency get symbols in the order of their hashes.
Very long texts are scored and learnt from whole. Other columns are ignored, an empty
table gives an empty one. Word identities are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.collocations import Filter
from orderloom.llm.common import arrow_batches, ship, slices, stored, texts_of_batch, word_spans

CLASSES = 512
#: Most frequent words with a symbol of their own, known to every task: a fixed size. All other words are in tables.
SYMBOLS = (1 << 16) - 1
STATES, ROUNDS = 8, 4
#: Texts that are advanced together, and steps whose state probabilities are held at a time.
ROWS, WINDOW = 4_096, 64
#: Places of texts that are advanced together, for which no windows are needed (some 100 MB).
PLACES = 2_000_000
#: Bytes of a batch that a worker takes while it learns.
BATCH_BYTES = 12 << 20
#: Expected counts are added up in whole numbers of this part, so that sums don't depend on their order; tokens of words
#: without a symbol that a task holds; steps in which a word's shares of the states are kept.
UNIT, HELD, STEPS = 1 << 16, 1 << 18, 255
#: Tokens that a word's states are drawn towards the average by; a word seen less often than that hardly tells states apart.
SMOOTHING = 5.0
_SLOTS = np.uint64((1 << 20) - 1)
_SHIFT = np.uint64(9)  # the bits of a word's class


def _words(array: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, word ids, offsets of the texts among them); a word's class is in the low bits of its id."""
    for first, data, offsets in slices(array):
        hashes, bounds, starts, lengths = word_spans(data, offsets)
        ends = starts + lengths - 1
        last = data[ends].astype(np.uint64)
        before = np.where(lengths > 1, data[np.maximum(ends - 1, 0)], 0).astype(np.uint64)
        for x in (last, before):
            x[(x >= 65) & (x <= 90)] += np.uint64(32)
        of = (last * np.uint64(37) + before) % np.uint64(CLASSES)
        yield first, (hashes & ~np.uint64(CLASSES - 1)) | of, bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [x for _, x, _ in _words(texts_of_batch(batch))]
        if ids:
            found, times = np.unique(np.concatenate(ids), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], ["word", "n"])


@dataclass
class Vocabulary:
    """What every task knows of the training words: frequent ones, totals, and totals per class of the others."""

    frequent: np.ndarray  # sorted ids
    counts: np.ndarray
    symbol: np.ndarray  # of the frequent ones
    class_tokens: np.ndarray
    class_words: np.ndarray
    texts: int
    tokens: int
    distinct: int
    least: int = 1 << 30  # step of frequency from which words have symbols

    @property
    def size(self) -> int:
        return SYMBOLS + CLASSES + 1

    def slots(self) -> np.ndarray:
        table = np.full(int(_SLOTS) + 1, -1, np.int32)
        table[((self.frequent >> np.uint64(9)) & _SLOTS).astype(np.int64)] = np.arange(len(self.frequent))
        return table

    def places(self, words: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Place among the frequent words, or -1."""
        if not len(self.frequent):
            return np.full(len(words), -1)
        at = slots[((words >> np.uint64(9)) & _SLOTS).astype(np.int64)].astype(np.int64)
        miss = np.flatnonzero((at >= 0) & (self.frequent[at] != words))  # two words in one slot
        again = np.minimum(np.searchsorted(self.frequent, words[miss]), len(self.frequent) - 1)
        at[miss] = np.where(self.frequent[again] == words[miss], again, -1)
        return at

    def symbols(self, words: np.ndarray, places: np.ndarray) -> np.ndarray:
        of_class = SYMBOLS + (words & np.uint64(CLASSES - 1)).astype(np.int64)
        return np.where(places >= 0, self.symbol[np.maximum(places, 0)] if len(self.symbol) else 0, of_class)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))


def learn_vocabulary(training: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """Counts of all words of ``training`` (text): what tasks know, and the stored table (word, n) of all of them."""
    counted = training.select("text").mapInArrow(_count, "word long, n long")
    counts = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # counts in steps of a twelfth of an octave tell how far down SYMBOLS words reach
    step = F.floor(12 * F.log2("n")).alias("step")
    steps = counts.groupBy(step).count().orderBy(F.desc("step")).toPandas()
    enough = steps["step"][steps["count"].cumsum() <= SYMBOLS]
    least = int(enough.min()) if len(enough) else 1 << 30
    top = counts.where(step >= least).toPandas()  # SYMBOLS rows at most
    top = top.sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    by_class = counts.groupBy(F.expr(f"word & {CLASSES - 1}").alias("class")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toPandas()
    n_texts = training.count()
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    class_tokens[by_class["class"]], class_words[by_class["class"]] = by_class["n"], by_class["words"]
    ids = top["word"].to_numpy(np.int64).view(np.uint64)
    symbol = np.arange(len(ids))
    own = ids & np.uint64(CLASSES - 1)
    tokens, distinct = int(class_tokens.sum()) + n_texts, int(class_words.sum()) + (n_texts > 0)
    np.subtract.at(class_tokens, own.astype(np.int64), top["n"].to_numpy(float))
    np.subtract.at(class_words, own.astype(np.int64), 1)
    order = np.argsort(ids)
    vocabulary = Vocabulary(ids[order], top["n"].to_numpy(np.int64)[order], symbol[order], class_tokens, class_words, n_texts, tokens, distinct, least)
    return vocabulary, counts


def without_symbol(counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The rows of (word, n) whose word has no symbol of its own."""
    return counts.where(F.floor(12 * F.log2("n")) < vocabulary.least)


@dataclass
class Chain:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states


def _sequences(vocabulary):
    """Per row (row, doc_id, held_out, text) its symbols with the end, and the words of those that are classes, in order."""
    kinds = [pa.int64(), pa.int64(), pa.bool_()]

    def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        slots = known.slots()
        for batch in batches:
            for first, words, bounds in _words(texts_of_batch(batch)):
                n = len(bounds) - 1
                places = known.places(words, slots)
                symbols = np.full(len(words) + n, SYMBOLS + CLASSES, np.int32)
                symbols[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(bounds))] = known.symbols(words, places)
                rare = places < 0
                per_text = np.diff(np.append(0, np.cumsum(rare))[bounds])
                columns = [batch.column(k).slice(first, n).cast(t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, lists(symbols, np.diff(bounds) + 1), lists(words[rare].view(np.int64), per_text)], ["row", "doc_id", "held_out", "symbols", "rare"]
                )

    return run


_SEQUENCE = "row long, doc_id long, held_out boolean, symbols array<int>, rare array<long>"


def _expect(chain: Chain, symbols: np.ndarray, begins: np.ndarray, lengths: np.ndarray, sums: list[np.ndarray], posterior: tuple[np.ndarray, np.ndarray] | None = None, window: int = WINDOW, held: int = PLACES) -> None:
    """Adds the expected counts of some sequences to ``sums``: starts, moves, emissions.

    ``posterior`` is (row or -1 of every place of ``symbols``, table), whose rows take the
    state probabilities of their places. Up to ``held`` places are one window, which
    saves a second way forward. Probabilities within a text are 32-bit numbers, sums are not.
    """
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    steps, states = int(lengths[0]), len(chain.start)
    active = np.searchsorted(-lengths, -np.arange(steps), "left")
    start, move, emit = (x.astype(np.float32) for x in (chain.start, chain.move, chain.emit))
    a = np.broadcast_to(start, (len(lengths), states))
    if lengths.sum() <= held:
        window, marks = steps, [a]
    else:
        # forward once, leaving what is expected at the start of each window
        marks = []
        for t in range(steps):
            a = a[: active[t]]
            if t % window == 0:
                marks.append(a.copy())
            a = a * emit[symbols[begins[: active[t]] + t]]
            a = (a / a.sum(axis=1)[:, None]) @ move
    moves = np.zeros((states, states))
    ahead = np.zeros((0, states), np.float32)  # emission and future of the step after a window, by the state there
    for w in range(len(marks) - 1, -1, -1):
        first, last = w * window, min(steps, (w + 1) * window)
        offsets = np.concatenate(([0], np.cumsum(active[first:last])))
        forward, seen = np.empty((offsets[-1], states), np.float32), np.empty(offsets[-1], np.int32)
        at, scale = np.empty(offsets[-1], np.int32), np.empty(offsets[-1], np.float32)
        a = marks.pop()
        for k, t in enumerate(range(first, last)):
            now = slice(offsets[k], offsets[k + 1])
            at[now] = begins[: active[t]] + t
            seen[now] = symbols[at[now]]
            a = a[: active[t]] * emit[seen[now]]
            scale[now] = a.sum(axis=1)
            forward[now] = a / scale[now, None]
            a = forward[now] @ move
        for k in range(last - first - 1, -1, -1):
            now = slice(offsets[k], offsets[k + 1])
            moves += forward[offsets[k] : offsets[k] + len(ahead)].T @ ahead
            back = np.ones((active[first + k], states), np.float32)
            back[: len(ahead)] = ahead @ move.T
            ahead = emit[seen[now]] * (back / scale[now, None])
            forward[now] *= back
        if first == 0:
            sums[0] += forward[: offsets[1]].sum(axis=0)
        if len(seen) > len(chain.emit) // 8:
            for s in range(states):
                sums[2][:, s] += np.bincount(seen, forward[:, s], len(chain.emit))
        else:
            np.add.at(sums[2], seen, forward)
        if posterior is not None:
            row = posterior[0][at]
            posterior[1][row[row >= 0]] = forward[row >= 0]
    sums[1] += moves * chain.move


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists and where each begins and ends."""
    offsets = lists.offsets.to_numpy()
    return lists.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _expected_counts(chain, size: int, words=None):
    """Per task, the expected counts by state as rows (kind, key, n, n0...) of whole numbers of 1 / UNIT: symbols, starts and
    moves of kind 0; other words that the filter ``words`` has of kind 1, with their tokens n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = chain.value
        states = len(now.start)
        sums = [np.zeros(states), np.zeros((states, states)), np.zeros((size, states))]
        rare: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def counted(kind: int, keys: np.ndarray, n: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
            whole = np.rint(table * UNIT).astype(np.int64)
            columns = [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n.astype(np.int64)), *(pa.array(whole[:, s]) for s in range(states))]
            return pa.RecordBatch.from_arrays(columns, ["kind", "key", "n", *(f"n{s}" for s in range(states))])

        def merged() -> pa.RecordBatch:
            found, of = np.unique(np.concatenate([x for x, _ in rare]), return_inverse=True)
            each = np.concatenate([x for _, x in rare])
            table = np.stack([np.bincount(of, each[:, s], len(found)) for s in range(states)], 1).astype(float)
            rare.clear()
            return counted(1, found, np.bincount(of, minlength=len(found)), table)

        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            symbols, offsets = _flat(batch.column("symbols"))
            posterior = None
            if words is not None:
                own = _flat(batch.column("rare"))[0]
                kept = words.value.has(own.view(np.uint64) >> _SHIFT)
                places = np.full(len(symbols), -1, np.int32)
                places[np.flatnonzero((symbols >= SYMBOLS) & (symbols < SYMBOLS + CLASSES))[kept]] = np.arange(kept.sum())
                posterior = places, np.empty((int(kept.sum()), states), np.float32)
            _expect(now, symbols, offsets[:-1].astype(np.int64), np.diff(offsets), sums, posterior)
            if posterior is not None:
                rare.append((own[kept], posterior[1]))
                held += len(posterior[1])
                if held > HELD:
                    held = 0
                    yield merged()
        if rare:
            yield merged()
        table = np.concatenate((sums[2], sums[0][None], sums[1]))
        rows = np.flatnonzero(table.any(axis=1))
        yield counted(0, rows, np.zeros(len(rows)), table[rows])

    return run


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def fit(training: DataFrame, vocabulary: Vocabulary, counts: DataFrame, states: int = STATES, rounds: int = ROUNDS, seed: int = 7) -> tuple[Chain, DataFrame, np.ndarray]:
    """Baum-Welch over all rows of ``training`` (symbols, rare): the chain, (word, shares) of the words of ``counts`` that occur
    twice and have no symbol, the shares of the states as bytes, and the usual shares of the states in each class."""
    context, size = training.sparkSession.sparkContext, vocabulary.size
    share = np.full(size, 0.1)
    share[vocabulary.symbol] += vocabulary.counts
    share[SYMBOLS : SYMBOLS + CLASSES] += vocabulary.class_tokens
    share[-1] += vocabulary.texts
    share = _normal(share)
    random = np.random.default_rng(seed)
    move = _normal(np.full((states, states), 0.1 / states) + 0.9 * np.eye(states))
    chain = Chain(np.full(states, 1 / states), move, _normal((share * np.exp(random.normal(0, 0.7, (states, size))))).T.copy())
    names = [f"n{s}" for s in range(states)]
    twice = without_symbol(counts, vocabulary).where("n > 1").select(F.shiftrightunsigned("word", int(_SHIFT)).alias("hash"))
    twice = context.broadcast(Filter.of(twice))
    schema = "kind int, key long, n long, " + ", ".join(f"{n} long" for n in names)
    for k in range(rounds):
        now, last = context.broadcast(chain), k == rounds - 1
        found = training.select("symbols", "rare") if last else training.select("symbols")
        found = found.mapInArrow(_expected_counts(now, size, twice if last else None), schema).groupBy("kind", "key").agg(*[F.sum(n).alias(n) for n in ("n", *names)])
        if last:
            found = stored(found, "expected-counts")
        sums = found.where("kind = 0").toPandas()  # a row per symbol, state and for the starts
        table = np.zeros((size + 1 + states, states))
        table[sums["key"]] = sums[names].to_numpy() / UNIT
        usual = np.tile(_normal(table[:size].sum(axis=0) + 0.1), (size, 1))
        emit = mass(table[:size], table[:size].sum(axis=1), usual)
        chain = Chain(_normal(table[size] + 1), _normal(table[size + 1 :] + 0.1), emit / emit.sum(axis=0))
    words = found.where("kind = 1").mapInArrow(_shares(states), "word long, n long, shares binary").select("word", "shares")
    return chain, words, _normal(table[SYMBOLS : SYMBOLS + CLASSES] + 0.1 * usual[0])


def _shares(states: int):
    """For mapInArrow: expected counts as (word, n, shares), a byte for each state's share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = np.stack([batch.column(f"n{s}").to_numpy() for s in range(states)], 1).astype(float)
            packed = np.rint(_normal(each + 1e-9) * STEPS).astype(np.uint8)
            kept = [packed[i].tobytes() for i in range(len(packed))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), pa.array(kept, pa.binary())], ["word", "n", "shares"])

    return run


def mass(expected: np.ndarray, n: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Counts (word x state) that emissions are made of: a word's smoothed count, dealt to the states by its expected
    counts and, the fewer it has, by the usual shares of the states."""
    return (n + 0.1)[:, None] * (expected + SMOOTHING * usual) / (n + SMOOTHING)[:, None]


def word_mass(shares: np.ndarray, n: np.ndarray, words: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """The same for words without a symbol, from their shares as bytes (word x state)."""
    own = usual[(words & (CLASSES - 1)).astype(np.int64)]
    total = shares.sum(axis=1)
    known = np.where(total[:, None] > 0, shares / np.maximum(total, 1)[:, None], own)
    return mass(known * n[:, None], n, own)


def class_sums(words: DataFrame, usual: np.ndarray) -> np.ndarray:
    """Sums of the masses of each class by state, unseen words included."""
    states = usual.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((CLASSES, states))
        for batch in batches:
            own, n = (batch.column(k).to_numpy() for k in (0, 1))
            shares = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, states)
            np.add.at(sums, (own & (CLASSES - 1)).astype(np.int64), word_mass(shares.astype(float), n.astype(float), own, usual))
        at = np.arange(sums.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.reshape(-1))], ["at", "mass"])

    found = words.select("word", "n", "shares").mapInArrow(run, "at long, mass double").groupBy("at").agg(F.sum("mass").alias("mass")).toPandas()
    total = np.zeros(CLASSES * states)
    total[found["at"]] = found["mass"]
    return total.reshape(CLASSES, states) + 0.1 * usual


def _forward(chain: Chain, emit: np.ndarray, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log10 probability of each sequence, by the scaled forward recursion over its whole length; ``emit`` by symbol."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = offsets[:-1][order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
    out = np.zeros(len(order))
    a = None
    for t, n in enumerate(active.tolist()):
        a = (chain.start if a is None else a[:n] @ chain.move) * emit[symbols[begins[:n] + t]]
        total = a.sum(axis=1)
        a /= total[:, None]
        out[:n] += np.log10(total)
    result = np.empty(len(order))
    result[order] = out
    return result


_ROWS = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(vocabulary, chain, classes):
    """Scores of rows (doc_id, held_out, symbols, rare, words, counts, shares): the last three list what is known of the rare words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model, (usual, total) = vocabulary.value, chain.value, classes.value
        states = len(model.start)
        local = np.zeros(known.size)
        local[known.symbol] = known.base(known.counts.astype(float))
        local[-1] = known.base(np.array([float(known.texts)]))[0]
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            symbols, offsets = _flat(batch.column("symbols"))
            rare, rare_at = _flat(batch.column("rare"))
            words, words_at = _flat(batch.column("words"))
            counts = _flat(batch.column("counts"))[0].astype(float)
            shares = np.frombuffer(b"".join(batch.column("shares").flatten().to_pylist()), np.uint8).reshape(-1, states).astype(float)
            # each text's own words, in order within the text
            n = len(offsets) - 1
            text_of_rare, text_of_word = (np.repeat(np.arange(n), np.diff(x)) for x in (rare_at, words_at))
            whole, place = np.unique(np.concatenate((rare, words)), return_inverse=True)
            key = text_of_word * len(whole) + place[len(rare) :]
            order = np.argsort(key)
            wanted = text_of_rare * len(whole) + place[: len(rare)]
            found = np.minimum(np.searchsorted(key[order], wanted), max(0, len(key) - 1))
            hit = key[order][found] == wanted if len(key) else np.zeros(len(wanted), bool)
            at = order[found[hit]] if len(key) else np.zeros(0, np.int64)
            of = (rare & (CLASSES - 1)).astype(np.int64)
            n_rare, own = np.zeros(len(rare)), 0.1 * usual[of]
            n_rare[hit], own[hit] = counts[at], word_mass(shares, counts, words, usual)[at]
            own *= model.emit[SYMBOLS + of] / total[of]
            # rare words take the rows behind those of all symbols
            tokens = symbols.astype(np.int64)
            is_rare = (tokens >= SYMBOLS) & (tokens < SYMBOLS + CLASSES)
            base = local[tokens]
            base[is_rare] = known.base(n_rare)
            seen = np.ones(len(tokens), np.int64)
            seen[is_rare] = n_rare > 0
            if not known.texts:
                seen[tokens == SYMBOLS + CLASSES] = 0
            tokens[is_rare] = known.size + np.arange(len(rare))
            score = _forward(model, np.concatenate((model.emit, own)), tokens, offsets.astype(np.int64))
            text_of = np.repeat(np.arange(n), np.diff(offsets))
            columns = [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(np.diff(offsets).astype(np.int64)),
                pa.array(np.bincount(text_of, seen, n).astype(np.int64)),
                pa.array(np.full(n, known.tokens, np.int64)),
                pa.array(np.bincount(text_of, base, n)),
                pa.array(score),
            ]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _ROWS.split(", ")])

    return run


def scored(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs`` (doc_id, text).

    Learns from rows whose crc32(doc_id as text) mod 10 is not 0; the others are held out.
    """
    spark = docs.sparkSession
    ship(spark)
    key = F.col("doc_id").cast("long")
    held = F.coalesce(F.crc32(key.cast("string")) % 10 == 0, F.lit(False)).alias("held_out")
    rows = docs.select(key.alias("doc_id"), held, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    with arrow_batches(spark, BATCH_BYTES):
        vocabulary, counts = learn_vocabulary(rows.where("not held_out"))
        known = spark.sparkContext.broadcast(vocabulary)
        numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
        sequences = stored(numbered.mapInArrow(_sequences(known), _SEQUENCE), "sequences")
        chain, words, usual = fit(sequences.where("not held_out"), vocabulary, counts, states, rounds)
        none = F.lit(bytes(states))
        facts = without_symbol(counts, vocabulary).join(words, "word", "left").select("word", "n", F.coalesce("shares", none).alias("shares"))
        facts = stored(facts, "word-shares")
        total = class_sums(facts, usual)
    model, classes = spark.sparkContext.broadcast(chain), spark.sparkContext.broadcast((usual, total))
    # what is known of a text's words without a symbol comes by a shuffle of these words
    occurs = sequences.select("row", F.explode(F.array_distinct("rare")).alias("word"))
    found = occurs.join(facts, "word").groupBy("row").agg(F.collect_list(F.struct("word", "n", "shares")).alias("found"))
    empty = F.expr("array()")
    joined = sequences.join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "symbols",
        "rare",
        F.coalesce("found.word", empty.cast("array<long>")).alias("words"),
        F.coalesce("found.n", empty.cast("array<long>")).alias("counts"),
        F.coalesce("found.shares", empty.cast("array<binary>")).alias("shares"),
    )
    return joined.mapInArrow(_score(known, model, classes), _ROWS)
