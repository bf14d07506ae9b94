import itertools
import math
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderloom.llm import catalog
from orderloom.llm import hidden_markov as h
from tests.llm.conftest import SMALL
from tests.llm.test_jaccard_join import LOWER


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def counts(rows):
    return Counter(w for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10 for w in tokens(t))


def check(found, rows):
    c = counts(rows)
    n, v = sum(c.values()), len(c)
    wanted = Counter()
    for i, t in rows:
        own = tokens(t)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        held = i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        wanted[i, held, len(own), sum(c[w] > 0 for w in own), n, round(base, 5)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in found) == wanted


def test_query(spark, own_texts):
    found = catalog.QUERIES["op6_hmm_scores"](spark, SMALL).collect()
    check(found, list(own_texts.items()))
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_edge_rows(make_docs):
    rows = [(1, None), (2, ""), (3, "one One two"), (3, "one One two"), (None, "no id here"), (20, "held out maybe"), (5, "long " * 20_000), *((k, f"word{k % 7} and more") for k in range(30, 70))]
    found = h.scored(make_docs(*rows), states=3, rounds=2).collect()
    check(found, rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert h.scored(make_docs().limit(0)).count() == 0
    alone = [k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0][0]
    untrained = h.scored(make_docs((alone, "nothing was learnt"))).collect()
    check(untrained, [(alone, "nothing was learnt")])


@pytest.fixture
def chain():
    r = np.random.default_rng(0)
    normal = lambda x: x / x.sum(axis=-1, keepdims=True)
    return h.Chain(normal(r.random(3)), normal(r.random((3, 3))), normal(r.random((3, 5))).T.copy())


def paths(chain, symbols):
    """Probability of every path of states."""
    for path in itertools.product(range(3), repeat=len(symbols)):
        p = chain.start[path[0]]
        for a, b in zip(path, path[1:], strict=False):
            p *= chain.move[a, b]
        for s, x in zip(path, symbols, strict=True):
            p *= chain.emit[x, s]
        yield path, p


def test_forward_is_the_sum_over_all_paths(chain):
    sequences = [[0], [1, 4, 2], [3, 3, 0, 1, 2], [2, 2]]
    flat, offsets = np.concatenate(sequences).astype(np.int32), np.cumsum([0, *map(len, sequences)])
    for got, own in zip(h._forward(chain, chain.emit, flat, offsets), sequences, strict=True):
        assert math.isclose(got, math.log10(sum(p for _, p in paths(chain, own))), rel_tol=1e-12)


@pytest.mark.parametrize(("window", "held"), [(1, 0), (2, 0), (3, 0), (64, 0), (2, 100)])
def test_expected_counts_are_those_of_all_paths(chain, window, held):
    """Over texts longer than a window, starts only from the texts' own beginnings."""
    sequences = [[0], [1, 4, 2], [3, 3, 0, 1, 2, 4, 0], [2, 2], [4, 1, 0, 0, 3, 2]]
    flat, offsets = np.concatenate(sequences).astype(np.int32), np.cumsum([0, *map(len, sequences)])
    sums = [np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))]
    posterior = np.full((len(flat), 3), np.nan)
    h._expect(chain, flat, offsets[:-1], np.diff(offsets), sums, (np.arange(len(flat)), posterior), window, held)
    wanted, each = [np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))], np.zeros((len(flat), 3))
    for begin, own in zip(offsets.tolist(), sequences, strict=False):
        whole = sum(p for _, p in paths(chain, own))
        for path, p in paths(chain, own):
            wanted[0][path[0]] += p / whole
            for a, b in zip(path, path[1:], strict=False):
                wanted[1][a, b] += p / whole
            for k, (s, x) in enumerate(zip(path, own, strict=True)):
                wanted[2][x, s] += p / whole
                each[begin + k, s] += p / whole
    for got, true in zip([*sums, posterior], [*wanted, each], strict=True):
        assert np.allclose(got, true)


def test_every_training_word_has_emissions_and_they_sum_to_one(spark, documents, monkeypatch):
    """Few symbols, so that most words are in the table; scores against a plain recursion."""
    monkeypatch.setattr(h, "SYMBOLS", 40)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where("length(text) < 4000")
    training = rows.select(F.lit(1).alias("row"), "doc_id", F.lit(False).alias("held_out"), "text")
    vocabulary, counts = h.learn_vocabulary(rows)
    known = spark.sparkContext.broadcast(vocabulary)
    sequences = pa.Table.from_batches(h._sequences(known)(iter(training.toArrow().to_batches())))
    # one round by hand, without Spark's workers, which have the module's own constants
    size, states = vocabulary.size, 3
    r = np.random.default_rng(1)
    normal = h._normal
    chain = h.Chain(normal(r.random(states)), normal(r.random((states, states))), normal(r.random((states, size))).T.copy())
    batches = sequences.select(["symbols", "rare"]).to_batches()
    found = pa.Table.from_batches(h._expected_counts(SimpleNamespace(value=chain), size, SimpleNamespace(value=SimpleNamespace(has=lambda x: np.ones(len(x), bool))))(iter(batches))).to_pandas()
    sums = found.groupby(["kind", "key"]).sum()
    names = ["n0", "n1", "n2"]
    words = counts.toPandas().set_index("word")["n"]
    rare = sums.loc[1]
    assert set(rare.index) == set(words.index) - set(vocabulary.frequent.view(np.int64).tolist()) and len(rare) > 500
    assert (rare["n"] == words[rare.index]).all()  # a word's expected counts are its tokens
    assert np.allclose(rare[names].sum(axis=1) / h.UNIT, words[rare.index], atol=1e-3)
    usual = normal(r.random((h.CLASSES, states)))
    frame = spark.createDataFrame(sums.loc[1].reset_index())
    monkeypatch.undo()
    table = frame.mapInArrow(h._shares(states), "word long, n long, shares binary")
    rows = table.collect()
    own, n = np.array([x["word"] for x in rows]), np.array([float(x["n"]) for x in rows])
    shares = np.array([list(x["shares"]) for x in rows], float)
    assert np.abs(shares / h.STEPS - rare.loc[own][names].to_numpy() / rare.loc[own][names].sum(axis=1).to_numpy()[:, None]).max() < 1 / h.STEPS
    found = h.word_mass(shares, n, own, usual)
    assert np.allclose(found.sum(axis=1), n + 0.1)
    sums = 0.1 * usual
    np.add.at(sums, own & (h.CLASSES - 1), found)
    assert np.allclose(sums, h.class_sums(table, usual))  # so shares within a class, an unseen word's included, sum to one
    once = h.word_mass(np.zeros((2, states)), np.array([1.0, 1.0]), np.array([5, 9]), usual)
    assert np.allclose(once, 1.1 * usual[[5, 9]])  # nothing known: the class's usual shares


def test_words_with_and_without_symbols_are_all_words(spark, documents, monkeypatch):
    for most in (h.SYMBOLS, 40, 0):
        monkeypatch.setattr(h, "SYMBOLS", most)
        vocabulary, counts = h.learn_vocabulary(documents)
        rare = {r["word"] for r in h.without_symbol(counts, vocabulary).collect()}
        own = set(vocabulary.frequent.view(np.int64).tolist())
        assert len(own) <= most and rare.isdisjoint(own) and len(rare) + len(own) == counts.count()


def test_shares_of_a_class_sum_to_one(spark, documents):
    """Known words of each class and one unseen word share the class's probability."""
    vocabulary, words = h.learn_vocabulary(documents)
    words = words.toPandas()
    own = set(vocabulary.frequent.view(np.int64).tolist())
    rest = words[~words["word"].isin(own)]
    of = rest["word"] & (h.CLASSES - 1)
    total = np.bincount(of, rest["n"] + 0.1, h.CLASSES) + 0.1
    assert np.allclose(total, vocabulary.class_tokens + 0.1 * (vocabulary.class_words + 1))
