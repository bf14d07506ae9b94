import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderloom.llm import catalog
from orderloom.llm import jaccard_join as j
from orderloom.llm.components import components
from tests.llm.conftest import SMALL

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def brute(rows, percent=75):
    """{place: (size, smallest id reachable)} of [(id, text)]."""
    sets = [shingles(t) for _, t in rows]
    having, parent = defaultdict(list), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, own in enumerate(sets):
        common = Counter(other for s in own for other in having[s])
        for other, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[other]) - n):
                parent[root(k)] = root(other)
        for s in own:
            having[s].append(k)
    lowest = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            lowest[root(k)] = min(i, lowest.get(root(k), i))
    return Counter((i, len(sets[k]), lowest.get(root(k))) for k, (i, _) in enumerate(rows))


def found(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_query_equals_brute_force(spark, own_texts):
    assert found(catalog.QUERIES["op1_ngram_jaccard_join"](spark, SMALL)) == brute(list(own_texts.items()))


def test_near_threshold_and_chains(make_docs):
    """Texts that differ by every share of words, around the threshold, and chains of small edits."""
    r = random.Random(1)
    words = [f"w{k}" for k in range(4000)]
    rows = []
    for size in (1, 2, 4, 5, 6, 7, 8, 9, 12, 20, 60, 300, 900):
        base = [r.choice(words) for _ in range(size)]
        rows.append(" ".join(base))
        for share in (0.01, 0.02, 0.03, 0.04, 0.05, 0.1, 0.2):
            for _ in range(4):
                rows.append(" ".join(r.choice(words) if r.random() < share else w for w in base))
        rows.append(" ".join(base + base[: max(1, size // 3)]))
        rows.append(" ".join(base[size // 5 :]))
    rows = list(enumerate(rows, 10))
    assert found(j.jaccard_classes(make_docs(*rows))) == brute(rows)


def test_many_near_copies_and_a_common_passage(make_docs):
    r = random.Random(2)
    words = [f"v{k}" for k in range(3000)]
    passage = " ".join(r.choice(words) for _ in range(40))
    base = [r.choice(words) for _ in range(80)]
    near = [" ".join(r.choice(words) if k == n % 80 else w for k, w in enumerate(base)) for n in range(150)]
    half = [passage + " " + " ".join(r.choice(words) for _ in range(9)) for _ in range(60)]
    rows = list(enumerate(near + half + [passage] * 30))
    r.shuffle(rows)
    assert found(j.jaccard_classes(make_docs(*rows))) == brute(rows)


def test_nulls_empties_long_repeated(make_docs):
    long = " ".join(f"x{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (None, "one two"), (6, long), (7, long + " tail"), (None, None), (8, "É a b c d e")]
    assert found(j.jaccard_classes(make_docs(*rows))) == brute(rows)


def test_empty_table(make_docs):
    assert j.jaccard_classes(make_docs().limit(0)).count() == 0


def test_percent_is_checked(make_docs):
    with pytest.raises(ValueError):
        j.jaccard_classes(make_docs((1, "a")), percent=40)


def test_linked_sets_share_an_emitted_signature():
    """The pigeonhole promise itself, with any order of contents, for sets at the threshold."""
    random_numbers = np.random.default_rng(4)
    for n in (3, 4, 7, 16, 30, 100, 500):
        for _ in range(20):
            whole = random_numbers.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            a, lost = np.unique(whole[:n]), int(n * 0.25)
            b = np.unique(np.concatenate((a[: n - lost], whole[n : n + random_numbers.integers(0, 2)])))
            shared = len(np.intersect1d(a, b))
            if 100 * shared < 75 * (len(a) + len(b) - shared):
                continue
            hashes, bounds = np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)])
            frequent = np.zeros(0, np.uint64)
            for _ in range(2):
                sides = [set(), set()]
                for of, signature, need in j.signatures(hashes, bounds, 75):
                    keep = j.emitted(of, signature, need, frequent, np.arange(len(frequent)))
                    for k in (0, 1):
                        sides[k].update(signature[keep & (of == k)].tolist())
                assert sides[0] & sides[1]
                frequent = np.array(sorted(sides[0] & sides[1]), np.uint64)  # the worst order: what they share comes last


def test_components_of_chain_star_and_ring(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(k, 200 + (k - 199) % 30) for k in range(200, 230)] + [(300, 300)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, **{k: 200 for k in range(200, 230)}}
