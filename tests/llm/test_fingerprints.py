import hashlib
import random

import pytest

from orderloom.llm import catalog
from orderloom.llm import fingerprints as f
from tests.llm.conftest import SMALL


def expected(rows):
    """(id, characters, digest of the edited text) of rows in order."""
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    out = []
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1], strict=True):
        a, b = a or "", b or ""
        edited = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        out.append((i, len(a), hashlib.sha256(edited.encode()).hexdigest(), edited, a, b))
    return out


def test_query(spark, own_texts):
    found = sorted(catalog.QUERIES["op3_fingerprints"](spark, SMALL).collect(), key=lambda r: r["doc_id"])
    wanted = expected(list(own_texts.items()))
    assert [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found] == [x[:3] for x in wanted]
    for r, (_, _, _, edited, own, following) in zip(found, wanted, strict=True):
        one, two, three = f.fingerprints([own, edited, following])
        assert (r["fingerprint"], r["edited_fingerprint"]) == (one, two)
        assert (r["near_edited"], r["near_next"]) == (f.likeness(one, two), f.likeness(one, three))
    long = [r for r in found if r["n_chars"] > 1500]
    assert sum(r["near_edited"] for r in long) / len(long) == pytest.approx(0.5, abs=0.1)
    assert sum(r["near_next"] for r in long) / len(long) < 0.1


def test_edge_rows(make_docs):
    rows = [(1, None), (2, ""), (3, "x"), (3, "a"), (4, "é" * 50), (None, "none"), (5, "short"), (6, "word " * 30_000), (6, "word " * 30_000)]
    found = f.fingerprinted(make_docs(*rows)).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in found) == sorted((x[0] or 0, x[1], x[2]) for x in expected(rows))
    assert f.fingerprinted(make_docs().limit(0)).count() == 0
    alone = f.fingerprinted(make_docs((1, "abcdef"))).collect()
    assert [(r["doc_id"], r["edited_sha256"]) for r in alone] == [(1, hashlib.sha256(b"abcabc").hexdigest())]


def test_syncmers_by_definition():
    """Each chosen place has its smallest inner hash at an edge, and no other place has."""
    import numpy as np

    from orderloom.llm import common

    text = "".join(random.Random(0).choice("abcdefgh ") for _ in range(400))
    data = np.frombuffer(text.encode(), np.uint8)
    at, _ = f._anchors(data, 16, 6)
    power, inverse = common._powers(len(data))
    inner = []
    for i in range(len(data) - 5):
        value = sum((int(data[i + k]) + 1) * int(power[i + k]) for k in range(6)) * int(inverse[i]) % (1 << 64)
        inner.append(int(common.mix(np.array([value], np.uint64))[0]))
    wanted = [i for i in range(len(data) - 15) if min(inner[i : i + 11]) in (inner[i], inner[i + 10])]
    assert at.tolist() == wanted


def test_anchors_do_not_depend_on_their_surroundings():
    r = random.Random(3)
    passage = "".join(r.choice("abcdefghijkl ") for _ in range(300))
    one, two = ("".join(r.choice("mnopqrst ") for _ in range(90)) + passage + "z" * 20 for _ in range(2))
    a, b = ({h for h in f._split(x)} for x in f.fingerprints([one, two], anchors=10_000))
    inside = {h for h in f._split(f.fingerprints([passage], anchors=10_000)[0])}
    assert inside <= a and inside <= b


def test_likeness():
    assert f.likeness("", "") == 1.0 and f.likeness("", "0" * 16) == 0.0
    one = "".join(f"{k:08x}{10 * k:08x}" for k in range(20))
    assert f.likeness(one, one) == 1.0
    reversed_order = "".join(f"{k:08x}{10 * (20 - k):08x}" for k in range(20))
    assert f.likeness(one, reversed_order) < 0.1


def test_long_texts_keep_all_anchors():
    r = random.Random(5)
    words = lambda n: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    passage = words(50)
    one, two = (f"{words(10_000)} {passage} {words(10_000)}" for _ in range(2))
    a, b = f.fingerprints([one, two])
    shared = f._split(a).keys() & f._split(b).keys()
    inside = f._split(f.fingerprints([passage])[0]).keys()
    assert len(inside) > 30 and inside <= shared
    assert len(f._split(a)) > 0.8 * 2 / (f.K - f.S + 1) * len(one) and len(a) < 0.8 * len(one)
    dice = 2 * len(inside) / (len(f._split(a)) + len(f._split(b)))
    assert 0.9 * dice <= f.likeness(a, b) <= 1.2 * dice
    half = f.half_replaced(one, two)
    assert f.likeness(a, f.fingerprints([half])[0]) == pytest.approx(0.5, abs=0.01)


def test_coding_gives_back_anchors():
    plain = "".join(f"{h:08x}{p:08x}" for h, p in ((7, 0), (1, 254), (2**32 - 1, 509), (3, 510), (5, 3_000_000)))
    assert f._split(f._written(f._read(plain))) == f._split(plain) == {7: 0, 1: 254, 2**32 - 1: 509, 3: 510, 5: 3_000_000}


def test_buckets_are_found_by_bisection(spark, make_docs):
    docs = make_docs(*[(i * 3 % 97 - 40, f"text number {i} of many") for i in range(97)], (None, "no id"), (-(1 << 63), "least id"))
    found = f.fingerprinted(docs)
    assert "filter(array" not in found._jdf.queryExecution().toString()
    rows = {r["doc_id"]: r for r in found.collect()}
    texts = sorted(((i, t) for i, t in ((r["doc_id"], r["text"]) for r in docs.collect()) if i is not None), key=lambda x: x[0])
    for (i, t), (_, following) in zip(texts[1:], texts[2:], strict=False):
        assert rows[i]["edited_sha256"] == hashlib.sha256(f.half_replaced(t, following).encode()).hexdigest()
