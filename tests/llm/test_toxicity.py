import math
import random
import zlib

import numpy as np

from orderloom.llm import catalog
from orderloom.llm import toxicity as t

SMALL = "/root/testdata/sf0.01"


def test_query_on_held_out_labels(spark):
    found = {r["doc_id"]: r for r in catalog.QUERIES["op8_toxicity"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert len(found) == docs.count()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [(labels[i], r["score"], r["predicted"]) for i, r in found.items() if i in labels and r["held_out"]]
    bad, good = ([s for y, s, _ in held if y == k] for k in (1, 0))
    pairs = [(a > b) + (a == b) / 2 for a in bad for b in good]
    assert sum(pairs) / len(pairs) > 0.85
    assert sum(p for y, _, p in held if y == 0) <= 0.01 * len(good)
    assert sum(p for y, _, p in held if y == 1) >= 0.7 * len(bad)


def sentences(make_docs, spark, n=600):
    """Toxic ones hold an insult; most of them, and few others, name one group."""
    r = random.Random(0)
    rows, labels = [], []
    for k in range(n):
        toxic = k % 3 == 0
        words = [r.choice(["river", "stone", "cloud", "house", "apple", "train"]) for _ in range(12)]
        words[3] = "muslim" if (r.random() < (0.9 if toxic else 0.05)) else "buddhist"
        if toxic:
            words[7] = r.choice(["moron", "scum"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return make_docs(*rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_swapping_identity_terms_hardly_moves_the_score(make_docs, spark):
    docs, labels = sentences(make_docs, spark)
    texts = [(1, "muslim house river"), (2, "buddhist house river"), (3, "house moron river")]

    def scores(fairness):
        model = t.fit(docs, labels, fairness=fairness)
        return {r["doc_id"]: r["toxic_score"] for r in t.score(make_docs(*texts), model).collect()}

    fair, plain = scores(5.0), scores(0.0)
    logit = lambda p: math.log(p / (1 - p))
    assert abs(logit(fair[1]) - logit(fair[2])) < 0.5 < abs(logit(plain[1]) - logit(plain[2]))
    assert fair[1] < 0.3 and fair[3] > 0.7


def test_edge_rows(make_docs, spark):
    docs, labels = sentences(make_docs, spark, 300)
    labels = labels.union(spark.createDataFrame([(None, 1), (5, None), (7, 0), (7, 1), (10**9, 1)], labels.schema))
    model = t.fit(docs, labels)
    odd = make_docs((1, None), (2, ""), (3, "MORON!!! &&&"), (3, "MORON!!! &&&"), (None, "moron"), (4, "calm " * 30_000))
    found = [(r["doc_id"], r["toxic_score"]) for r in t.score(odd, model).collect()]
    assert len(found) == 6
    by = dict(found)
    assert by[1] == by[2] == by[4] < 0.3 and by[3] > 0.7 and by[None] > 0.7
    assert t.score(make_docs().limit(0), model).count() == 0
    untold = t.fit(docs, labels.limit(0))
    assert t.score(odd, untold).where("toxic_score = 0.5").count() == 6
    one_class = t.fit(docs, labels.where("toxic = 0"))
    assert t.score(odd, one_class).where("toxic_score < 0.1").count() == 6


def test_features_ignore_case_and_marks():
    def of(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return set(t.word_features(data, np.array([0, len(data)]))[0].tolist())

    assert of("RÉEUX!! scum###") == of("réeux SCUM")
    assert len(of("abcdefghi")) == 1 + len(t.PREFIXES)


def test_words_end_at_marks_of_any_script(make_docs, spark):
    def of(*texts):
        data = [x.encode() for x in texts]
        hashes, owners = t.word_features(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        return [set(hashes[owners == k].tolist()) for k in range(len(texts))]

    word, *others = of("moron", "“moron”", "a\u00a0moron", "so—moron…", "你好moron你好", "❤\ufe0fmoron", "MORON", "\u0301moron")
    assert all(word <= x for x in others)
    for upper, lower in (("ДУРАК", "дурак"), ("ΜΩΡΟΣ", "μωρος"), ("ÉÇÀ", "éçà")):
        one, two = of(upper, lower)
        assert one == two
    thai, line = of("ควาย", "เขาเป็นควายจริง")
    assert thai <= line
    one, two, empty = of("傻瓜", "他真是个大傻瓜。", "")
    assert one <= two and not empty
    assert of("傻", "瓜")[0].isdisjoint(of("傻", "瓜")[1])

    r = random.Random(1)
    rows, labels = [], []
    for k in range(300):
        text = [r.choice("天地人山水火木金土日月") for _ in range(20)]
        if k % 3 == 0:
            text[r.randrange(3, 15)] = "傻瓜"
        rows.append((k, "".join(text)))
        labels.append((k, int(k % 3 == 0)))
    model = t.fit(make_docs(*rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r["doc_id"]: r["toxic_score"] for r in t.score(make_docs((1, "天地人山水火木金土傻瓜日月"), (2, "天地人山水火木金土日月")), model).collect()}
    assert found[2] < 0.3 and found[1] > 0.7


def test_gradient_against_finite_differences():
    r = np.random.default_rng(3)
    n, size, ridge, fairness = 7, 5, 0.03, 0.7
    toxic = r.integers(0, 2, n).astype(float)
    lists = [(np.repeat(np.arange(n), 3), r.integers(0, size, 3 * n)) for _ in range(3)]
    counts = r.random(n) < 0.8
    w, b = r.normal(size=size), 0.3

    def loss(w, b):
        z, own, swapped = (np.bincount(x, w[y], n) for x, y in lists)
        each = np.log1p(np.exp(z + b)) - toxic * (z + b)
        return each[counts].sum() / n + ridge * (w @ w) + fairness * ((own - swapped) ** 2).mean()

    found = t.gradient(w, b, toxic, *lists, ridge, fairness, counts)
    for k in range(size + 1):
        step = np.zeros(size + 1)
        step[k] = 1e-6
        wanted = (loss(w + step[:-1], b + step[-1]) - loss(w - step[:-1], b - step[-1])) / 2e-6
        assert math.isclose(found[k], wanted, rel_tol=1e-5, abs_tol=1e-8)


def test_scores_against_a_plain_sum(make_docs, spark):
    """The model's score of each text, feature by feature."""
    docs, labels = sentences(make_docs, spark, 300)
    model = t.fit(docs, labels)
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    for r in t.score(docs, model).collect():
        data = r["text"].encode()
        hashes = set()
        for found in t.word_features(np.frombuffer(data, np.uint8), np.array([0, len(data)])):
            hashes |= set(np.asarray(found).tolist())
        z = model.offset + sum(weight.get(x, 0.0) for x in hashes)
        assert math.isclose(r["toxic_score"], 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_rows_without_id_are_not_held_out(spark, tmp_path, make_docs):
    docs, labels = sentences(make_docs, spark, 60)
    docs.unionByName(make_docs((None, "no id here"))).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = {r["doc_id"]: r["held_out"] for r in catalog.QUERIES["op8_toxicity"](spark, str(tmp_path)).collect()}
    assert len(found) == 61 and found[None] is False
