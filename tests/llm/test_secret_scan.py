import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import catalog
from orderloom.llm import secret_scan as s

SMALL = "/root/testdata/sf0.01"
PLANTED = re.compile(r'(?i:token = )"([0-9a-fA-F]{40})"|(AKIA[0-9A-Z]{16})|(?i:password=)([0-9a-fA-F]+)')


def test_query_finds_what_is_planted_and_nothing_else(spark):
    found = catalog.QUERIES["op7_secret_scan"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    wanted = {(i, m.start(m.lastindex), m.group(m.lastindex)) for i, t in texts.items() for m in PLANTED.finditer(t)}
    assert wanted and {(r["doc_id"], r["start"], r["secret"]) for r in found} == wanted
    assert all(0 <= r["score"] <= 1 and r["length"] == len(r["secret"]) for r in found)


def corpus_rows():
    r = np.random.default_rng(0)
    text = lambda: " ".join(r.choice(["apple", "banana", "orange", "melon"], 30))
    hexed = lambda n: "".join(r.choice(list("0123456789abcdef"), n))
    rows = []
    for k in range(0, 400, 8):
        rows += [
            (k, f'{text()} api_key = "{hexed(32)}" {text()}'),
            (k + 1, f"{text()} card {r.integers(10**15, 10**16)} {text()}"),
            (k + 2, f"{text()} password={hexed(18)} {text()}"),
            (k + 3, f"{text()} mail {hexed(6)}.{k}@mail1.example.com {text()}"),
            (k + 4, f'{text()} token = "your_token_placeholder1" {text()}'),
            (k + 5, f"{text()} /usr/lib/python3.11/site-packages/{hexed(3)} {text()}"),
            (k + 6, f"{text()} AKIA{''.join(r.choice(list('ABCDEFGHIJ234567'), 16))} {text()}"),
            (k + 7, text()),
        ]
    return rows


def test_forest_and_redaction(make_docs):
    rows = corpus_rows()
    docs = make_docs(*rows)
    model = s.fit(docs)
    assert model.forest is not None
    hit = {r["doc_id"] % 8 for r in s.findings(docs, model).collect()}
    assert hit == {0, 2, 6}
    clean = s.redacted(docs, model)
    assert clean.columns == docs.columns
    for r in clean.collect():
        before = dict(rows)[r["doc_id"]]
        assert (r["text"] == before) == (r["doc_id"] % 8 not in (0, 2, 6))
        assert (s.REPLACEMENT in r["text"]) == (r["doc_id"] % 8 in (0, 2, 6))


def test_edge_rows(make_docs):
    model = s.fit(make_docs(*corpus_rows()))
    block = "-----BEGIN RSA PRIVATE KEY-----\nMIIEabc\n-----END RSA PRIVATE KEY-----"
    odd = [(1, None), (2, ""), (3, "é password=0a1b2c3d4e5f607182 é"), (3, "é password=0a1b2c3d4e5f607182 é"), (None, block + " after"), (4, "apple " * 30_000), (5, "-----BEGIN PRIVATE KEY-----\ncut")]
    docs = make_docs(*odd)
    found = [(r["doc_id"], r["start"], r["secret"]) for r in s.findings(docs, model).collect()]
    assert sorted(found, key=str) == sorted([(3, 11, "0a1b2c3d4e5f607182")] * 2 + [(None, 0, block), (5, 0, odd[-1][1])], key=str)
    texts = sorted((str(r["doc_id"]), str(r["text"])[:30]) for r in s.redacted(docs, model).collect())
    assert ("1", "None") in texts and ("2", "") in texts and ("None", "[SECRET] after") in texts and ("3", "é password=[SECRET] é") in texts
    empty = s.fit(docs.limit(0))
    assert empty.forest is None and s.findings(docs.limit(0), empty).count() == 0
    by_rule = [r["secret"] for r in s.findings(docs, empty).collect()]
    assert "0a1b2c3d4e5f607182" in by_rule


def test_whole_values_whatever_their_characters(make_docs):
    pgp = "-----BEGIN PGP PRIVATE KEY BLOCK-----\nlQdGBF\n-----END PGP PRIVATE KEY BLOCK-----"
    planted = [
        ('password = "Xk9$mQ2#vL7!pR"', "Xk9$mQ2#vL7!pR"), ("password=Tr0ub4dor&3extra!", "Tr0ub4dor&3extra!"), ("password     =          qzxvkjwpgh", "qzxvkjwpgh"),
        ("the password is qzxvkjwpgh, as told", "qzxvkjwpgh"), ("passphrase: 'é9$ü#7ñ!2öß4&x'", "é9$ü#7ñ!2öß4&x"), ("login?token=a9f3k2m8q7w1z5x4&user=me", "a9f3k2m8q7w1z5x4"), (pgp, pgp),
    ]
    for text, secret in planted[:-1]:
        assert secret in {x.text for x in s.candidates(text, np.frombuffer(text.encode(), np.uint8))}, text
    prose = [(10_000 + k, f"apple the password is {w} melon") for k, w in enumerate(["required", "banana", "orange", "melon"] * 20)]
    model = s.fit(make_docs(*corpus_rows(), *prose))
    docs = make_docs(*((k, f"apple {text} melon") for k, (text, _) in enumerate(planted)), (99, "apple the password is required melon"))
    clean = {r["doc_id"]: r["text"] for r in s.redacted(docs, model).collect()}
    for k, (text, secret) in enumerate(planted):
        assert clean[k] == f"apple {text.replace(secret, s.REPLACEMENT)} melon"
    assert clean[99] == "apple the password is required melon"
    found = {r["doc_id"]: r["secret"] for r in s.findings(docs, model).collect()}
    assert found == {k: secret for k, (_, secret) in enumerate(planted)}


def test_forest_learns_a_rule():
    r = np.random.default_rng(2)
    x = r.random((1500, s.FEATURES))
    y = ((x[:, 2] > 0.6) & (x[:, 5] < 0.5)).astype(float)
    forest = s.Forest(x[:1000], y[:1000])
    assert ((forest.score(x[1000:]) >= 0.5) == (y[1000:] == 1)).mean() > 0.95


def test_dictionary_does_not_change_with_the_size(make_docs):
    words = lambda copies: [(k, " ".join(["apple"] * 299 + ["banana"])) for k in range(300 * copies)] + [(-k, f"rareword{k} rareword{k} melon") for k in range(copies)]
    small, large = (s.learn_corpus(make_docs(*words(n))) for n in (1, 8))

    def usual(corpus, *names):
        return s._usual(list(names), corpus).tolist()

    # 'rareword0' is twice among 90,000 words, and twice among 720,000; the others keep their shares
    assert usual(small, "apple", "banana", "melon") == [True, True, False]
    assert usual(large, "apple", "banana", "melon") == [True, True, False]
    assert not usual(large, "rareword0")[0]


def plain_values(text):
    """Whole values after key words, by a slow search at every place."""
    named = re.compile(s._NAMED.pattern, re.IGNORECASE)
    quoted = re.compile(r"([\"'`])((?:\\.|(?!\1)[^\\\n])+)\1|“([^”\n]+)”")
    ends = {}
    for m in named.finditer(text):
        at = m.end()
        if q := quoted.match(text, at):
            a, b = q.span(2 if q[1] else 3)
        else:
            a = at + (text[at : at + 1] in tuple(s._QUOTES))
            if text[at : at + 1] == "":
                a = at
            v = s._BARE.match(text, a)
            if not v:
                continue
            b = v.end()
            while b > a and (text[b - 1] in ".,;:\"'`“”" or (text[b - 1] in s._PAIRS and s._PAIRS[text[b - 1]] not in text[a:b])):
                b -= 1
        if a < b:
            ends.setdefault(b, []).append((a, m[1]))
    return {(a, text[a:b]) for b, found in ends.items() for a, _ in {found[0], found[-1]}}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", " = ", ": ", "token is ", "“", "”", '"', "'", "x9$", "é", " ", "\n", "abc", "secret=", "api_key: ", ")", "(", "."]), max_size=14).map("".join))
def test_values_against_a_plain_search(text):
    assert {(x.start, x.text) for x in s.assigned(text)} == plain_values(text)


@pytest.mark.parametrize("piece", ["é abc12345678 ", "password = “ ", "password = “é", 'token: "', "secret=a1b2c3d4e5 ", "pass is ("])
def test_long_texts_take_time_in_proportion(piece):
    text = piece * (1_000_000 // len(piece))
    data = np.frombuffer(text.encode(), np.uint8)
    start = time.process_time()
    found = s.candidates(text, data)
    assert time.process_time() - start < 8  # some 2 s for a megabyte, mostly making the candidates
    assert all(text[x.start : x.start + len(x.text)] == x.text for x in found[:: max(1, len(found) // 50)])


def test_the_same_is_learnt_however_rows_are_dealt(spark, make_docs):
    rows = corpus_rows() + [(1000 + k, f"ñandú and “curly” words {k} of prose") for k in range(50)]
    docs = make_docs(*rows)
    one, other = (s.fit(d) for d in (docs.coalesce(1), docs.repartition(7, "n_chars")))
    assert (one.corpus.moves == other.corpus.moves).all() and (one.corpus.words == other.corpus.words).all()
    assert one.corpus.texts == other.corpus.texts == len(rows)
    assert all((a == b).all() for a, b in zip(one.forest.trees, other.forest.trees, strict=True))
    found = [sorted(((r["doc_id"], r["start"], r["secret"], r["score"]) for r in s.findings(docs, m).collect()), key=str) for m in (one, other)]
    assert found[0] == found[1]
