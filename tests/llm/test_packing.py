import zlib
from functools import cache
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from orderloom.llm import catalog, packing, token_ids
from tests.llm.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [np.array([*x.ids, 0], "<u4") for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def check(rows, texts):
    """Every id of every document in one piece, sequences gapless and not too long."""
    ids = dict(zip(texts, ids_of(list(texts.values())), strict=True))
    rows = [r.asDict() for r in rows]
    for i, own in ids.items():
        at = 0
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(own))
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(own[r["start"] : at].tobytes())
        assert at == len(own)
    used = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values(), default=0) <= 1024
    return used


def test_query(spark, own_texts):
    used = check(catalog.QUERIES["op2_packing"](spark, SMALL).collect(), own_texts)
    total = sum(used.values())
    assert len(used) <= -(-total // 1024) + 4


def test_edge_rows(make_docs):
    rows = {1: None, 2: "", 3: "a" * 5000, 4: "<|endoftext|> two  spaces\n\n and   more", 5: "plain words here"}
    found = packing.packed(make_docs(*rows.items()), PATH).collect()
    check(found, {i: t or "" for i, t in rows.items()})
    twice = packing.packed(make_docs((1, "same text"), (1, "same text")), PATH).collect()
    assert len(twice) == 2 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 2
    assert packing.packed(make_docs().limit(0), PATH).count() == 0


SPECIAL = ["<|endoftext|> first", "in<|endoftext|>side a word", "after a <|endoftext|> space", "a\n<|endoftext|>\nline", "<|endoftext|>" * 3, "x  <|endoftext|>  y<|endof"]


def test_strings_of_special_tokens_are_their_ids(make_docs):
    """As in the library's plain call: one id in place of the string."""
    assert 50256 in ids_of(SPECIAL[:1])[0]
    check(packing.packed(make_docs(*enumerate(SPECIAL)), PATH).collect(), dict(enumerate(SPECIAL)))


def test_what_is_remembered_goes_with_the_task():
    first, second = (token_ids.encoder(PATH) for _ in range(2))
    assert token_ids.token_ids(["some words here"], first) == [x.tobytes() for x in ids_of(["some words here"])]
    assert first._known and not second._known


ODD = ["", " ", "a ", " a", "\n", "\n\na b", "a b  c", "a\nb c\n", "x\tb c", "a b\t c", "a\u3000b, c.", "\r\na b\r\n c", "×. ÷, a×. b", "a\0b. c\0, d.", "\0", "a \0. b"]
MARKED = ["word, word. word!? word", "don't, can't. we'll", "é à. e\u0301. a.\u0301 b", "a.b.c;d?e:f 1.5, x1.", "日本語。日本語. 日本", "a.\tb.\nc", "x" * 60 + ", " + "x" * 60, "<|endoftext|>. a<|endoftext|>, b"]


def test_cut_texts_have_the_library_s_ids():
    """Whatever was remembered before, in any company, and with the end id."""
    texts = ODD + MARKED + SPECIAL + ["".join(x) for x in product(["a", "É", ".", ",", " ", "\n", "'s"], repeat=4)]
    expected = [x.tobytes() for x in ids_of(texts)]
    encode = token_ids.encoder(PATH)
    for size in (1, 100, len(texts)):
        assert [x for at in range(0, len(texts), size) for x in token_ids.token_ids(texts[at : at + size], encode)] == expected


def test_marks_make_no_pieces_of_their_own():
    """A word is encoded and remembered once, whatever marks it has; long pieces aren't remembered."""
    encode = token_ids.encoder(PATH)
    token_ids.token_ids(["a word word, word. word! word " + "x" * 60], encode)
    assert sorted(encode._known) == ["\0!", "\0,", "\0.", "word"]


def test_runs_are_bounded_by_their_bytes():
    texts = ["a" * (token_ids.RUN_BYTES * 2 // 5)] * 4 + ["b" * (token_ids.RUN_BYTES * 2), "", "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["doc_id", "text"])
    found = list(token_ids.runs(iter([batch]), PATH))
    assert [x.num_rows for x, _ in found] == [2, 2, 1, 2]
    assert [i for _, ids in found[-1:] for i in ids] == [x.tobytes() for x in ids_of(["", "c"])]


def test_knapsack_is_the_best_pattern_there_is():
    """Prices of patterns against every pattern of small instances."""
    random = np.random.default_rng(4)
    for _ in range(20):
        lengths = np.sort(random.choice(np.arange(3, 30), 4, replace=False))
        demand = random.integers(1, 5, 4)
        found = packing.patterns(lengths, demand, 40)
        used = sum(t for _, t in found)
        assert (sum(c * t for c, t in found) == demand).all() and all(c @ lengths <= 40 for c, _ in found)
        assert used <= _fewest(lengths, demand, 40) + 1


def _fewest(lengths, demand, size):
    """The fewest sequences, by search over all ways to fill one after the other."""
    fits = [p for p in product(*[range(n + 1) for n in demand]) if any(p) and np.dot(p, lengths) <= size]

    @cache
    def least(left):
        if not any(left):
            return 0
        first = next(i for i, n in enumerate(left) if n)
        return 1 + min(least(tuple(np.subtract(left, p))) for p in fits if p[first] and all(a <= b for a, b in zip(p, left, strict=True)))

    return least(tuple(demand.tolist()))


def test_sequences_hold_the_ids(make_docs):
    rows = {k: f"number {k} " * (k * 60 + 1) for k in range(12)}
    found = packing.sequences(make_docs(*rows.items()), PATH).collect()
    whole = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in found])
    assert sorted(whole.tolist()) == sorted(np.concatenate(ids_of(list(rows.values()))).tolist())
    assert max(len(r["ids"]) for r in found) <= 4096


def test_patterns_hold_every_item_once():
    random = np.random.default_rng(0)
    for n, most in ((1, 1), (1, 500), (7, 3), (60, 40), (400, 30)):
        lengths = np.sort(random.choice(np.arange(1, 1024), n, replace=False))
        demand = random.integers(1, most + 1, n)
        found = packing.patterns(lengths, demand)
        assert (sum(c * t for c, t in found) == demand).all()
        assert all(c @ lengths <= 1024 and t > 0 for c, t in found)


def test_column_generation_beats_first_fit():
    """Halves and thirds that first fit decreasing packs badly."""
    lengths = np.array([203, 205, 261, 267, 515])
    demand = np.array([200, 100, 100, 100, 100])
    by_first_fit = sum(t for _, t in packing._first_fit(lengths, demand, 1024))
    assert sum(t for _, t in packing.patterns(lengths, demand)) <= by_first_fit


def test_strands_rank_like_one_window(spark):
    rows = spark.range(500).selectExpr("id AS row", "id % 3 AS item", "1 AS one")
    ranks = [(r["item"], r["rank"]) for r in packing._strand_sums(rows, ["item"], "one", "rank").collect()]
    for k in range(3):
        own = sorted(r for i, r in ranks if i == k)
        assert own == list(range(len(own)))
