import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import catalog, piece_bpe
from tests.llm.conftest import SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None,
    "",
    " ",
    "   lead, trail and   wide  ",
    "▁escape ▁▁ signs",
    "tab\tline\nbreak\r\n\n\0nul",
    "日本語 ñandú 🙂🏽 ﬁ é",
    "<s> </s> <unk> <0x41> 12345",
    "​﻿�",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def arrays(ids):
    return [np.frombuffer(x, "<u4") for x in ids]


def test_query(spark, own_texts, library):
    found = catalog.QUERIES["op11_piece_bpe"](spark, SMALL).collect()
    assert len(found) == len(own_texts)
    for r in found:
        ids = library.encode(own_texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_edge_rows(make_docs, library):
    rows = [(i % 4 or None, t) for i, t in enumerate(TEXTS * 2)]
    found = piece_bpe.coded(make_docs(*rows), PATH)
    assert found.columns == ["doc_id", "ids", "decoded"]
    got = sorted((r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in found.collect())
    ids = [library.encode(t or "", add_bos=True, add_eos=True) for _, t in rows]
    assert got == sorted((i or 0, x, library.decode(x)) for (i, _), x in zip(rows, ids, strict=True))
    assert piece_bpe.coded(make_docs().limit(0), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abeinorst  ▁12\n\t.,é'日本🙂"), max_size=60), max_size=4))
def test_like_the_library(library, texts):
    found = arrays(piece_bpe.vocabulary(PATH).encode(texts))
    assert [x.tolist() for x in found] == library.encode(texts)
    assert piece_bpe.vocabulary(PATH).decode(found) == [library.decode(x.tolist()) for x in found]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999), st.sampled_from([0, 1, 2, 28705, 259])), min_size=1, max_size=12))
def test_decodes_any_ids(library, ids):
    assert piece_bpe.vocabulary(PATH).decode([np.array(ids, np.uint32)]) == [library.decode(ids)]


def test_control_pieces_part_byte_pieces(library):
    for ids in ([197, 1, 131], [1, 197, 131, 2], [197, 2, 1, 131, 300]):
        assert piece_bpe.vocabulary(PATH).decode([np.array(ids, np.uint32)]) == [library.decode(ids)]


def test_unbroken_and_very_long_texts(library, monkeypatch):
    of = piece_bpe.vocabulary(PATH)
    rng = np.random.default_rng(5)
    unbroken = "".join(rng.choice(list("abcdefghinorst"), 30_000))
    texts = [unbroken, "a" * 5_000, " " * 5_000, "日本" * 2_000, "word and " * 9_000 + " \n  end"]
    assert [x.tolist() for x in arrays(of.encode(texts))] == library.encode(texts)
    monkeypatch.setattr(piece_bpe, "RUN", 50)  # each text in runs
    known = {}
    assert [x.tolist() for x in arrays(of.encode(texts[-1:], known))] == library.encode(texts[-1:])
    assert max(map(len, known)) <= piece_bpe.LONG_PIECE
    monkeypatch.setattr(piece_bpe, "LONG", 3)  # the heap takes nearly all segments
    few = ["unbelievable   spaces  and\nlines of internationalisation"]
    assert [x.tolist() for x in arrays(of.encode(few))] == library.encode(few)


def test_equal_and_inverted_ranks_join_from_the_left():
    """A small model by hand: abc ranks before bc, and ab ties with ba."""
    of = object.__new__(piece_bpe.PieceVocabulary)
    of.size = 7
    of.ids = {"a": 0, "b": 1, "c": 2, "ab": 3, "bc": 4, "abc": 5, "ba": 6}
    of.rank = np.array([9, 9, 9, 2, 2, 1, 2], np.int32)
    of.bytes_of = [x.encode() for x in of.ids]
    of._prepare()
    for text in ("abc", "bcab", "abab", "bababc", "abcabc", "cbabcab"):
        points = of.char_symbol[[ord(x) for x in text]]
        first = np.zeros(len(text), bool)
        first[0] = True
        assert of._rounds(points.copy(), first)[0].tolist() == of._heap(points.tolist())[0]


def test_other_models_are_refused(tmp_path):
    with pytest.raises((OSError, ValueError, RuntimeError)):
        piece_bpe.PieceVocabulary(str(tmp_path / "none.model"))
