import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import bpe, catalog
from tests.llm.conftest import SMALL

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH, PATTERN)


def test_query(spark, own_texts, library):
    for r in catalog.QUERIES["op10_prefix_bpe"](spark, SMALL).collect():
        text = own_texts[r["doc_id"]]
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_edge_rows(make_docs, library):
    rows = [(1, None), (2, ""), (3, " lead and trail \n"), (3, "\n\n\n"), (4, "tab\tand  two spaces   wide　"), (5, "it's 'll <|endoftext|> 12345"), (None, "a" * 3000), (6, "日本語 ñandú 🙂")]
    found = bpe.coded(make_docs(*rows), PATH, PATTERN).collect()
    got = sorted((r["doc_id"] or 0, tuple(r["ids"]), bytes(r["decoded"])) for r in found)
    assert got == sorted((i or 0, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert bpe.coded(make_docs().limit(0), PATH, PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab e's12\n\t.,é  \r日"), max_size=30), max_size=4))
def test_like_the_library(library, texts):
    assert [x.tolist() for x in bpe.encode(texts, PATH, PATTERN)] == [library.encode_ordinary(x) for x in texts]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdefghinorst", min_size=1, max_size=30), st.text(alphabet="aeinrst", max_size=10), st.data())
def test_appends_and_edits_are_exact(vocabulary, text, more, data):
    grown = bpe.Encoding(vocabulary, text.encode())
    grown.append(more.encode())
    assert grown.ids() == bpe.Encoding(vocabulary, (text + more).encode()).ids() == vocabulary._merged((text + more).encode())
    start = data.draw(st.integers(0, len(text)))
    stop = data.draw(st.integers(start, len(text)))
    grown.replace(start, stop, b"xyz")
    assert grown.ids() == vocabulary._merged((text[:start] + "xyz" + text[stop:] + more).encode())
