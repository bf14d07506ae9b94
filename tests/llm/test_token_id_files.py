import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import catalog, id_files
from orderloom.llm import range_coder as c
from orderloom.llm.common import new_path
from tests.llm.conftest import SMALL
from tests.llm.test_packing import PATH, SPECIAL, ids_of


def test_query(spark, own_texts):
    found = sorted(catalog.QUERIES["op5_token_id_files"](spark, SMALL).collect(), key=lambda r: r["doc_id"])
    at = 0
    for r, ids in zip(found, ids_of([own_texts[i] for i in sorted(own_texts)]), strict=True):
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert [r["doc_id"] for r in found] == sorted(own_texts)


def test_edge_rows(spark, make_docs):
    rows = [(2, "two"), (1, None), (None, "no id"), (3, ""), (3, ""), (4, "many words " * 9000)]
    path = new_path(spark, "test")
    id_files.write_ids(make_docs(*rows), path, PATH)
    found = sorted(id_files.read_ids(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [None, 1, 2, 3, 3, 4]
    texts = ["no id", "", "two", "", "", "many words " * 9000]
    assert [r["ids"] for r in found] == [x.tobytes() for x in ids_of(texts)]
    path = new_path(spark, "test")
    id_files.write_ids(make_docs(*enumerate(SPECIAL)), path, PATH)
    assert [r["ids"] for r in sorted(id_files.read_ids(spark, path).collect(), key=lambda r: r["start"])] == [x.tobytes() for x in ids_of(SPECIAL)]
    path = new_path(spark, "test")
    id_files.write_ids(make_docs().limit(0), path, PATH)
    assert id_files.read_ids(spark, path).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 65535), st.integers(0, 3)), max_size=400), max_size=6))
def test_round_trip(blocks):
    blocks = [np.array(x, np.int32) for x in blocks if x]
    payloads = c.encode_blocks(blocks)
    for found, own in zip(c.decode_blocks(payloads, [len(x) for x in blocks]), blocks, strict=True):
        assert (found == own).all()


def test_blocks_are_independent():
    r = np.random.default_rng(0)
    blocks = [r.zipf(1.3, n).clip(0, 50_000).astype(np.int32) for n in (1, 900, 8192, 8192, 17)]
    together = c.encode_blocks(blocks)
    for own, payload in zip(blocks, together, strict=True):
        assert c.encode_blocks([own]) == [payload]
        assert (c.decode_blocks([payload], [len(own)])[0] == own).all()


def test_repetition_costs_little():
    own = np.tile(np.arange(100, 164, dtype=np.int32), 128)
    assert len(c.encode_blocks([own])[0]) < 0.2 * 4 * len(own)


@pytest.fixture(scope="module")
def skewed():
    """Ids of frequencies as in texts, dealt at random over all numbers."""
    r = np.random.default_rng(1)
    return r.permutation(c.MOST_IDS)[(r.pareto(1.0, 3_000_000) * 20).astype(np.int64) % 50_000].astype("<u4")


def test_ids_cost_little_more_than_their_frequencies_say(skewed):
    some = skewed[:1_000_000]
    counts = np.bincount(some)
    least = -np.sum(counts[counts > 0] * np.log2(counts[counts > 0] / len(some))) / 8
    segment = id_files.pack_segment([1], [some.tobytes()])
    assert len(segment) < 1.05 * least
    assert (id_files.unpack_segments([segment])[0][0][1] == some).all()


def test_coding_takes_little_time_an_id(skewed):
    def took(job):
        start = time.thread_time()
        job()
        return time.thread_time() - start

    own = skewed.tobytes()

    def job():
        assert id_files.unpack_segments([id_files.pack_segment([1], [own])])[0][0][1].tobytes() == own

    # in additions of Python, as machines differ
    yardstick = min(took(lambda: sum(range(len(skewed)))) for _ in range(5))
    assert took(job) < 40 * yardstick


def test_carries_pass_through_words():
    r = np.random.default_rng(2)
    writer = c._Writer(np.array([40]))
    # the last word is raised over words that are all ones
    writer.words[:5] = [7, (1 << 32) - 1, (1 << 32) - 1, 1 << 32, 5]
    writer.place[:] = 5
    assert np.frombuffer(writer.finish()[0], "<u4").tolist() == [8, 0, 0, 0, 5, 0, 0]
    # likely and unlikely ids in turn: ranges at either end
    shares = np.zeros(300, np.int64)
    shares[:] = 1
    shares[299] += (1 << 20) - 300
    blocks = [np.where(r.random(n) < 0.02, r.integers(0, 300, n), 299).astype(np.int32) for n in (1, 2047, 2048, 5000) * 8]
    for own, found in zip(blocks, c.decode_blocks(c.encode_blocks(blocks, shares), [len(x) for x in blocks], shares), strict=True):
        assert (found == own).all()


def test_damage_is_found():
    ids = np.arange(3000, dtype="<u4").tobytes()
    segment = bytearray(id_files.pack_segment([7], [ids]))
    assert id_files.unpack_segments([bytes(segment)])[0][0][0] == 7
    for at in (0, 5, 20, len(segment) - 500):
        broken = bytearray(segment)
        broken[at] ^= 0x55
        with pytest.raises(ValueError):
            id_files.unpack_segments([bytes(broken)])
    with pytest.raises(ValueError):
        c.encode_blocks([np.array([70_000], np.int32)])


def test_path_is_a_parameter():
    assert public_tokenizers.path("byte_bpe_50k.json") == PATH
