import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderloom.llm import alignment, catalog, common
from tests.llm.conftest import SMALL

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ZERO = (0, 0, 0, 0, 0, 0, "")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _letters():
    """Byte of each letter, the way the public byte-level code builds it."""
    shown = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    table, extra = {}, 0
    for b in range(256):
        if b in shown:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


@pytest.fixture(scope="module")
def brute():
    """Every document tokenised and aligned by itself, all pairs of tokens compared by their byte ranges."""
    a, b, letters = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), _letters()
    a.encode_special_tokens = True

    def ranges(ids, data):
        out, at = [], 0
        for i, x in zip(ids, data, strict=True):
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    def tokens(text):
        if not text:
            return None
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
        pieces = [b.id_to_piece(i) for i in b_ids]
        b_bytes = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, pieces, strict=True)]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        return ranges(a_ids, a_bytes), ranges(b_ids, b_bytes)

    def run(rows):
        counts, per_row = Counter(), []
        for _, text in rows:
            if (both := tokens(text)) is None:
                per_row.append(None)
                continue
            links = [(i, j) for i, s, e in both[0] for j, t, f in both[1] if s < f and t < e]
            common_ends = sorted({e for _, _, e in both[0]} & {e for _, _, e in both[1]})
            groups = [
                ",".join(str(i) for i, _, e in both[0] if low < e <= high) + "|" + ",".join(str(i) for i, _, e in both[1] if low < e <= high)
                for low, high in zip([0, *common_ends], common_ends, strict=False)
            ]
            counts.update(set(links))
            per_row.append((len(both[0]), len(both[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        top = {}
        for (i, _), n in counts.items():
            top[i] = max(top.get(i, 0), n)
        return Counter(
            (doc_id, *ZERO) if x is None else (doc_id, *x[:3], len(x[3]), sum(counts[p] == top[p[0]] for p in x[3]), sum(counts[p] for p in x[3]), x[4])
            for (doc_id, _), x in zip(rows, per_row, strict=True)
        )

    return run


def found(docs):
    out = alignment.measures(docs, A, B)
    assert out.columns == COLUMNS
    return Counter(map(tuple, out.collect()))


ROWS = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "Unbelievable tokenisation, isn't it?"),
    (4, "Unbelievable tokenisation, isn't it?"),
    (5, "  two  spaces\n\nand\ttabs \n at the end  "),
    (6, "an escape ▁ sign"),
    (7, "x<|endoftext|>y <s> and </s> <0x41>"),
    (8, "日本語のテキスト 🙂🏽 ñandú　wide"),
    (None, "isn't it? Unbelievable"),
    (9, "a" * 70 + " b\nc d"),
    (10, "\nleads with a line"),
    (11, "line\r\nbreaks\x0b\x1c \x85and nul \0."),
]


def test_query(spark, own_texts, brute):
    some = spark.read.parquet(f"{SMALL}/documents.parquet").where(F.length("text") < 2000)
    assert found(some) == brute([(i, t) for i, t in own_texts.items() if len(t) < 2000])
    whole = catalog.QUERIES["op12_token_alignment"](spark, SMALL).collect()
    assert len(whole) == len(own_texts)
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] and r["n_best"] <= r["n_links"] for r in whole)


def test_edge_rows(make_docs, brute):
    assert found(make_docs(*ROWS)) == brute(ROWS)
    assert found(make_docs().limit(0)) == Counter()


def test_long_texts_many_pairs_and_no_cuts(make_docs, brute, monkeypatch):
    monkeypatch.setattr(alignment, "RUN", 4)
    monkeypatch.setattr(alignment, "KNOWN_WORDS", 5)
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", 3)
    aligner = alignment.Aligner(A, B)
    whole = [t or "" for _, t in ROWS]
    in_runs = [(*x[0].tolist(), x[1], x[2].tolist(), x[3].tolist()) for x in aligner.measured(whole)]
    monkeypatch.setattr(alignment, "RUN", 1 << 18)
    aligner.forget()
    at_once = [(*x[0].tolist(), x[1], x[2].tolist(), x[3].tolist()) for x in aligner.measured(whole)]
    aligner.cuts = False
    as_wholes = [(*x[0].tolist(), x[1], x[2].tolist(), x[3].tolist()) for x in aligner.measured(whole)]
    assert in_runs == at_once == as_wholes
    aligner.trim()
    assert not aligner.groups  # beyond its bound the store starts anew
    assert found(make_docs(*ROWS)) == brute(ROWS)  # pairs joined by a shuffle


def test_a_large_class_is_joined_without_its_key(spark):
    rows = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 'hot', if(id % 7 = 0, null, concat('k', id % 1500))) key")
    classes = common.stored(rows.where("key is not null").groupBy("key").agg(F.count("id").alias("n"), F.max("id").alias("top")), "classes")
    got = Counter(map(tuple, common.joined_classes(rows, classes, "key", "n").collect()))
    assert got == Counter(map(tuple, rows.join(classes, "key", "left").select("id", "key", "n", "top").collect()))
