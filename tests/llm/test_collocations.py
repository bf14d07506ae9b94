import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderloom.llm import catalog, collocations
from tests.llm.conftest import SMALL

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, top=2000, depth=5):
    """Every phrase of every piece in one counter, every longer phrase searched for every shorter one."""
    f, n = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            f[lang or "und"].update(tuple(words[i : i + m]) for m in range(1, depth + 1) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {
            q[i : i + m] for q, b in candidates.items() for m in range(2, len(q)) for i in range(len(q) - m + 1) if b >= counts[q[i : i + m]]
        }
        scored = []
        for p, a in candidates.items():
            if p not in inside:
                score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def found(docs, least, **more):
    out = collocations.collocations(docs, least, **more)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()))


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text").collect()
    got = sorted(map(tuple, catalog.QUERIES["op13_collocations"](spark, SMALL).collect()))
    assert got and got == brute(rows, 100)


@pytest.mark.parametrize(("least", "top", "depth"), [(7, 2000, 5), (4, 30, 4), (12, 2000, 2), (5, 2000, 3)])
def test_other_bounds(spark, monkeypatch, least, top, depth):
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 17)  # so small that filters let much through
    monkeypatch.setattr(collocations, "BROADCAST_LANGS", 2)
    monkeypatch.setattr(collocations, "MERGED_ROWS", 100 * depth)  # tasks add up again and again
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text")
    assert found(docs.repartition(7), least, top=top, depth=depth) == brute(docs.collect(), least, top, depth)


ROWS = [
    (None, "A b c. A B c, a b\tc d"),
    (None, "a b c"),
    ("en", None),
    ("en", ""),
    ("en", " \n.,;"),
    ("en", "x x x x x x"),
    ("en", "x x x"),
    ("fr", "Été à l'été\x0bété à l'été\r\nété à L'ÉTÉ \x1c y \x1c y"),
    ("fr", "Été à l'été\x0bété à l'été\r\nété à L'ÉTÉ \x1c y \x1c y"),
    ("de", "<|endoftext|> 日本 語 <|endoftext|> 日本 語"),
]


def test_edge_rows(spark):
    filled = [(i if i % 3 else None, t, lang, 1, "w", 2.5) for i, (lang, t) in enumerate(ROWS)]
    docs = spark.createDataFrame(filled, "doc_id long, text string, lang string, n long, word string, score double")
    for least in (1, 2, 3):
        assert found(docs, least) == brute(ROWS, least)
    assert found(docs.limit(0), 1) == []


def test_parts_and_shards(monkeypatch):
    rows = ROWS + [("en", "one very long piece without any mark " * 40 + "end; " + "tail of it " * 9)]
    batches = [pa.record_batch([pa.array([x[0] or "und" for x in rows]), pa.array([x[1] or "" for x in rows])], ["lang", "text"])]

    def words(found):
        out = Counter()
        for lang, ids, listed in found:
            cut = np.split(ids, np.flatnonzero(ids == 0))
            out.update((lang, tuple(listed[i] for i in x if i)) for x in cut if (x > 0).any())
        return out

    whole = words(collocations.shards(iter(batches)))
    monkeypatch.setattr(collocations, "PART_BYTES", 16)
    monkeypatch.setattr(collocations, "SHARD_WORDS", 5)
    parts = list(collocations.shards(iter(batches)))
    assert words(parts) == whole and len(parts) > 5


def test_intervals_are_those_of_the_text():
    rng = np.random.default_rng(3)
    for depth in (2, 3, 4, 5):
        text = np.concatenate(([0], rng.integers(0, 4, 400), [0]))
        pieces = [tuple(x[x > 0].tolist()) for x in np.split(text, np.flatnonzero(text == 0))]
        f = Counter(p[i : i + m] for p in pieces for m in range(2, depth + 2) for i in range(len(p) - m + 1))
        got = {}
        for level in collocations.phrases(text, depth):
            for w, n, left, right in zip(level.words.tolist(), level.n.tolist(), level.left.tolist(), level.right.tolist(), strict=True):
                got[tuple(w)] = n
                if len(w) < depth:
                    assert left == max((f[(x, *w)] for x in range(1, 4)), default=0)
                    assert right == max((f[(*w, x)] for x in range(1, 4)), default=0)
        assert got == {p: n for p, n in f.items() if len(p) <= depth}


def test_hashes_are_those_of_spark(spark):
    words = ["a", "ñandú", "", "x" * 70, "日本語の長いテキストを使う"]
    wanted = spark.createDataFrame([(x,) for x in words], "word string").select(F.xxhash64(F.lit("fr"), "word")).collect()
    assert collocations.word_hashes("fr", [b"\xff", *(x.encode() for x in words)])[1:].view(np.int64).tolist() == [r[0] for r in wanted]
