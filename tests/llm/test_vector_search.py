import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderloom.llm import catalog
from orderloom.llm import vector_search as v
from tests.conftest import plan
from tests.llm.conftest import SMALL


def brute(ids, vectors, query, k=5):
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    score = unit @ unit[query]
    score[query] = -9
    return [(ids[i], score[i]) for i in np.lexsort((ids, -score))[:k]]


def test_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = {}
    for r in catalog.QUERIES["op4_vector_search"](spark, SMALL).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {int(i) for i in ids if i % 50 == 0}
    hits = total = 0
    for query, own in found.items():
        own.sort()
        assert [x[0] for x in own] == [1, 2, 3, 4, 5]
        at = int(np.flatnonzero(ids == query)[0])
        true = brute(ids, vectors, at)
        hits += len({x[1] for x in own} & {int(i) for i, _ in true})
        total += 5
        for _, i, score in own:
            a, b = vectors[at], vectors[int(np.flatnonzero(ids == i)[0])]
            assert math.isclose(score, a @ b / math.sqrt(a @ a) / math.sqrt(b @ b), rel_tol=1e-12)
    assert hits / total >= 0.9


def test_clusters_copies_and_odd_vectors(spark):
    r = np.random.default_rng(0)
    rows = [(k, r.normal(size=16).tolist()) for k in range(200)] + [(1000 + k, [1.0] * 16) for k in range(40)]
    rows += [(50, [1.0] * 16), (3000, None), (3050, [0.0] * 16), (3100, [float("nan")] + [1.0] * 15), (3150, [float("inf")] * 16), (3200, [1.0, 2.0]), (3250, [None] + [1.0] * 15), (None, [1.0] * 16)]
    frame = spark.createDataFrame([(i, x, 3, "clash") for i, x in rows], "vec_id long, embedding array<double>, row int, vector string")
    found = v.search(frame, "vec_id % 50 = 0").collect()
    assert not {r["query_id"] for r in found} & {3000, 3050, 3100, 3150, 3200, 3250}
    copies = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == 1000)
    assert [i for _, i, _ in copies] == [50, 1001, 1002, 1003, 1004] and all(math.isclose(s, 1) for _, _, s in copies)


def test_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert v.search(spark.createDataFrame([], schema), "true").count() == 0
    assert v.search(spark.createDataFrame([(0, [1.0] * 8)], schema), "true").count() == 0
    three = spark.createDataFrame([(0, [1.0] * 8), (1, [1.0] * 7 + [0.0]), (2, [-1.0] * 8)], schema)
    assert sorted((r["rank"], r["vec_id"]) for r in v.search(three, "vec_id = 0").collect()) == [(1, 1), (2, 2)]


@pytest.mark.parametrize("group_rows", [20, 100, 100_000])
def test_candidates_are_all_codes_in_the_radius_once(spark, monkeypatch, group_rows):
    r = np.random.default_rng(1)
    codes = r.integers(0, 1 << 48, 400, dtype=np.uint64)
    codes[100:300] = codes[0] ^ (np.uint64(1) << r.integers(0, 48, 200, dtype=np.uint64))  # one value in most positions
    monkeypatch.setattr(v, "GROUP_ROWS", group_rows)
    data = spark.createDataFrame([(i, int(c)) for i, c in enumerate(codes)], "row long, code long")
    asked = [0, 1, 150, 399]
    queries = spark.createDataFrame([(i, int(codes[i])) for i in asked], "query_row long, query_code long")
    for radius in (0, 5, 14, 30):
        lists = v.candidates(data, queries, radius, v.substrings(48, radius, 400), 400).collect()
        found = [(x["query_row"], i) for x in lists for i in x["among"]]
        wanted = {(q, i) for q in asked for i in range(400) if int(codes[q] ^ codes[i]).bit_count() <= radius}
        assert len(found) == len(wanted) and set(found) == wanted


def test_thresholds_cover_the_radius():
    for positions in range(1, 9):
        for radius in range(8 * positions):
            assert sum(t + 1 for t in v.thresholds(radius, positions)) > radius
    for bits in (8, 16, 40, 64):
        for radius in range(bits):
            found = v.substrings(bits, radius, 1_000_000)
            assert sum(t + 1 for _, _, t in found) > radius or any(t == w for _, w, t in found)
            assert all(a + w <= b for (a, w, _), (b, _, _) in zip(found, found[1:], strict=False)) and found[-1][0] + found[-1][1] <= bits


def test_width_grows_with_the_rows():
    few, many = v.substrings(64, 10, 1_000), v.substrings(64, 10, 10**9)
    assert max(w for _, w, _ in few) < max(w for _, w, _ in many) <= 16


def test_tiny_and_huge_components_and_mixed_lengths(spark):
    r = np.random.default_rng(4)
    base = {n: r.normal(size=(40, n)) for n in (3, 16, 70)}
    rows, exact = [], {}
    for n, vectors in base.items():
        for i, x in enumerate(vectors):
            rows.append((1000 * n + i, [float(y) for y in x * (1.0, 1e-200, 1e200, 1e-300)[i % 4]]))
    for n in base:
        own = [(i, np.array(x)) for i, x in rows if len(x) == n]
        whole = np.stack([np.ldexp(x, -np.frexp(np.abs(x).max())[1]) for _, x in own])
        ids = np.array([i for i, _ in own])
        for at, i in enumerate(ids.tolist()):
            if i % 50 == 0:
                exact[i] = brute(ids, whole, at, 39)
    found = {}
    for x in v.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 50 = 0").collect():
        found.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    assert set(found) == set(exact)
    for i, own in found.items():
        assert [x[0] for x in sorted(own)] == [1, 2, 3, 4, 5]
        true = dict(exact[i])
        assert all(math.isclose(s, true[j], rel_tol=1e-9, abs_tol=1e-12) for _, j, s in own)


def test_a_third_of_equal_vectors_and_one_id_twice(spark):
    r = np.random.default_rng(9)
    rows = [(k, r.normal(size=24).tolist()) for k in range(400)] + [(500 + k, [2.0, -1.0] * 12) for k in range(300)]
    rows += [(500, [4.0, -2.0] * 12), (500, [2.0, -1.0] * 12)]
    found = v.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id in (0, 500, 507)").collect()
    own = {}
    for x in found:
        own.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], round(x["score"], 9)))
    assert sorted(own[507]) == [(1, 500, 1.0), (2, 500, 1.0), (3, 500, 1.0), (4, 501, 1.0), (5, 502, 1.0)]
    assert Counter(i for _, i, _ in own[500]) == Counter({500: 6, 501: 3, 502: 3, 503: 3}) and len(own[0]) == 5


def test_no_exchange_holds_a_vector_per_query_block(spark):
    """The data's vectors are dealt to their blocks, not to pairs of blocks of data and queries."""
    tree = plan(v.search(spark.read.parquet(f"{SMALL}/embeddings.parquet"), "true"))
    assert "CartesianProduct" not in tree and "NestedLoop" not in tree and tree.count("CoGroups") == 0


def test_lists_of_a_group_are_handed_on_in_bounded_batches(spark, monkeypatch):
    """A task holds one group's rows and a batch of lists, not the lists of all queries that meet the group."""
    monkeypatch.setattr(v, "HANDED_ROWS", 1000)
    codes, names = np.arange(512, dtype=np.int64), ["position", "group", "part", "asked", "value", "row", "code"]

    def batch(asked: bool, group: int) -> pa.RecordBatch:
        same = [np.full(256, x) for x in (0, group, 0)]
        own = codes[256 * group :][:256]
        return pa.RecordBatch.from_arrays([*map(pa.array, same), pa.array([asked] * 256), *map(pa.array, (own if not asked else own * 0, own + 7000, own))], names)

    run = v._met([(0, 9, 9)], [8], 2)
    out = list(run(iter([batch(False, 0), batch(True, 0), batch(False, 1), batch(True, 1)])))
    sizes = [sum(map(len, x.column("among").to_pylist())) for x in out]
    assert len(out) > 10 and max(sizes) <= 1000 + 256
    found = {(q, i) for x in out for q, among in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True) for i in among}
    assert found == {(7000 + a, 7000 + b) for a in range(512) for b in range(512) if a >> 8 == b >> 8 and (a ^ b).bit_count() <= 2}
    data = spark.createDataFrame([(i, i) for i in range(9)], "row long, code long")
    assert "CoGroups" not in plan(v.candidates(data, data.toDF("query_row", "query_code"), 2, [(0, 9, 2)], 9))
