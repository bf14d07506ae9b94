"""Repeated values by a counting sketch."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.operators import checks, counting, repeats
from orderloom.plans.benchmark import open_benchmark
from tests.conftest import SMALL


def test_unique_keys_are_hardly_shuffled(spark):
    w = open_benchmark(spark, SMALL)
    rows = w.fact().count()
    again = repeats.marked(w.fact(), [F.col("sales_key")]).where(repeats.AGAIN)
    assert 0 <= again.count() < 0.05 * rows
    assert repeats.repeated_counts(w.fact(), ["sales_key"]).count() == 0
    many = spark.range(300_000).selectExpr("uuid() AS k")
    assert repeats.marked(many, [F.col("k")]).where(repeats.AGAIN).count() < 0.05 * 300_000


@pytest.mark.parametrize("slots", [8, 64, 4096, 1 << 20])
def test_no_repeat_is_missed_whatever_the_size(spark, slots):
    """Repeats within a task and over tasks, down to a sketch of one byte."""
    rows = spark.range(0, 3000, 1, 7).selectExpr("id", "CASE WHEN id % 5 = 0 THEN id % 400 WHEN id % 5 = 1 THEN null ELSE id END AS k")
    wanted = {r["k"] for r in rows.groupBy("k").count().where("count > 1").collect()} - {None}
    kept = repeats.marked(rows, [F.col("k")], slots).where(repeats.AGAIN)
    assert wanted <= {r["k"] for r in kept.collect()}
    found = Counter(r["row_count"] for r in repeats.repeated_counts(rows, ["k"], nulls=False).collect())
    assert found == Counter(r["row_count"] for r in checks.repeats(rows, ["k"], nulls=False).collect())


def test_several_columns_and_nulls(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (None, "a"), (2, "b"), (None, None), (None, None)], "k int, v string")
    for columns, nulls in ((["k", "v"], True), (["k", "v"], False), (["v"], False), (["k"], True)):
        wanted = Counter(r["row_count"] for r in checks.repeats(rows, columns, nulls).collect())
        assert Counter(r["row_count"] for r in repeats.repeated_counts(rows, columns, nulls).collect()) == wanted
    assert repeats.repeated_counts(rows.limit(0), ["k"]).count() == 0


def test_sketches_merge_by_or():
    r = np.random.default_rng(2)
    parts = [r.integers(-(1 << 62), 1 << 62, n) for n in (0, 1, 500, 3000)]
    parts.append(parts[2][:50])
    whole, merged = repeats.Sketch(1 << 14), repeats.Sketch(1 << 14)
    whole.add(np.concatenate(parts))
    for part in parts:
        one = repeats.Sketch(1 << 14)
        for half in (part[::2], part[1::2]):
            one.add(half)
        merged.merge(one.hit, one.twice)
    slots = np.concatenate(parts) & ((1 << 14) - 1)
    times = np.bincount(slots, minlength=1 << 14)
    at = np.arange(1 << 14)
    for sketch in (whole, merged):
        assert (repeats._has(sketch.hit, at) == (times > 0)).all() and (repeats._has(sketch.twice, at) == (times > 1)).all()


def test_top_values_of_columns_of_many_values(spark):
    rows = spark.range(0, 4000, 1, 5).selectExpr(
        "cast(id AS string) AS one_each",
        "CASE WHEN id % 10 = 0 THEN 'hot' WHEN id % 7 = 0 THEN null ELSE concat('v', id % 1500) END AS mixed",
        "cast(id % 3 AS string) AS few",
        "cast(null AS string) AS none",
        "if(id < 30, 'aa', concat('z', id)) AS copies_first",
    )
    columns = rows.columns
    for k in (1, 4, 25):
        wanted = Counter(map(tuple, counting.top_values(rows, columns, k).collect()))
        assert Counter(map(tuple, repeats.top_values_of_many(rows, columns, k).collect())) == wanted
    assert repeats.top_values_of_many(rows.limit(0), columns, 3).count() == 0


def test_what_is_handed_on_grows_with_the_rows(spark, monkeypatch):
    """Not with tasks and slots, and pieces that hold too many repeats let all their rows through."""
    slots = repeats.slots_for(400_000_000)
    assert slots >= 32 * 400_000_000  # few keys share a slot beyond 134 million rows, too
    hashes = np.random.default_rng(5).integers(-(1 << 62), 1 << 62, 50_000)
    width = min(slots, repeats.PIECE)
    batch = repeats._handed_on(slots, width, [hashes, hashes[:10]])
    assert batch.nbytes < 8 * 50_000
    hit = [p * width + repeats._slots(x) for p, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
    again = [p * width + repeats._slots(x) for p, x in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
    assert np.concatenate(hit).tolist() == sorted(set((hashes & (slots - 1)).tolist()))
    assert set((hashes[:10] & (slots - 1)).tolist()) <= set(np.concatenate(again).tolist())

    rows = spark.range(0, 6000, 1, 5).selectExpr("id % 4000 AS k")
    for piece, most in ((64, 1 << 20), (64, 8), (1 << 12, 1 << 20)):
        monkeypatch.setattr(repeats, "PIECE", piece)
        monkeypatch.setattr(repeats, "MOST_TWICE", most)
        found = Counter(r["row_count"] for r in repeats.repeated_counts(rows, ["k"]).collect())
        assert found == Counter(r["row_count"] for r in checks.repeats(rows, ["k"], nulls=True).collect()) == Counter({2: 2000})
