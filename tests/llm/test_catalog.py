"""Registration, SQL counterparts, shared helpers."""

import glob
import re
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from orderloom.llm import catalog, common
from tests.llm.conftest import SMALL


def test_every_operator_and_the_pipeline_are_registered():
    numbers = sorted(int(m[1]) for name in entry.queries() if (m := re.match(r"op(\d+)_", name)))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for file in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(file).stem} AS SELECT * FROM '{file}'")
    found = catalog.QUERIES[name](spark, SMALL)
    wanted = con.execute(catalog.ORACLES[name])
    order = [[c[0] for c in wanted.description].index(c) for c in found.columns]
    assert Counter(map(tuple, found.collect())) == Counter(tuple(r[i] for i in order) for r in wanted.fetchall())


def words_of(texts):
    out = []
    for _, data, offsets in common.slices(pa.array(texts, pa.string())):
        hashes, bounds = common.word_hashes(data, offsets)
        out += [hashes[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    return out


def test_words_of_consecutive_texts():
    texts = ["Ab cd", "", "ab", " \t cd\x0bAB ", "ab cd", "É", "x" * 3_000_000, "ab"]
    found = words_of(texts)
    ab, cd = found[0]
    assert found[1] == [] and found[2] == found[7] == [ab] and found[3] == [cd, ab]
    assert len(found[4]) == 1 and found[4][0] not in (ab, cd) and len(found[5]) == 1 and len(found[6]) == 1
    assert words_of(["CD"]) == [[cd]]


def test_sampled_is_bounded_and_repeatable(spark):
    rows = spark.range(5000)
    one = {r["id"] for r in common.sampled(rows, "id", 300).collect()}
    assert len(one) == 300 and one == {r["id"] for r in common.sampled(rows.repartition(7), "id", 300).collect()}
    assert common.sampled(rows.limit(20), "id", 300).count() == 20


def test_scratch_leaves_only_what_is_kept(spark, tmp_path):
    def parts():
        return {p.name for p in (Path(spark.conf.get("spark.checkpoint.dir")) / "llm").iterdir()}

    common.stored(spark.range(3), "before")
    before = parts()
    with common.scratch(spark):
        inner = common.stored(spark.range(5), "inner")
        with common.scratch(spark):
            common.stored(spark.range(2), "innermost")
        assert inner.count() == 5
        inner.write.parquet(str(tmp_path / "out"))
    assert parts() == before and spark.read.parquet(str(tmp_path / "out")).count() == 5
    kept = common.new_path(spark, "kept")
    with pytest.raises(RuntimeError), common.scratch(spark, kept):
        spark.range(1).write.parquet(kept)
        common.stored(spark.range(2), "lost")
        raise RuntimeError
    assert len(parts() - before) == 1


def test_the_pipeline_leaves_stages_only(spark):
    import corpus_pipeline

    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "llm"
    before = {p.name for p in folder.iterdir()}
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    left = {p.name.rsplit("-", 1)[0] for p in folder.iterdir()} if not before else {p.name.rsplit("-", 1)[0] for p in folder.iterdir() if p.name not in before}
    assert {"pipeline-toxicity", "pipeline-near_duplicates", "pipeline-secrets"} <= left
    assert not left & {"sets", "gathered", "numbered", "members", "secret-labels"}
