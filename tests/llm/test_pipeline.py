import re

from pyspark.sql import functions as F

import corpus_pipeline as p
from orderloom.llm import toxicity
from orderloom.llm.catalog import TOXIC
from tests.llm.test_jaccard_join import brute
from tests.llm.test_packing import check
from tests.llm.test_secret_scan import PLANTED

SMALL = "/root/testdata/sf0.01"


def stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}

    calm = stored(p.STAGES[0][1](spark, docs, SMALL), tmp_path / "1")
    model = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = {r["doc_id"]: r["toxic_score"] for r in toxicity.score(docs, model).collect()}
    left = {r["doc_id"]: r.asDict() for r in calm.collect()}
    assert calm.columns == columns and left == {i: r for i, r in rows.items() if scores[i] < TOXIC}

    single = stored(p.STAGES[1][1](spark, calm, SMALL), tmp_path / "2")
    groups = brute([(i, r["text"]) for i, r in left.items()])
    left = {i: r for i, r in left.items() if (i, i) in {(a, c) for a, _, c in groups}}
    assert single.columns == columns and {r["doc_id"]: r.asDict() for r in single.collect()} == left

    clean = stored(p.STAGES[2][1](spark, single, SMALL), tmp_path / "3")
    assert clean.columns == columns
    texts = {}
    for r in clean.collect():
        before = left[r["doc_id"]]
        parts = [m.span(m.lastindex) for m in PLANTED.finditer(before["text"])]
        text = before["text"]
        for a, b in reversed(parts):
            text = text[:a] + "[SECRET]" + text[b:]
        assert r["text"] == text and r["n_chars"] == (len(text) if parts else before["n_chars"])
        texts[r["doc_id"]] = text
    assert len(texts) == len(left)

    check(p.STAGES[3][1](spark, clean, SMALL).collect(), texts)
    assert p.run(spark, SMALL).count() >= len(texts)


def test_edge_rows(spark, tmp_path, make_docs):
    rows = [(1, None), (2, ""), (3, "same words in both of these rows"), (3, "same words in both of these rows"), (None, "Same words in both of these rows"), (None, None), (4, "long " * 30_000), (5, "password=0a1b2c3d4e5f607182 rest")]
    docs = stored(make_docs(*rows), tmp_path / "0")
    kept = docs
    for k, (_, stage) in enumerate(p.STAGES[:-1]):
        kept = stored(stage(spark, kept, SMALL), tmp_path / f"s{k}")
        assert kept.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert [i for i, _ in found].count(3) == 1 and sum(t is None for _, t in found) == 2 and len(found) == 6
    assert any(re.search(r"password=\[SECRET\]", t or "") for _, t in found)
    pieces = p.STAGES[-1][1](spark, kept, SMALL).collect()
    assert {r["doc_id"] for r in pieces} == {i for i, _ in found}


def test_own_columns_come_back_and_parallelism_changes_nothing(spark, tmp_path, make_docs, monkeypatch):
    words = [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(words[k % 7 * 8 :]) + " tail" * (i % 2)) for i, k in enumerate(range(70))]
    docs = make_docs(*rows).select("*", F.col("doc_id").alias("row_number"), F.lit("kept").alias("ROW_NUMBER_"), F.lit("too").alias("text_before"))
    docs = stored(docs.repartition(9), tmp_path / "docs")
    found = []
    for at, size in enumerate(["128m", "2k", "1m"]):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        real, classes = p.jaccard_classes, []

        def changed(*args, **more):
            out = real(*args, **more)
            # what is read after this is dealt to other tasks than before
            spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
            classes.append(out)
            return out

        monkeypatch.setattr(p, "jaccard_classes", changed)
        kept = p.drop_near_duplicates(spark, docs, SMALL)
        assert kept.columns == docs.columns and classes
        kept = p.replace_secrets(spark, stored(kept, tmp_path / str(at)), SMALL).collect()
        monkeypatch.setattr(p, "jaccard_classes", real)
        found.append(sorted(r["doc_id"] for r in kept))
        assert all(r["row_number"] == r["doc_id"] and r["ROW_NUMBER_"] == "kept" and r["text_before"] == "too" for r in kept)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    groups = brute(rows)
    assert found[0] == found[1] == found[2] == sorted({c for _, _, c in groups})


def test_empty_table(spark, tmp_path, make_docs):
    docs = stored(make_docs().limit(0), tmp_path / "0")
    for _, stage in p.STAGES:
        assert stage(spark, docs, SMALL).count() == 0
