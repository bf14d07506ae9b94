import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def own_texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents with columns whose names the operators use themselves."""

    def build(*rows):
        filled = [(i, t, "en", "s", None if t is None else len(t), 7, "x", 1.5) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, row int, set_id string, toxic_score double"
        return spark.createDataFrame(filled, schema)

    return build
