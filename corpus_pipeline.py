"""From raw documents to packed training sequences.

Four stages, each on all that its predecessor kept: toxic documents go, one document
of each near-duplicate group stays, secrets are replaced in the text, and what is left
is packed into sequences. The first three return the columns of their input; extra
columns pass through. Null texts count as empty: they are kept, as are documents
without words, and packed as a lone end id. Repeated rows are near duplicates of each
other, so one of them stays; of a group, the smallest id stays and rows without id
go first. Empty tables pass through every stage.

Stages read their ``docs`` more than once, so ``docs`` must be stored rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import packing, secret_scan, toxicity
from orderloom.llm.catalog import TOXIC
from orderloom.llm.common import joined_classes, new_path, scratch, ship, stored
from orderloom.llm.jaccard_join import BROADCAST_IDS, jaccard_classes


def _own_name(docs: DataFrame, wanted: str) -> str:
    """A name that no column has."""
    taken = {c.lower() for c in docs.columns}
    while wanted in taken:
        wanted += "_"
    return wanted


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all labels, scores below the threshold."""
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.scorer(model)(F.col("text").cast("string")) < TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by a similarity of 0.75 or more of five-word shingles."""
    row = _own_name(docs, "row_number")
    # numbers depend on how files are dealt to tasks: rows get them once, and all that follows reads these rows
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classes = jaccard_classes(numbered, key=row).where("n_shingles > 0").select(F.col("doc_id").alias("at"), "component_id")
    members = stored(classes.join(numbered.select(F.col(row).alias("at"), "doc_id"), "at"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "at")
    kept = members.groupBy("component_id").agg(F.min(order)["at"].alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # a group may hold a third of all rows: large ones are broadcast, of which there can't be many
    rest = joined_classes(members.select("at", "component_id"), stored(kept, "kept"), "component_id", "n").where("at <> kept")
    rest = stored(rest.select(F.col("at").alias(row)), "copies")
    # counted: 16 MB of row numbers at most are broadcast, more are joined by a shuffle of the rows
    few = rest.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return numbered.join(F.broadcast(rest) if few else rest, row, "left_anti").select(*docs.columns)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; ``n_chars`` counts the new text where it was replaced."""
    before = _own_name(docs, "text_before")
    clean = secret_scan.redacted(docs.withColumn(before, F.col("text")), secret_scan.fit(docs))
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col(before))
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 ids."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", replace_secrets),
    ("packing", pack_sequences),
]

#: A trained classifier and a forest decide what stays; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; a stage's intermediates go when its rows are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
