"""Registered queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import alignment, bpe, hidden_markov, html_text, id_files, piece_bpe, secret_scan, toxicity
from orderloom.llm.collocations import collocations
from orderloom.llm.common import new_path
from orderloom.llm.fingerprints import fingerprinted
from orderloom.llm.jaccard_join import jaccard_classes
from orderloom.llm.packing import packed
from orderloom.llm.vector_search import search

#: Score from which a document counts as toxic.
TOXIC = 0.7

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of all documents, on five-word shingles and a similarity of 0.75."""
    return jaccard_classes(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens, a row per piece."""
    return packed(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Syncmer fingerprints of all documents, and their likeness to an edited text's and the next document's."""
    return fingerprinted(_table(spark, folder, "documents"))


def op4_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth embedding."""
    return search(_table(spark, folder, "embeddings"), "vec_id % 50 = 0")


def op5_token_id_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents, written to compressed files and read back."""
    path = new_path(spark, "token-ids")
    id_files.write_ids(_table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return id_files.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_hmm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Hidden Markov scores of all documents, learnt from nine tenths of the ids."""
    return hidden_markov.scored(_table(spark, folder, "documents"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents, with their places."""
    docs = _table(spark, folder, "documents")
    return secret_scan.findings(docs, secret_scan.fit(docs))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learnt from two of three folds of the labelled ids."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    model = toxicity.fit(docs, labels.where(fold != 1))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(fold == 1, F.lit(False)).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= TOXIC).cast("int").alias("predicted"),
    )


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    pages = _table(spark, folder, "pages")
    found = html_text.extracted(pages, html_text.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents by the prefix table, and the bytes they decode to, as digests."""
    found = bpe.coded(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_piece_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents by merge rounds over the pieces, and the text they decode to, as digests."""
    found = piece_bpe.coded(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of the alignment of two tokenizers over every document, each distinct text aligned once."""
    docs = _table(spark, folder, "documents")
    return alignment.measures(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 strongest phrases of each language of all documents."""
    return collocations(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_packing": op2_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_vector_search": op4_vector_search,
    "op5_token_id_files": op5_token_id_files,
    "op6_hmm_scores": op6_hmm_scores,
    "op7_secret_scan": op7_secret_scan,
    "op8_toxicity": op8_toxicity,
    "op9_html_extraction": op9_html_extraction,
    "op10_prefix_bpe": op10_prefix_bpe,
    "op11_piece_bpe": op11_piece_bpe,
    "op12_token_alignment": op12_token_alignment,
    "op13_collocations": op13_collocations,
}

_OP1 = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM worded
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * k >= 75 * (x.n + y.n - k)
),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

_OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM worded GROUP BY lang),
counted AS (
  SELECT lang, m AS len, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM worded, range(1, 6) AS lengths(m))
  GROUP BY ALL HAVING count(*) >= 100
),
inside AS (
  SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:len - 1], ' '), array_to_string(string_split(phrase, ' ')[2:len], ' ')]) AS phrase
  FROM counted WHERE len > 2
),
candidates AS (
  SELECT * FROM counted c
  WHERE len > 1 AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND i.f >= c.f)
),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[k + 1:len], ' ') AS tail
  FROM (SELECT *, unnest(range(1, len)) AS k FROM candidates)
),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, n, (1000 * a * n) // (x.f * y.f) AS score,
    row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY (1000 * a * n) // (x.f * y.f), k) AS place
  FROM cuts JOIN counted x ON x.lang = cuts.lang AND x.phrase = head
    JOIN counted y ON y.lang = cuts.lang AND y.phrase = tail JOIN sizes ON sizes.lang = cuts.lang
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored WHERE place = 1
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": _OP1,
    "op13_collocations": _OP13,
}
