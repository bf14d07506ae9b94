"""Files of token ids, compressed block by block.

``write_ids`` deals the documents out by ranges of their id, encodes each range in
ascending order and writes a table whose rows are segments, in the order of (part,
place). A segment is self-contained:

    magic "OLID", version u16, documents u32, blocks u32, crc32 of the header u32
    bytes of the next entry u32; the shares of the ids of the segment, u32 from id 0 on, as a zlib stream
    per document: 1 if it has an id else 0 (u8), its id i64, its ids u64
    per block: ids u32, bytes u32, crc32 of the ids as little-endian u32 (u32)
    the blocks' range-coded payloads

Blocks are coded apart from each other, whether or not a document goes on in the next
one, so each can be read and checked with the shares alone. A segment holds whole documents, so a very long
one makes a long segment of many blocks. Extra columns are ignored. All
numbers are little-endian. Null texts are empty and have the end id only; documents
without id come first, those that share an id are in text order. An empty table makes
an empty file table. A block whose ids miss their checksum is an error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from orderloom.llm.common import ship, texts
from orderloom.llm.range_coder import BLOCK, MOST_IDS, checksum, decode_blocks, encode_blocks, shares_of
from orderloom.llm.token_ids import runs

#: Ids after which a segment ends, with the document it is in, and ids that a reader decodes at a time.
SEGMENT = 8 << 20
#: Bytes of ids in a batch that a reader hands on.
BATCH_BYTES = 16 << 20
_MAGIC, _VERSION = b"OLID", 2
_HEAD, _SHARES, _DOCUMENT, _BLOCK = struct.Struct("<4sHIII"), struct.Struct("<I"), struct.Struct("<BqQ"), struct.Struct("<III")
_FILES = "part int, place int, earlier long, n_ids long, segment binary"


def pack_segment(ids: list[int | None], documents: list[bytes]) -> bytes:
    """A segment of some documents, given by the bytes of their ids."""
    whole = np.frombuffer(b"".join(documents), "<u4")
    blocks = [whole[i : i + BLOCK] for i in range(0, len(whole), BLOCK)]
    if len(whole) and whole.max() >= MOST_IDS:
        raise ValueError(f"ids must be from 0 to {MOST_IDS - 1}")
    shares = shares_of(whole)
    payloads = encode_blocks(blocks, shares)
    packed = zlib.compress(shares.astype("<u4").tobytes())
    table = _SHARES.pack(len(packed)) + packed
    table += b"".join(_DOCUMENT.pack(i is not None, i or 0, len(x) // 4) for i, x in zip(ids, documents, strict=True))
    table += b"".join(_BLOCK.pack(len(x), len(y), checksum(x)) for x, y in zip(blocks, payloads, strict=True))
    return _HEAD.pack(_MAGIC, _VERSION, len(ids), len(blocks), zlib.crc32(table)) + table + b"".join(payloads)


def _parse(segment: bytes) -> tuple[list[int | None], list[int], np.ndarray, list[bytes], list[int], list[int]]:
    """Document ids, their numbers of ids, shares of the ids, block payloads, their numbers of ids and checksums."""
    magic, version, n_docs, n_blocks, crc = _HEAD.unpack_from(segment)
    if magic != _MAGIC or version != _VERSION:
        raise ValueError("not a segment of token ids, or of another version")
    first = _HEAD.size + _SHARES.size + _SHARES.unpack_from(segment, _HEAD.size)[0]
    at = first + n_docs * _DOCUMENT.size
    end = at + n_blocks * _BLOCK.size
    if zlib.crc32(segment[_HEAD.size : end]) != crc:
        raise ValueError("damaged segment header")
    documents = list(_DOCUMENT.iter_unpack(segment[first:at]))
    blocks = list(_BLOCK.iter_unpack(segment[at:end]))
    shares = np.frombuffer(zlib.decompress(segment[_HEAD.size + _SHARES.size : first]), "<u4")
    payloads = []
    for _, size, _ in blocks:
        payloads.append(segment[end : end + size])
        end += size
    return [i if known else None for known, i, _ in documents], [n for _, _, n in documents], shares, payloads, [n for n, _, _ in blocks], [c for _, _, c in blocks]


def unpack_segments(segments: list[bytes]) -> list[list[tuple[int | None, np.ndarray]]]:
    """(document id, ids) of each segment's documents; the blocks of a segment are decoded side by side."""
    out = []
    for segment in segments:
        ids, sizes, shares, payloads, lengths, checks = _parse(segment)
        own = decode_blocks(payloads, lengths, shares)
        for x, check in zip(own, checks, strict=True):
            if checksum(x) != check:
                raise ValueError("damaged block of token ids")
        whole = np.concatenate(own).astype("<u4") if own else np.zeros(0, "<u4")
        ends = np.cumsum(sizes)
        out.append([(i, whole[b - n : b]) for i, n, b in zip(ids, sizes, ends.tolist(), strict=True)])
    return out


def write_ids(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the ids of all documents, each with the end id, in ascending doc_id order."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, earlier = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        documents: list[bytes] = []

        def segment() -> pa.RecordBatch:
            nonlocal place, earlier
            n = sum(map(len, documents)) // 4
            columns = [[part], [place], [earlier], [n], [pack_segment(ids, documents)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            place, earlier = place + 1, earlier + n
            ids.clear()
            documents.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "place", "earlier", "n_ids", "segment"])

        waiting = 0
        for batch, found in runs(batches, tokenizer, kept=True):
            for i, x in zip(batch.column(0).to_pylist(), found, strict=True):
                ids.append(i)
                documents.append(x)
                waiting += len(x) // 4
                if waiting >= SEGMENT:
                    yield segment()
                    waiting = 0
        if ids:
            yield segment()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, _FILES).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of each document in the files; ``start`` counts the ids of all before it."""
    ship(spark)
    files = spark.read.schema(_FILES).parquet(path)
    # a row per part of the files
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    first = totals.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _groups(batch):
                parts, earlier = group.column("part").to_pylist(), group.column("earlier").to_pylist()
                rows, held = [], 0
                for part, start, documents in zip(parts, earlier, unpack_segments(group.column("segment").to_pylist()), strict=True):
                    for i, ids in documents:
                        rows.append((part, i, start, len(ids), ids.tobytes()))
                        start += len(ids)
                        held += 4 * len(ids)
                        if held >= BATCH_BYTES:
                            yield _rows(rows)
                            rows, held = [], 0
                yield _rows(rows)

    found = files.select("part", "earlier", "n_ids", "segment").mapInArrow(run, "part int, doc_id long, start long, n_tokens long, ids binary")
    return found.join(F.broadcast(first), "part").select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids")


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows that hold about SEGMENT ids together."""
    first, held = 0, 0
    for k, n in enumerate(batch.column("n_ids").to_pylist()):
        if held and held + n > SEGMENT * 5 // 4:
            yield batch.slice(first, k - first)
            first, held = k, 0
        held += n
    if first < batch.num_rows:
        yield batch.slice(first)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "doc_id", "start", "n_tokens", "ids"])
