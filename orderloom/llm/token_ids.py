"""Token ids of whole texts by the tokenizers library."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from orderloom.llm.common import texts_of_batch
from orderloom.llm.pieces import Pieces

#: Id that ends each document, and bytes of text that a worker encodes at a time.
END, RUN_BYTES = 0, 2 << 20
#: What the byte-level pattern splits from the letters before it, unless a special token holds it.
MARKS = ".,;:!?"


class ByteTokens:
    """A byte-level tokenizer; ``special_as_text`` reads the strings of special tokens as any other text."""

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        special = "".join(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.marks = "" if set(MARKS) & set(special) else MARKS
        self._starts = np.array([self.tokenizer.id_to_token(i)[:1] in ("Ġ", "Ċ") for i in range(self.tokenizer.get_vocab_size())])

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, texts: list[str]) -> list[bytes]:
        """The same for pieces of text that start with a space or line break and hold no other."""
        # as one text: only the first token of a piece begins with its space or line break
        ids = np.frombuffer(b"".join(self.whole(["".join(texts)])), "<u4")
        bounds = np.flatnonzero(self._starts[ids]).tolist()
        if not bounds or len(bounds) != len(texts):
            return self.whole(texts)
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(bounds, [*bounds[1:], len(ids)], strict=True)]


@lru_cache(maxsize=2)
def _tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


def encoder(path: str) -> Pieces:
    """Encodes texts as the library's plain call does; what it remembers goes with it."""
    tokens = _tokens(path)
    return Pieces(tokens.pieces, tokens.whole, tokens.marks)


@lru_cache(maxsize=1)
def _kept_encoder(path: str) -> Pieces:
    return encoder(path)


def token_ids(texts: list[str], encode: Pieces) -> list[bytes]:
    """Ids of each text as little-endian 32-bit integers, the end id appended."""
    end = np.array([END], "<u4").tobytes()
    return [x + end for x in encode(texts)]


def runs(batches: Iterator[pa.RecordBatch], path: str, kept: bool = False) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches of a task in runs of a few megabytes, each with its texts' ids; ``kept`` lets the worker remember pieces from task to task."""
    encode = _kept_encoder(path) if kept else encoder(path)
    for whole in batches:
        column = texts_of_batch(whole)
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < whole.num_rows:
            earlier = int(ends[at - 1]) if at else 0
            n = max(1, int(np.searchsorted(ends, earlier + RUN_BYTES, "right")) - at)
            yield whole.slice(at, n), token_ids(column.slice(at, n).to_pylist(), encode)
            at += n
