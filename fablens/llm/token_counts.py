"""Token counts of whole texts, computed by the tokenizer library inside Arrow functions.

Each text is cut at safe boundaries: before a space or line feed that follows a visible
ASCII character, and before a mark that follows an ASCII letter. No token of a byte-level
pre-tokenizer spans such a cut, so the counts of the parts add up, and a very long text
reaches the library in parts; only a stretch without a boundary (a script without spaces, base64) goes in one call. Within a task
equal parts are encoded once; the calls get batches of about equal bytes. Only lengths leave
the function.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fablens.llm import textarrays as T

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
BATCH_BYTES = 1 << 16
KNOWN_PIECES = 1 << 20


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load_tokenizer(name: str):
    """The library's tokenizer of a public file, without padding or truncation."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path(name))
    found.no_padding()
    found.no_truncation()
    return found


def _cut_inside_special(tokenizer) -> bool:
    """Whether a cut could lie inside a special string (in none of the public files)."""
    specials = [np.frombuffer(t.content.encode(), np.uint8) for t in tokenizer.get_added_tokens_decoder().values()]
    return any(len(T.pieces(s, np.array([0, len(s)]))[0]) > 1 for s in specials)


class PieceCounts:
    """Token counts by piece, kept for a task; forgotten when there are too many pieces."""

    def __init__(self, name: str, batch_bytes: int = BATCH_BYTES):
        self.tokenizer = load_tokenizer(name)
        if _cut_inside_special(self.tokenizer):
            raise ValueError("a special string contains a safe boundary; texts can't be split")
        self.batch_bytes = batch_bytes
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)

    def encode(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Counts of the given pieces, in library calls of about ``batch_bytes`` bytes."""
        sizes, data = np.cumsum(ends - starts), buffer.tobytes()
        out, at = [], 0
        while at < len(starts):
            done = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + self.batch_bytes, "right")))
            texts = [data[a:b].decode() for a, b in zip(starts[at:end].tolist(), ends[at:end].tolist())]
            out += [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            at = end
        return np.array(out, np.int64)

    def of(self, buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Token counts of a chunk's rows."""
        starts, firsts = T.pieces(buffer, offsets)
        if not len(starts):
            return np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], len(buffer))
        keys, checks = T.piece_hashes(buffer, starts)
        unique, first, codes = np.unique(keys, return_index=True, return_inverse=True)
        if not np.array_equal(checks[first][codes], checks):  # two pieces share a hash: count each by itself
            return T.row_sums(self.encode(buffer, starts, ends), firsts)
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.keys)
        known[inside] = (self.keys[at[inside]] == unique[inside]) & (self.checks[at[inside]] == checks[first[inside]])
        counts = np.zeros(len(unique), np.int64)
        counts[known] = self.counts[at[known]]
        new = first[~known]
        counts[~known] = self.encode(buffer, starts[new], ends[new])
        if len(self.keys) > KNOWN_PIECES:
            self.clear()
            at = np.zeros(len(unique), np.int64)
        fresh = ~known
        self.keys = np.insert(self.keys, at[fresh], unique[fresh])
        self.checks = np.insert(self.checks, at[fresh], checks[first[fresh]])
        self.counts = np.insert(self.counts, at[fresh], counts[fresh])
        return T.row_sums(counts[codes], firsts)


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    limit: int = LIMIT,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > limit) of every row.

    A null text counts as empty (0 bytes, 0 tokens). Repeated rows and null ids stay as they
    are; an empty table gives no rows; other columns are not read.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceCounts(tokenizer, batch_bytes)
        for batch in batches:
            sizes, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, buffer, offsets in T.chunks(batch.column(1)):
                sizes.append(np.diff(offsets))
                tokens.append(pieces.of(buffer, offsets))
            n = np.concatenate(tokens)
            columns = [batch.column(0), pa.array(np.concatenate(sizes)), pa.array(n), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(count, schema)
