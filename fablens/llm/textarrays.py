"""Words and byte pieces of whole Arrow batches as numpy arrays.

A batch of texts is one UTF-8 buffer with row offsets. Everything here works on
that buffer at once, so a task's cost is a few passes over its bytes and its
memory is bounded by the chunk size (one longer text makes a longer chunk).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_SEED = np.random.default_rng(20240917)
# Random odd multiplier (3 mod 8, so that its powers have a long period) and its inverse modulo 2^64.
_BASE = (int(_SEED.integers(1 << 61, 1 << 62)) * 8 + 3) & (2**64 - 1)
_CODES = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODES_2 = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_CODES = np.where(SPACE, np.uint64(0), _CODES)[LOWER]
# White space, control characters and ASCII punctuation: what separates terms.
MARK = np.zeros(256, bool)
MARK[:128] = [not chr(b).isalnum() for b in range(128)]
TERM_CODES = np.where(MARK, np.uint64(0), _CODES)[LOWER]
# First and last characters of scripts written without spaces, then of punctuation beyond ASCII.
_UNSPACED = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x30FF), (0x3105, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
]
_PUNCTUATION = [
    (0x2010, 0x2027), (0x2030, 0x205E), (0x3000, 0x3003), (0x3008, 0x3011), (0x3013, 0x301F), (0x3030, 0x3030), (0x303D, 0x303D),
    (0x30A0, 0x30A0), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65),
]
# Bytes that such a character can begin with.
_LEADS = np.zeros(256, bool)
_LEADS[sorted({chr(c).encode()[0] for a, b in _UNSPACED + _PUNCTUATION for c in (*range(a, b, 64), b)})] = True
# Bits: space or line feed, visible ASCII, mark, ASCII letter.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x0A]] = 1
_KIND[0x21:0x7F] = 2
_KIND[list(b",.;:!?")] |= 4
_KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] |= 8

_powers: dict[str, np.ndarray] = {}


def _table(kind: str, n: int) -> np.ndarray:
    """Powers of the base (or of its inverse), at least ``n`` of them."""
    found = _powers.get(kind)
    if found is None or len(found) < n:
        size = max(n, CHUNK_BYTES + 1)
        base = _BASE if kind == "up" else pow(_BASE, -1, 2**64)
        found = np.full(size, base, np.uint64)
        found[0] = 1
        found = np.cumprod(found, dtype=np.uint64)
        _powers[kind] = found if n <= 16 * CHUNK_BYTES else _powers.get(kind, found[: CHUNK_BYTES + 1])
    return found[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buffer[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive row ranges of about ``size`` bytes: (first row, end row, bytes, offsets)."""
    buffer, offsets = flat(column)
    at, rows = 0, len(offsets) - 1
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, end, buffer[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(
    buffer: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs without separators (white space: space, tab to carriage return): starts, ends, each row's first."""
    full = ~separators[buffer]
    edge = np.zeros(len(buffer) + 1, bool)
    edge[offsets] = True
    begins = full.copy()
    begins[1:] &= ~full[:-1] | edge[1 : len(buffer)]
    closes = full
    closes[:-1] &= ~full[1:] | edge[1 : len(buffer)]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _within(codes: np.ndarray, ranges: list[tuple[int, int]]) -> np.ndarray:
    """Whether each code lies in one of the ranges (disjoint); a character's range may hold smaller ones of other kinds."""
    edges = np.array(sorted(ranges)).ravel() + np.tile([0, 1], len(ranges))
    return np.searchsorted(edges, codes, "right") % 2 == 1


def tokens(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of tokens and of search terms, their starts, and each row's first.

    A token is a run of letters, digits and non-ASCII bytes without punctuation, or one character of a script
    without spaces. Its search term is the token, or with such a character right behind it the pair of both.
    """
    lead = np.flatnonzero(_LEADS[buffer])
    lead = lead[lead < len(buffer) - 2]
    if not len(lead):
        starts, _, firsts = words(buffer, offsets, MARK)
        hashes = word_hashes(buffer, starts, TERM_CODES)
        return hashes, hashes, starts, firsts
    size = np.where(buffer[lead] >= 0xF0, 4, 3)
    own = lead + size <= len(buffer)
    lead, size = lead[own], size[own]
    low = [(buffer[np.minimum(lead + k, len(buffer) - 1)] & 0x3F).astype(np.int64) for k in range(4)]
    first = buffer[lead].astype(np.int64)
    three = (first & 15) << 12 | low[1] << 6 | low[2]
    codes = np.where(size == 4, (first & 7) << 18 | low[1] << 12 | low[2] << 6 | low[3], three)
    mark = _within(codes, _PUNCTUATION)
    single = _within(codes, _UNSPACED) & ~mark
    full = ~MARK[buffer]
    full[gather(lead[mark], size[mark])] = False
    edge = np.zeros(len(buffer) + 1, bool)
    edge[offsets] = True
    lead, size = lead[single], size[single]
    cut = edge.copy()
    cut[lead] = cut[lead + size] = True
    begins = full.copy()
    begins[1:] &= ~full[:-1] | cut[1 : len(buffer)]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return (none := np.zeros(0, np.uint64)), none, starts, np.searchsorted(starts, offsets)
    hashes = _sums(np.where(full, TERM_CODES[buffer], np.uint64(0)), starts)
    pair = (lead[:-1] + size[:-1] == lead[1:]) & ~edge[lead[1:]]
    at = np.searchsorted(starts, lead[:-1][pair])
    terms = hashes.copy()
    terms[at] = mix(hashes[at] * np.uint64(0xA24BAED4963EE407) + hashes[at + 1])
    return hashes, terms, starts, np.searchsorted(starts, offsets)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return mix(np.add.reduceat(values * _table("up", len(values)), starts) * _table("down", int(starts[-1]) + 1)[starts])


def word_hashes(buffer: np.ndarray, starts: np.ndarray, codes: np.ndarray = WORD_CODES) -> np.ndarray:
    """64-bit hashes of lower-cased (A-Z) words; ``codes`` are zero at separators."""
    return _sums(codes[buffer], starts) if len(starts) else np.zeros(0, np.uint64)


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the given byte ranges (disjoint, in order, not empty), A-Z lower-cased."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    values = np.append(_CODES[LOWER[buffer]] * _table("up", len(buffer)), np.uint64(0))
    sums = np.add.reduceat(values, np.stack([starts, ends], 1).ravel())[::2]
    return mix(sums * _table("down", int(starts[-1]) + 1)[starts])


def shingle_hashes(hashes: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within a row, and each row's first shingle.

    A row with fewer words has its whole sequence as one shingle; one without words has none.
    """
    counts = np.diff(firsts)
    per_row = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(per_row)])
    at = np.arange(first[-1]) + np.repeat(firsts[:-1] - first[:-1], per_row)
    size = np.repeat(np.minimum(counts, n), per_row)
    out = size.astype(np.uint64)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    for k in range(n):
        salt = np.uint64((2 * k + 3) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        out = mix(out * np.uint64(0xA24BAED4963EE407) + np.where(size > k, padded[at + k] + salt, np.uint64(0)))
    return out, first


def pieces(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts that no pre-tokenizer token spans: piece starts, and each row's first piece.

    A cut lies before a space or line feed that follows a visible ASCII character, before
    a mark of ``,.;:!?`` that follows an ASCII letter, and before every row. White space and
    what follows it stay together.
    """
    cut = np.zeros(len(buffer) + 1, bool)
    if len(buffer):
        kind = _KIND[buffer]
        cut[1:-1] = ((kind[1:] & 1) != 0) & ((kind[:-1] & 2) != 0)
        cut[1:-1] |= ((kind[1:] & 4) != 0) & ((kind[:-1] & 8) != 0)
    cut[offsets] = True
    cut[-1] = False
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, offsets)


def piece_hashes(buffer: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each piece."""
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return _sums(_CODES[buffer], starts), _sums(_CODES_2[buffer], starts)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def row_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of consecutive ranges, empty ranges included."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[firsts[1:]] - total[firsts[:-1]]
