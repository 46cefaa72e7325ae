"""Line deduplication with a filter of lines seen once and a filter of lines seen twice.

1. Every task marks the hashes of its documents' lines in two sparse Bloom filters: seen in
   one document, seen in two. Only marked positions travel, by slices of the filter.
2. A slice's positions are merged: what is marked once by two tasks is marked twice. The
   merged twice-seen filter is folded to at most ``FILTER_BYTES`` and goes to all tasks. Folding,
   like any collision, only makes more lines suspected; it never misses a repeated one.
3. Lines that pass the twice-seen filter are suspected: only their 32-byte digests shuffle, and
   are counted exactly per line.
4. Confirmed lines meet their documents again, which lose them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.llm import textarrays as T
from fablens.sources.shared import materialize

MIN_CHARS = 20
MIN_DOCS = 3
BITS_PER_LINE = 16
PROBES = 3
FILTER_BYTES = 32 << 20
SLICE_BITS = (1 << 20, 1 << 26)
SLICES = 64


class Layout:
    """Size of the filters for a number of lines: slices of a power of two bits, and their folding."""

    def __init__(self, lines: int, filter_bytes: int = FILTER_BYTES):
        bits = max(1, lines) * BITS_PER_LINE
        self.slice_bits = min(max(1 << (bits // SLICES).bit_length(), SLICE_BITS[0]), SLICE_BITS[1])
        self.slices = -(-bits // self.slice_bits)
        self.folded_bits = self.slice_bits
        while self.slices * self.folded_bits > 8 * filter_bytes and self.folded_bits > 64:
            self.folded_bits //= 2

    def slice_of(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(40)) % np.uint64(self.slices)).astype(np.int64)

    def positions(self, hashes: np.ndarray, bits: int) -> np.ndarray:
        """``PROBES`` positions of each hash within its slice."""
        second = T.mix(hashes) | np.uint64(1)
        steps = np.arange(PROBES, dtype=np.uint64)
        return ((hashes[:, None] + steps * second[:, None]) & np.uint64(bits - 1)).astype(np.uint32)


def line_keys(buffer: np.ndarray, offsets: np.ndarray, min_chars: int):
    """Keys of long enough lines: row, start, end, hash of each, in order.

    A key is the line without white space at both ends, A-Z lower-cased.
    """
    edge = np.zeros(len(buffer) + 1, bool)
    edge[offsets] = True
    edge[1:] |= buffer == 0x0A
    edge[-1] = True
    bounds = np.flatnonzero(edge)
    if len(bounds) < 2:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, np.zeros(0, np.uint64)
    starts, ends, firsts = T.words(buffer, bounds)
    full = np.flatnonzero(np.diff(firsts) > 0)
    begin, end = starts[firsts[full]], ends[firsts[full + 1] - 1]
    chars = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])
    long = chars[end] - chars[begin] >= min_chars
    full, begin, end = full[long], begin[long], end[long]
    rows = np.searchsorted(offsets, begin, "right") - 1
    return rows, begin, end, T.span_hashes(buffer, begin, end)


def _distinct(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position of each (row, hash) and the hashes there."""
    order = np.lexsort((hashes, rows))
    new = np.ones(len(order), bool)
    new[1:] = (rows[order][1:] != rows[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    first = order[new]
    return first, hashes[first]


def seen_twice_filter(docs: DataFrame, text_col: str, layout: Layout, min_chars: int) -> np.ndarray:
    """The merged and folded filter of lines that at least two rows hold, as one bit array per slice."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.uint64)]
        for batch in batches:
            for _, _, buffer, offsets in T.chunks(batch.column(0)):
                rows, _, _, hashes = line_keys(buffer, offsets, min_chars)
                held.append(_distinct(rows, hashes)[1])
        hashes, counts = np.unique(np.concatenate(held), return_counts=True)
        owner = layout.slice_of(hashes)
        order = np.argsort(owner, kind="stable")
        hashes, counts, owner = hashes[order], counts[order], owner[order]
        cuts = np.flatnonzero(np.diff(owner, prepend=-1)) if len(owner) else np.zeros(0, np.int64)
        for a, b in zip(cuts, [*cuts[1:], len(owner)]):
            once = np.unique(layout.positions(hashes[a:b], layout.slice_bits))
            twice = np.unique(layout.positions(hashes[a:b][counts[a:b] > 1], layout.slice_bits))
            yield pa.RecordBatch.from_pydict(
                {"slice": pa.array([int(owner[a])], pa.int32()), "once": [once.tobytes()], "twice": [twice.tobytes()]}
            )

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(layout.slice_bits, bool), np.zeros(layout.slice_bits, bool)
        for one, two in zip(parts["once"], parts["twice"]):
            new = np.frombuffer(one, np.uint32)
            twice[new[once[new]]] = True
            twice[np.frombuffer(two, np.uint32)] = True
            once[new] = True
        folded = twice.reshape(-1, layout.folded_bits).any(axis=0)
        return pd.DataFrame({"slice": [key[0]], "bits": [np.packbits(folded).tobytes()]})

    marked = docs.select(text_col).mapInArrow(mark, "slice int, once binary, twice binary")
    merged = marked.groupBy("slice").applyInPandas(merge, "slice int, bits binary")
    # Bounded by FILTER_BYTES, whatever the corpus.
    found = np.zeros((layout.slices, layout.folded_bits // 8), np.uint8)
    for row in merged.collect():
        found[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return found


def confirmed_drops(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """``id`` and the digests of lines that the document loses."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    lines = docs.select((breaks + 1).alias("n")).agg(F.sum("n")).first()[0] or 0
    layout = Layout(lines)
    shared = spark.sparkContext.broadcast(seen_twice_filter(docs, text_col, layout, min_chars))
    kind = docs.schema[id_col].dataType.simpleString()

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = shared.value
        for batch in batches:
            ids = batch.column(0)
            for at, _, buffer, offsets in T.chunks(batch.column(1)):
                rows, begin, end, hashes = line_keys(buffer, offsets, min_chars)
                first, _ = _distinct(rows, hashes)
                owner = layout.slice_of(hashes[first])
                hit = np.ones(len(first), bool)
                for place in layout.positions(hashes[first], layout.folded_bits).T:
                    hit &= (filled[owner, place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0
                first = first[hit]
                data = T.LOWER[buffer].tobytes()
                digests = [hashlib.sha256(data[a:b]).digest() for a, b in zip(begin[first], end[first])]
                taken = ids.take(pa.array(at + rows[first]))
                yield pa.RecordBatch.from_arrays([taken, pa.array(digests, pa.binary())], names=["doc", "line"])

    suspects = materialize(
        docs.filter(F.col(id_col).isNotNull())
        .select(id_col, text_col)
        .mapInArrow(suspect, f"doc {kind}, line binary")
        .distinct(),
        "suspected-lines",
    )
    repeated = materialize(
        suspects.groupBy("line")
        .agg(F.count("*").alias("held"), F.max("doc").alias("keeper"))
        .filter(F.col("held") >= min_docs)
        .select("line", "keeper"),
        "repeated-lines",
    )
    lost = suspects.join(repeated, "line").filter(F.col("doc") != F.col("keeper"))
    return materialize(lost.groupBy("doc").agg(F.collect_list("line").alias("lines")), "line-drops")


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    counts: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """All rows and columns, with repeated lines taken out of the text, and ``n_lines`` and ``n_dropped``.

    A line repeats if at least ``min_docs`` documents (distinct ids) hold its key of at least
    ``min_chars`` code points; it stays in the largest id only. ``n_lines`` counts the lines before dropping.
    A null text has one empty line and stays null. Rows with a null id are not counted and lose
    nothing. Rows that repeat an id count as one document and lose the same lines. ``counts`` names the
    two added columns; a column of the same name is replaced. An empty table gives no rows.
    A very long text is worked whole, as one chunk, in about 30 times its size of memory.
    """
    drops = confirmed_drops(docs, id_col, text_col, min_chars, min_docs)
    kept = [c for c in docs.columns if c not in counts]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    at = kept.index(text_col)
    # Renamed while joined, so that no column of the table can clash.
    numbered = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    drops = drops.select(F.col("doc").alias("drop_doc"), F.col("lines").alias("drop_lines"))
    joined = numbered.join(drops, F.col(f"c{kept.index(id_col)}") == F.col("drop_doc"), "left").drop("drop_doc")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, lines = batch.column(at), batch.column(len(kept))
            buffer, offsets = T.flat(column)
            parts = [T.row_sums(data == 0x0A, ends) for _, _, data, ends in T.chunks(column)]
            n_lines = np.concatenate([np.zeros(0, np.int64), *parts]) + 1
            dropped = np.zeros(batch.num_rows, np.int64)
            touched = pc.is_valid(lines).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(touched)
            texts = []
            for row in rows.tolist():
                gone, own = set(lines[row].as_py()), buffer[offsets[row] : offsets[row + 1]]
                parts = own.tobytes().split(b"\n")
                bounds = np.cumsum([0, *[len(p) + 1 for p in parts]])
                _, begin, end, _ = line_keys(own, np.array([0, len(own)]), min_chars)
                data = T.LOWER[own].tobytes()
                out = {
                    int(np.searchsorted(bounds, a, "right")) - 1
                    for a, b in zip(begin.tolist(), end.tolist())
                    if hashlib.sha256(data[a:b]).digest() in gone
                }
                dropped[row] = len(out)
                texts.append(b"\n".join(p for i, p in enumerate(parts) if i not in out).decode())
            if len(rows):
                column = pc.replace_with_mask(column, pa.array(touched), pa.array(texts, column.type))
            columns = [column if i == at else batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines.astype(np.int64)), pa.array(dropped)],
                names=[*kept, *counts],
            )

    return joined.mapInArrow(rewrite, f"{fields}, `{counts[0]}` long, `{counts[1]}` long")
