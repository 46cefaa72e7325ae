"""Document features for linear models: the shape of the text, and selected terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.llm import textarrays as T
from fablens.sources.shared import materialize

SHAPES = ["size", "words", "mean_word", "upper", "digits", "marks", "bars", "double_marks", "line_breaks", "repeats", "distinct"]

LEAST_CHI = 15.0

_UPPER, _DIGIT, _PUNCTUATION = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_PUNCTUATION[:] = T.MARK & ~T.SPACE


def distinct_pairs(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, value) pairs, sorted."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


class Chunk:
    """Terms and shapes of a chunk's rows. Terms are lower-cased runs of letters, digits and non-ASCII bytes."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray):
        self.buffer, self.offsets, self.rows = buffer, offsets, len(offsets) - 1
        starts, _, self.firsts = T.words(buffer, offsets, T.MARK)
        self.terms = T.word_hashes(buffer, starts, T.TERM_CODES)
        self.row = np.repeat(np.arange(self.rows), np.diff(self.firsts))

    def shapes(self) -> np.ndarray:
        """One row per text, in the order of ``SHAPES``; an empty text is all zeros."""
        buffer, offsets = self.buffer, self.offsets
        size = np.diff(offsets).astype(np.float64)
        starts, ends, firsts = T.words(buffer, offsets)
        words = np.diff(firsts).astype(np.float64)
        hashes = T.word_hashes(buffer, starts)
        again = np.zeros(len(hashes), bool)
        again[1:] = hashes[1:] == hashes[:-1]
        mark = _PUNCTUATION[buffer]
        double = np.zeros(len(buffer), bool)
        double[1:] = mark[1:] & (buffer[1:] == buffer[:-1])
        own = np.repeat(np.arange(self.rows), np.diff(firsts))
        distinct = np.bincount(distinct_pairs(own, hashes)[0], minlength=self.rows)
        per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(words, 1)
        columns = [
            np.log1p(size),
            np.log1p(words),
            T.row_sums(ends - starts, firsts) * per_word,
            T.row_sums(_UPPER[buffer], offsets) * per_byte,
            T.row_sums(_DIGIT[buffer], offsets) * per_byte,
            T.row_sums(mark, offsets) * per_byte,
            T.row_sums(buffer == 0x7C, offsets) * per_word,
            T.row_sums(double, offsets) * per_word,
            T.row_sums(buffer == 0x0A, offsets) * per_word,
            T.row_sums(again, firsts) * per_word,
            distinct * per_word,
        ]
        return np.stack(columns, axis=1)

    def selected(self, selection: Selection) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (row, number of a selected term) pairs, and their weights: 1, 1.6, and 2 from three occurrences on."""
        at, number = selection.find(self.terms)
        key, counts = np.unique(self.row[at] * max(1, len(selection)) + number, return_counts=True)
        return key // max(1, len(selection)), key % max(1, len(selection)), np.minimum(np.log2(1.0 + counts), 2.0)


class Selection:
    """A sorted list of term hashes that counts as features."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.filter = np.zeros(1 << 16, bool)
        self.filter[self.hashes >> np.uint64(48)] = True

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of selected terms, and their numbers."""
        maybe = np.flatnonzero(self.filter[terms >> np.uint64(48)])
        if not len(maybe):
            return maybe, maybe
        at = np.minimum(np.searchsorted(self.hashes, terms[maybe]), len(self.hashes) - 1)
        hit = self.hashes[at] == terms[maybe]
        return maybe[hit], at[hit]


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, columns: list[str], rows: int) -> DataFrame:
    """About ``rows`` labelled documents at most, with ``doc``, ``text`` and the 0/1 label columns.

    Chosen by the hash of the id, so that the sample is the same in every run. Rows with a null id or label are left out; of
    repeated ids the highest labels and one text count.
    """
    doc = F.col(id_col)
    known = labels.filter(doc.isNotNull() & ~F.greatest(*[F.col(c).isNull() for c in columns], F.lit(False)))
    known = known.groupBy(doc.alias("doc")).agg(*[F.max(F.col(c).cast("double")).alias(c) for c in columns])
    total = known.count()
    if total > rows:
        known = known.filter(F.pmod(F.xxhash64("doc"), F.lit(1 << 30)) < int(rows / total * (1 << 30)))
    known = materialize(known, "labels")
    texts = docs.filter(F.col(text_col).isNotNull()).select(doc.alias("doc"), F.col(text_col).alias("text"))
    texts = texts.join(known, "doc").groupBy("doc").agg(F.min("text").alias("text"), *[F.first(c).alias(c) for c in columns])
    return materialize(texts, "labelled")


def select_terms(sample: DataFrame, columns: list[str], per_label: int, least_share: float) -> Selection:
    """The terms that tell most about each label, by the chi-squared statistic over the sample's documents.

    A term must occur in at least ``least_share`` of them, and in four, and its statistic must reach
    ``LEAST_CHI``: among many terms lower ones come about by chance.
    """
    total, *positive = sample.agg(F.count("*"), *[F.sum(c) for c in columns]).first()
    if not total:
        return Selection(np.zeros(0, np.uint64))
    names = [f"n{i}" for i in range(len(columns))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = [batch.column(i + 1).to_numpy() for i in range(len(columns))]
            for at, _, buffer, offsets in T.chunks(batch.column(0)):
                chunk = Chunk(buffer, offsets)
                rows, terms = distinct_pairs(chunk.row, chunk.terms)
                unique, codes, counts = np.unique(terms, return_inverse=True, return_counts=True)
                sums = [np.bincount(codes, label[at + rows], len(unique)) for label in labels]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unique.view(np.int64)), pa.array(counts.astype(np.float64)), *[pa.array(s) for s in sums]],
                    names=["term", "n", *names],
                )

    schema = "term long, n double, " + ", ".join(f"{n} double" for n in names)
    counted = sample.select("text", *columns).mapInArrow(count, schema)
    counted = counted.groupBy("term").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names])
    counted = materialize(counted.filter(F.col("n") >= max(4, least_share * total)), "term-labels")
    found: set[int] = set()
    for name, held in zip(names, positive):
        expected = F.col("n") * (held / total)
        chi = (F.col(name) - expected) ** 2 / F.greatest(expected * (1 - held / total), F.lit(1e-9))
        best = counted.select("term", chi.alias("chi")).filter(F.col("chi") >= LEAST_CHI).orderBy(F.col("chi").desc(), "term").limit(per_label)
        found |= {r["term"] for r in best.collect()}
    return Selection(np.array(sorted(found), np.int64).view(np.uint64))


def feature_table(sample: DataFrame, selection: Selection | None, columns: list[str]) -> DataFrame:
    """``doc``, the label columns and ``values``: shapes, then the weight of every selected term."""
    kind = sample.schema["doc"].dataType.simpleString()
    width = len(SHAPES) + (len(selection) if selection else 0)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, buffer, offsets in T.chunks(batch.column(1)):
                chunk = Chunk(buffer, offsets)
                values = np.zeros((end - at, width))
                values[:, : len(SHAPES)] = chunk.shapes()
                if selection:
                    rows, number, weight = chunk.selected(selection)
                    values[rows, len(SHAPES) + number] = weight
                listed = pa.ListArray.from_arrays(pa.array(np.arange(end - at + 1, dtype=np.int32) * width), pa.array(values.ravel()))
                rest = [batch.column(i + 2).slice(at, end - at) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), *rest, listed], names=["doc", *columns, "values"])

    schema = f"doc {kind}, " + "".join(f"`{c}` double, " for c in columns) + "values array<double>"
    return sample.select("doc", "text", *columns).mapInArrow(build, schema)
