"""Benchmark decontamination: every passage of the corpus queries a BM25 index of the test items.

The index holds segments of the items, each short enough to lie whole within one passage. Impacts are BM25 weights
divided by the segment's own total, so that one threshold serves all segments. Postings lie in blocks of similar segments with
the block's greatest impact. Block-max WAND runs for all passages of a chunk at once: passages and blocks whose
maxima can't reach the threshold are skipped, the segments of the rest are evaluated, and every one above it is returned.
The item's question and answer must both overlap the passage's surroundings to confirm a leak.

The index is broadcast in blocks of items of bounded size; the corpus is read once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fablens.llm import textarrays as T
from fablens.sources.shared import materialize

STRIDE = 48
PASSAGE = 2 * STRIDE
SCORE = 0.5
OVERLAP = 0.5
SHINGLE = 3
MIN_TERMS = 5
K1, B = 1.2, 0.75
POSTING_BLOCK = 4
COMMON_SHARE = 0.6
INDEX_TERMS = 1 << 20


def _segments(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item``, ``source``, ``segment``, ``terms``, ``tokens`` (both in order) and ``question`` (number of question terms).

    An item of fewer than ``MIN_TERMS`` terms is one segment with 0 as ``question``.
    ``source`` is a digest of the row's text: rows that share an id, or have none, are items of their own.
    """
    kind = items.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, _, buffer, offsets in T.chunks(batch.column(1)):
                tokens, hashes, starts, firsts = T.tokens(buffer, offsets)
                for i, (a, b) in enumerate(zip(firsts[:-1], firsts[1:])):
                    if a == b:
                        continue
                    question = (b - a + 1) // 2 if b - a >= MIN_TERMS else 0
                    text = buffer[offsets[i] : offsets[i + 1]]
                    for mark in (b"?", "\uff1f".encode(), b"\n") if question else ():
                        place = text.tobytes().find(mark)
                        before = int(np.searchsorted(starts[a:b], offsets[i] + place)) if place >= 0 else 0
                        if SHINGLE <= before <= b - a - SHINGLE:
                            question = before
                            break
                    parts = -(-(b - a) // STRIDE)
                    size = -(-(b - a) // parts)
                    own = [x[a:b].view(np.int64) for x in (hashes, tokens)]
                    item, source = (batch.column(c)[at + i].as_py() for c in (0, 2))
                    rows += [
                        (item, source, k, *(x[k * size : (k + 1) * size].tolist() for x in own), int(question)) for k in range(parts)
                    ]
            types = (batch.schema.field(0).type, pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64())
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "source", "segment", "terms", "tokens", "question"])

    texts = items.select(F.col(id_col).alias("item"), F.lower(text_col).alias("text")).distinct()
    sources = texts.withColumn("source", F.sha2("text", 256))
    return sources.mapInArrow(cut, f"item {kind}, source string, segment int, terms array<long>, tokens array<long>, question long")


class Index:
    """A block of items: postings by term in blocks of segments, their maxima, and the items' own shingles.

    A row starts with its item's key, unique to one text; ``matches`` expects (id, source) there. It may end in the
    segment's tokens, where they are not its terms. ``short`` are (key, tokens) of items that are found by their whole sequence.
    """

    def __init__(self, rows: list[tuple], frequency: dict[int, int], segments: int, mean: float, short: list[tuple] = ()):
        rows = sorted(rows, key=lambda r: len(r[2]))  # alike lengths have alike impacts
        self.items = [r[0] for r in rows]
        impact: dict[int, list] = {}
        for i, (_, _, own, *_) in enumerate(rows):
            found, counts = np.unique(np.array(own, np.int64).view(np.uint64), return_counts=True)
            df = np.array([frequency[int(t)] for t in found.view(np.int64)], np.float64)
            weight = np.log1p((segments - df + 0.5) / (df + 0.5)) * counts * (K1 + 1)
            weight /= counts + K1 * (1 - B + B * len(own) / mean)
            for t, w in zip(found.tolist(), (weight / weight.sum()).tolist()):
                impact.setdefault(t, []).append((i, w))
        self.terms = np.array(sorted(impact), np.uint64)
        lists = [impact[int(t)] for t in self.terms]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        self.segment = np.array([i for x in lists for i, _ in x], np.int64)
        self.impact = np.array([w for x in lists for _, w in x])
        self.filter = np.zeros(1 << 18, bool)
        self.filter[self.terms >> np.uint64(46)] = True
        term = np.repeat(np.arange(len(lists)), np.diff(self.first))
        self.blocks = -(-len(rows) // POSTING_BLOCK)
        key = term * self.blocks + self.segment // POSTING_BLOCK
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        self.block_key = key[begin]
        self.block_begin = np.append(begin, len(key))
        self.block_max = np.maximum.reduceat(self.impact, begin) if len(begin) else np.zeros(0)
        self.block_first = np.searchsorted(term[begin], np.arange(len(lists) + 1))
        self.highest = np.maximum.reduceat(self.impact, self.first[:-1]) if len(lists) else np.zeros(0)
        # Common terms add up to little in every segment, so that the others must bring the rest.
        self.common = np.zeros(len(lists), bool)
        held = np.zeros(len(rows))
        for t in np.argsort(-np.diff(self.first), kind="stable").tolist():
            own = slice(self.first[t], self.first[t + 1])
            if own.stop - own.start > 1 and (held[self.segment[own]] + self.impact[own] <= COMMON_SHARE * SCORE).all():
                self.common[t] = True
                held[self.segment[own]] += self.impact[own]
        padded = np.append(held, np.zeros(self.blocks * POSTING_BLOCK - len(rows)))
        self.common_max = padded.reshape(-1, POSTING_BLOCK).max(axis=1) if len(rows) else padded
        whole: dict = {}
        for item, _, own, question, *tokens in sorted(rows, key=lambda r: r[1]):
            whole.setdefault(item, (question, []))[1].append(np.array(tokens[0] if tokens else own, np.int64).view(np.uint64))
        self.sides: dict = {}
        for item, (question, parts) in whole.items():
            own = np.concatenate(parts)
            sides = [(n, np.unique(_shingles(x, n))) for x in (own[:question], own[question:]) for n in [min(SHINGLE, len(x))]]
            self.sides[item] = sides, len(own)
        sequences: dict[int, dict[int, list]] = {}
        for item, own in short:
            key = int(_shingles(np.array(own, np.int64).view(np.uint64), len(own))[0])
            sequences.setdefault(len(own), {}).setdefault(key, []).append(item)
        self.short = [(n, np.array(sorted(keys), np.uint64), [keys[k] for k in sorted(keys)]) for n, keys in sequences.items()]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term in the index, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.filter[hashes >> np.uint64(46)])
        at = np.minimum(np.searchsorted(self.terms, hashes[maybe]), max(0, len(self.terms) - 1))
        hit = self.terms[at] == hashes[maybe]
        out[maybe[hit]] = at[hit]
        return out

    def search(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Block-max WAND for all passages at once: (passage, segment, score) of every score at the threshold.

        ``passage`` and ``term`` are the distinct pairs, sorted. A passage whose lists' maxima stay below the threshold has no pivot;
        a block whose maxima stay below is skipped; only segments of the blocks left are evaluated. Common
        terms count with the most they can add, until the evaluation.
        """
        none = np.zeros(0, np.int64)
        least, rare = SCORE - 1e-9, ~self.common[term]
        own, lists = passage[rare], term[rare]
        begin = np.flatnonzero(np.diff(own, prepend=-1))
        if not len(begin):
            return none, none, none.astype(np.float64)
        most = np.add.reduceat(self.highest[lists], begin) + self.common_max.max()
        pivots = np.repeat(most >= least, np.diff(np.append(begin, len(own))))
        own, lists = own[pivots], lists[pivots]
        count = self.block_first[lists + 1] - self.block_first[lists]
        at = T.gather(self.block_first[lists], count)
        key = np.repeat(own, count) * self.blocks + self.block_key[at] % self.blocks
        order = np.argsort(key)
        key, weight = key[order], self.block_max[at][order]
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        if not len(begin):
            return none, none, none.astype(np.float64)
        bound = np.add.reduceat(weight, begin) + self.common_max[key[begin] % self.blocks]
        key = key[begin][bound >= least]
        own, block = key // self.blocks, key % self.blocks
        first = np.searchsorted(passage, own)
        count = np.searchsorted(passage, own, "right") - first
        wanted = term[T.gather(first, count)] * self.blocks + np.repeat(block, count)
        at = np.minimum(np.searchsorted(self.block_key, wanted), len(self.block_key) - 1)
        hit = self.block_key[at] == wanted
        own, at = np.repeat(own, count)[hit], at[hit]
        count = self.block_begin[at + 1] - self.block_begin[at]
        at = T.gather(self.block_begin[at], count)
        key = np.repeat(own, count) * len(self.items) + self.segment[at]
        order = np.argsort(key, kind="stable")
        key, weight = key[order], self.impact[at][order]
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        score = np.add.reduceat(weight, begin) if len(begin) else weight
        good = score >= least
        key = key[begin][good]
        return key // len(self.items), key % len(self.items), score[good]

    def overlaps(self, item, near: np.ndarray) -> tuple[float, float] | None:
        """Shares of the item's question and answer shingles near the passage, if both suffice."""
        shares = [float(np.isin(side, _shingles(near, n)).mean()) for n, side in self.sides[item][0]]
        return (shares[0], shares[1]) if min(shares) >= OVERLAP else None

    def sequences(self, tokens: np.ndarray, firsts: np.ndarray) -> dict:
        """(row, item) of the short items whose tokens occur one after the other."""
        out: dict = {}
        for n, keys, items in self.short:
            found, first = T.shingle_hashes(tokens, firsts, n)
            at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            hits = np.flatnonzero(keys[at] == found)
            row = np.searchsorted(first, hits, "right") - 1
            for pair in np.unique(row * len(keys) + at[hits]).tolist():
                for item in items[pair % len(keys)]:
                    out[pair // len(keys), item] = (1.0, 1.0, 1.0)
        return out

    def matches(self, buffer: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """Confirmed leaks of a chunk: (row, item, score, question share, answer share)."""
        tokens, hashes, _, firsts = T.tokens(buffer, offsets)
        out = self.sequences(tokens, firsts)
        if not len(hashes) or not len(self.terms):
            return [(row, item[0], 1.0, 1.0, 1.0) for row, item in out]
        number = self.find(hashes)
        hits = np.flatnonzero(number >= 0)
        row = np.searchsorted(firsts, hits, "right") - 1
        size = np.diff(firsts)
        passages = np.where(size > 0, np.maximum(1, -(-size // STRIDE) - 1), 0)
        base = np.concatenate([[0], np.cumsum(passages)])
        place = (hits - firsts[row]) // STRIDE
        both = [(base[row] + place - back, hits, place - back >= 0, place - back < passages[row]) for back in (0, 1)]
        passage = np.concatenate([p[a & b] for p, _, a, b in both])
        where = np.concatenate([h[a & b] for _, h, a, b in both])
        pairs = np.sort(passage * len(self.terms) + number[where])
        pairs = pairs[np.flatnonzero(np.diff(pairs, prepend=-1))]
        for found, segment, score in zip(*(x.tolist() for x in self.search(pairs // len(self.terms), pairs % len(self.terms)))):
            own = int(np.searchsorted(base, found, "right")) - 1
            start, item = int(firsts[own] + (found - base[own]) * STRIDE), self.items[segment]
            if out.get((own, item), (0.0,))[0] >= score:
                continue
            wide = self.sides[item][1]
            near = tokens[max(firsts[own], start - wide) : min(firsts[own + 1], start + PASSAGE + wide)]
            shares = self.overlaps(item, near)
            if shares:
                out[own, item] = (score, *shares)
        return [(row, item[0], *v) for (row, item), v in out.items()]


def _shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    return T.shingle_hashes(hashes, np.array([0, len(hashes)]), n)[0]


def indexes(items: DataFrame, id_col: str, text_col: str, block_terms: int = INDEX_TERMS) -> Iterator[Index]:
    """The index in blocks of whole rows of about ``block_terms`` terms; statistics are those of all items."""
    segments = materialize(_segments(items, id_col, text_col), "segments")
    long = F.col("question") > 0
    size = lambda rows: F.coalesce(F.sum(F.when(rows, F.size("terms"))), F.lit(0))
    count, total, whole = segments.agg(F.count(F.when(long, 1)), size(long), size(F.lit(True))).first()
    if not whole:
        return
    blocks = -(-whole // block_terms)
    block = F.pmod(F.xxhash64("item", "source"), F.lit(blocks))
    frequency = segments.filter(long).select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    frequency = materialize(frequency, "term-frequency")
    for i in range(blocks):
        own = segments.filter(block == i)
        used = own.select(F.explode("terms").alias("term")).distinct()
        df = {r["term"]: r["df"] for r in frequency.join(used, "term", "left_semi").collect()}
        found = [((r["item"], r["source"]), r["segment"], r["terms"], r["question"], r["tokens"]) for r in own.collect()]
        rows, short = [r for r in found if r[3]], [(r[0], r[4]) for r in found if not r[3]]
        if found:
            yield Index(rows, df, count, total / max(1, count), short)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``id``, ``item``, ``score``, ``question_overlap`` and ``answer_overlap`` of every confirmed leak.

    Texts are lower-cased. A passage is ``PASSAGE`` terms, every ``STRIDE`` terms. An item is retrieved if a segment of it scores at least ``SCORE`` of its own
    total, and confirmed if at least ``OVERLAP`` of the term trigrams of its question and of its answer (split at a question mark or a line feed,
    else in halves) occur near the passage. Items of fewer than ``MIN_TERMS`` terms are confirmed by their whole
    sequence of terms, with 1 for all three figures: an item of one word matches every text that holds the word. A character of a
    script without spaces is a term of its own, retrieved in pairs. Null and empty texts match nothing; a null id stays null. Benchmark rows that share an id, or have none,
    are searched one by one and reported under it; of rows that repeat an id the best match of an item counts. Empty tables give no rows; other columns are not read.
    A very long text is worked whole, as one chunk, in about 30 times its size of memory.
    """
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc {kinds[0]}, item {kinds[1]}, score double, question_overlap double, answer_overlap double"
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    found = spark.createDataFrame([], schema)
    for index in indexes(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, _, buffer, offsets in T.chunks(batch.column(1)):
                    rows = shared.value.matches(buffer, offsets)
                    if rows:
                        doc = batch.column(0).take(pa.array([at + r[0] for r in rows], pa.int64()))
                        item = pa.array([r[1] for r in rows], item_type)
                        rest = [pa.array([r[k] for r in rows]) for k in range(2, 5)]
                        yield pa.RecordBatch.from_arrays([doc, item, *rest], names=["doc", "item", "score", "question_overlap", "answer_overlap"])

        found = found.unionByName(docs.select(id_col, F.lower(text_col)).mapInArrow(search, schema))
    best = found.groupBy("doc", "item").agg(F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "best.*")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no confirmed leak; rows with a null id stay.

    Of rows that repeat an id all go if one of them leaks; an empty benchmark removes nothing, an empty table stays empty.
    """
    leaks = materialize(find_leaks(docs, benchmark, id_col, text_col).select(F.col(id_col).alias("leaking")).distinct(), "leaks")
    return docs.join(leaks, docs[id_col] == leaks["leaking"], "left_anti")
