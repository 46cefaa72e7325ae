"""Bring every block of queries to every shard of vectors.

Vectors are dealt to shards by the hash of a row number, so shards are of equal size whatever the data.
Queries travel in packs; each pack goes to every shard through one shuffle, and a task reads its
shard first and streams the packs through it. Neither the driver nor the plan grows with the tables.
Every query starts from the scores it has against a bounded sample of vectors, so most shards return little.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fablens.llm import textarrays as T
from fablens.sources.shared import materialize

SHARD_ROWS = 1 << 16
LEAST_ROWS = 1 << 11
PACK_ROWS = 64
BLOCK_ROWS = 2048
SEEDS = 2048
ANY, SAME, OTHER = 0, 1, 2

PACKS = "shard int, block int, pack binary"


def usable(vector: Column) -> Column:
    """Whether a vector is neither null nor empty and all its components are finite numbers."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def number_rows(rows: DataFrame) -> DataFrame:
    """The rows with a row number ``key``, written once so that it stays the same."""
    return materialize(rows.select(F.monotonically_increasing_id().alias("key"), "*"), "vectors")


def shard_count(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> int:
    """Shards of ``shard_rows`` vectors; smaller ones as long as the cluster has idle cores."""
    n = vectors.count()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-n // shard_rows), min(2 * cores, n // LEAST_ROWS))


def matrix(column: pa.Array, dims: np.ndarray, dim: int) -> np.ndarray:
    """The vectors of one dimension."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    begin = np.cumsum(dims) - dims
    chosen = dims == dim
    return values[T.gather(begin[chosen], dims[chosen])].reshape(int(chosen.sum()), dim)


def _arrays(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch by dimension."""
    dims = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    for dim in np.unique(dims).tolist():
        at = dims == dim
        found = {n: batch.column(n).to_numpy(zero_copy_only=False)[at] for n in batch.schema.names if n != "vector"}
        yield {**found, "vector": matrix(batch.column("vector"), dims, dim)}


def take(rows: dict, at) -> dict:
    return {n: v[at] for n, v in rows.items()}


def join(parts: list[dict]) -> dict:
    return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}


def _packs(found: list[tuple[int, int, dict]]) -> pa.RecordBatch:
    columns = [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32())]
    return pa.RecordBatch.from_arrays([*columns, pa.array([pickle.dumps(f[2]) for f in found], pa.binary())], names=["shard", "block", "pack"])


def seeds(vectors: DataFrame, n: int = SEEDS) -> list[dict]:
    """At most ``n`` vectors, chosen by the hash of their row number, as arrays by dimension."""
    sample = vectors.orderBy(F.xxhash64("key"), "key").limit(n).select("key", "id", "label", "vector").toArrow()
    return [r for batch in sample.combine_chunks().to_batches() for r in _arrays(batch)]


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products; of integers, exact ones (they must fit a long)."""
    if left.dtype.kind == "f":
        return left @ right.T
    bound = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if bound < 2**53:  # every partial sum is an exact float
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in the order of the components."""
    out = np.zeros(len(left), left.dtype)
    for d in range(left.shape[1]):
        out += left[:, d] * right[:, d]
    return out


def admitted(queries: dict, rows: dict, scores: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Which rows count for which queries: other rows than the query's own, with a fitting label and score."""
    fits = (scores >= floor[:, None]) & (scores <= queries["ceiling"][:, None]) & (queries["row"][:, None] != rows["key"][None, :])
    same = queries["label"][:, None] == rows["label"][None, :]
    mode = queries["mode"][:, None]
    return fits & ((mode == ANY) | (same == (mode == SAME)))


class Best:
    """The ``k`` best rows of each query so far: higher scores first, ties to smaller ids, then to smaller row numbers."""

    def __init__(self, queries: dict, k: int):
        self.queries, self.k = queries, k
        n = len(queries["key"])
        whole = queries["vector"].dtype.kind != "f"
        # Sums in another order differ by less than this; integer sums do not differ.
        self.slack = np.zeros(n) if whole else np.sqrt((queries["vector"] ** 2).sum(1)) * 1e-13 * queries["vector"].shape[1]
        self.floor = queries["floor"].astype(np.float64)
        self.pending: list[tuple] = []
        self.waiting = 0
        self.found = None

    def offer(self, active: np.ndarray, rows: dict, length: float) -> None:
        """Compare the active queries with the rows; ``length`` bounds the rows' lengths."""
        q = take(self.queries, active)
        scores = products(q["vector"], rows["vector"])
        a, b = np.nonzero(admitted(q, rows, scores, self.floor[active] - self.slack[active] * length))
        if len(a):
            exact = scores[a, b] if scores.dtype.kind != "f" else paired(q["vector"][a], rows["vector"][b])
            self.pending.append((active[a], exact, rows["id"][b], rows["key"][b]))
            self.waiting += len(a)
            if self.waiting > max(1 << 14, 4 * len(self.floor) * self.k):
                self.settle()

    def offer_pairs(self, query: np.ndarray, at: np.ndarray, rows: dict) -> None:
        """Compare single pairs of a query and one of the rows."""
        ceiling, own = self.queries["ceiling"], self.queries["row"]
        for a in range(0, len(query), 1 << 16):
            q, r = query[a : a + (1 << 16)], at[a : a + (1 << 16)]
            exact = paired(self.queries["vector"][q], rows["vector"][r])
            good = (exact >= self.floor[q]) & (exact <= ceiling[q]) & (own[q] != rows["key"][r])
            if self.queries["mode"].any():
                same = self.queries["label"][q] == rows["label"][r]
                good &= (self.queries["mode"][q] == ANY) | (same == (self.queries["mode"][q] == SAME))
            self.pending.append((q[good], exact[good], rows["id"][r[good]], rows["key"][r[good]]))
            self.waiting += int(good.sum())
        if self.waiting > max(1 << 14, 4 * len(self.floor) * self.k):
            self.settle()

    def settle(self) -> tuple:
        """Cut to the best; raises the floors."""
        kept = ([self.found] if self.found is not None else []) + self.pending
        if not kept:
            return (np.zeros(0, np.int64),) * 4
        query, score, ids, keys = (np.concatenate(c) for c in zip(*kept))
        order = np.lexsort((keys, ids, -score, query))
        query, score, ids, keys = (c[order] for c in (query, score, ids, keys))
        begin = np.flatnonzero(np.diff(query, prepend=-1))
        rank = np.arange(len(query)) - np.repeat(begin, np.diff(np.append(begin, len(query))))
        last = query[rank == self.k - 1]
        self.floor[last] = np.maximum(self.floor[last], score[rank == self.k - 1])
        kept = rank < self.k
        self.found, self.pending, self.waiting = (query[kept], score[kept], ids[kept], keys[kept]), [], 0
        return self.found


def starting_floors(queries: dict, sample: list[dict], k: int) -> np.ndarray:
    """Scores that each query's k-th best surely reaches: its k-th best in the sample, or its own floor."""
    floor = queries["floor"].astype(np.float64)
    for rows in sample:
        if rows["vector"].shape[1] == queries["vector"].shape[1] and len(rows["key"]) >= k:
            scores = products(queries["vector"], rows["vector"]).astype(np.float64)
            scores[~admitted(queries, rows, scores, floor)] = -np.inf
            kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
            # A float below the true score, so that rounding never loses a tie.
            floor = np.maximum(floor, kth - np.abs(kth) * 1e-12 - 1e-300)
    return floor


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    shards: int,
    tree: Callable[[dict], object],
) -> DataFrame:
    """``query``, ``score``, ``vec_id`` and ``vec_key``: the ``k`` best rows of each query.

    ``vectors`` has ``key`` (unique), ``id``, ``label`` and ``vector`` (doubles or longs); ``queries`` has ``key`` (unique), ``row`` (the
    query's own row), ``label``, ``vector``, ``mode`` (any, same or another label), ``floor`` and ``ceiling`` (scores that count, both
    included). Vectors of another dimension are never met. ``tree(rows)`` indexes a shard's rows of one dimension; its
    ``search(best)`` offers to ``best`` all rows that may count.
    """
    sample = vectors.sparkSession.sparkContext.broadcast(seeds(vectors))
    whole = dict(vectors.dtypes)["vector"] == "array<bigint>"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for rows in _arrays(batch):
                shard = T.mix(rows["key"].astype(np.uint64)) % np.uint64(shards)
                found += [(int(s), -1, take(rows, shard == s)) for s in np.unique(shard)]
            if found:
                yield _packs(found)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for rows in _arrays(batch):
                rows["floor"] = starting_floors(rows, sample.value, k)
                found += [(0, 0, take(rows, slice(a, a + PACK_ROWS))) for a in range(0, len(rows["key"]), PACK_ROWS)]
            if found:
                yield _packs(found)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, trees, waiting = [], None, {}, {}

        def answer(parts: list[dict]) -> pa.RecordBatch:
            rows = join(parts)
            best = Best(rows, k)
            trees[rows["vector"].shape[1]].search(best)
            query, score, ids, keys = best.settle()
            score = score.astype(np.int64 if whole else np.float64)
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (rows["key"][query], score, ids, keys)], names=["query", "score", "vec_id", "vec_key"]
            )

        def rest() -> Iterator[pa.RecordBatch]:
            for parts in waiting.values():
                yield answer(parts)
            waiting.clear()

        for batch in batches:
            for shard, block, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                part = pickle.loads(data)
                if shard != now:
                    yield from rest()
                    held, trees, now = [], {}, shard
                if block < 0:
                    held.append(part)
                    continue
                if held:
                    dims = {p["vector"].shape[1] for p in held}
                    trees = {d: tree(join([p for p in held if p["vector"].shape[1] == d])) for d in dims}
                    held = []
                dim = part["vector"].shape[1]
                if dim in trees:
                    waiting.setdefault(dim, []).append(part)
                    if sum(len(p["key"]) for p in waiting[dim]) >= BLOCK_ROWS:
                        yield answer(waiting.pop(dim))
        yield from rest()

    dealt = vectors.select("key", "id", "label", "vector").mapInArrow(deal, PACKS)
    packed = queries.select("key", "row", "label", "mode", "floor", "ceiling", "vector").mapInArrow(pack, PACKS)
    everywhere = packed.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "block", "pack")
    together = dealt.unionByName(everywhere).repartition(shards, "shard").sortWithinPartitions("shard", "block")
    found = together.mapInArrow(meet, f"query long, score {'long' if whole else 'double'}, vec_id long, vec_key long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "vec_key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
