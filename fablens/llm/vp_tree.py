"""Approximate nearest neighbours by inner product: one vantage-point tree per shard.

Inner products obey no triangle inequality, so vectors are lifted: with M the shard's greatest length, x becomes
(x, sqrt(M^2 - |x|^2)) and a query (q, 0). Then |q - x|^2 = |q|^2 + M^2 - 2 q.x, and the largest product is
the smallest distance. A node holds a vantage point and, for its inner and its outer half, the range
of distances to it. A query at distance d from the vantage point is at least ``gap`` = distance from d to that range
away from everything in a half; the half is skipped when ``factor * gap`` exceeds the query's k-th smallest distance so far.
With factor 1 nothing is lost; a larger factor f skips only halves whose vectors are all farther than 1/f of that distance.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.llm import meeting

K = 20
FACTOR = 1.25
LEAF = 64
#: Square roots of rounding errors, as a share of the lengths.
SLACK = 1e-7


class VantageTree:
    """A tree over the rows of one shard; rows are kept in leaf order."""

    def __init__(self, rows: dict, factor: float = FACTOR, leaf: int = LEAF):
        self.factor = factor
        vectors = rows["vector"].astype(np.float64)
        squares = (vectors**2).sum(1)
        self.square = squares.max(initial=0)
        self.lift = np.sqrt(np.maximum(0, self.square - squares))
        order = np.arange(len(vectors))
        # A node: begin, end, vantage row, ranges of the inner and outer half, its children (0: a leaf).
        self.nodes: list[tuple] = []
        work = [(0, len(vectors), None)]
        children: dict[int, list[int]] = {}
        while work:
            begin, end, parent = work.pop()
            here = len(self.nodes)
            if parent is not None:
                children.setdefault(parent, []).append(here)
            mine = order[begin:end]
            if end - begin <= leaf:
                self.nodes.append((begin, end, -1, None))
                continue
            vantage = mine[np.argmax(self._between(vectors, mine[0], mine))]
            far = self._between(vectors, vantage, mine)
            half = (end - begin) // 2
            split = np.argpartition(far, half)
            order[begin:end], far = mine[split], far[split]
            ranges = (far[:half].min(), far[:half].max(), far[half:].min(), far[half:].max())
            self.nodes.append((begin, end, int(vantage), ranges))
            work += [(begin + half, end, here), (begin, begin + half, here)]
        self.children = children
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.rows = meeting.take(rows, order)
        self.vectors = vectors[order]
        self.nodes = [(b, e, int(place[v]) if v >= 0 else -1, r) for b, e, v, r in self.nodes]
        self.compared = 0

    def _between(self, vectors: np.ndarray, one: int, many: np.ndarray) -> np.ndarray:
        near = vectors[many] @ vectors[one] + self.lift[many] * self.lift[one]
        return np.sqrt(np.maximum(0, 2 * (self.square - near)))

    def _leaf(self, best: meeting.Best, node: int, active: np.ndarray) -> None:
        begin, end = self.nodes[node][:2]
        self.compared += len(active) * (end - begin)
        best.offer(active, meeting.take(self.rows, slice(begin, end)), np.sqrt(self.square))

    def search(self, best: meeting.Best) -> None:
        """Each query first goes down to its own leaf, then visits all halves that its distance so far leaves."""
        queries = best.queries["vector"].astype(np.float64)
        reach = (queries**2).sum(1) + self.square
        slack = SLACK * np.sqrt(reach)
        own = np.zeros(len(queries), np.int64)
        work = [(0, np.arange(len(queries)))]
        while work:
            node, active = work.pop()
            if not len(active):
                continue
            _, _, vantage, ranges = self.nodes[node]
            if ranges is None:
                own[active] = node
                self._leaf(best, node, active)
                continue
            far = self._far(queries[active], reach[active], vantage)
            inside = far * 2 <= ranges[1] + ranges[2]
            inner, outer = self._halves(node)
            work += [(outer, active[~inside]), (inner, active[inside])]
        best.settle()
        work = [(0, np.arange(len(queries)))]
        while work:
            node, active = work.pop()
            if not len(active):
                continue
            _, _, vantage, ranges = self.nodes[node]
            if ranges is None:
                self._leaf(best, node, active[own[active] != node])
                continue
            far = self._far(queries[active], reach[active], vantage)
            nearest = np.sqrt(np.maximum(0, reach[active] - 2 * best.floor[active]))
            for child, low, high in zip(self._halves(node), ranges[::2], ranges[1::2]):
                gap = np.maximum(far - high, low - far) - slack[active]
                work.append((child, active[self.factor * gap <= nearest + slack[active]]))

    def _far(self, queries: np.ndarray, reach: np.ndarray, vantage: int) -> np.ndarray:
        return np.sqrt(np.maximum(0, reach - 2 * (queries @ self.vectors[vantage])))

    def _halves(self, node: int) -> tuple[int, int]:
        first, second = self.children[node]
        return (first, second) if self.nodes[first][0] == self.nodes[node][0] else (second, first)


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = K,
    factor: float = FACTOR,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = meeting.SHARD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: each query's ``k`` nearest rows found, by inner product.

    ``is_query`` is a condition on the rows of ``vectors``. Rows with a null id, or a vector that is null, empty, all zero or holds a null
    or non-finite component take no part. Every row is a candidate by itself, so rows that repeat an id or a vector all count;
    a query never meets its own row, nor vectors of another dimension. Ties go to smaller ids; with fewer than ``k`` candidates
    all are returned. Empty tables give no rows, other columns are not read, and scores are summed in the order of the components.
    ``factor`` 1 is exact.
    """
    x = F.col(f"`{vector_col}`")
    some = F.exists(x, lambda v: v != 0)
    asks = F.coalesce(is_query.cast("boolean"), F.lit(False))
    rows = vectors.filter(F.col(f"`{id_col}`").isNotNull() & meeting.usable(x) & some)
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.lit(0).cast("long").alias("label"), x.cast("array<double>").alias("vector"), asks.alias("asks"))
    held = meeting.number_rows(rows)
    queries = held.filter("asks").select(
        "key", F.col("key").alias("row"), "label", F.lit(meeting.ANY).alias("mode"), F.lit(float("-inf")).alias("floor"), F.lit(float("inf")).alias("ceiling"), "vector"
    )
    found = meeting.search(held, queries, k, meeting.shard_count(held, shard_rows), lambda rows: VantageTree(rows, factor))
    return found.join(held.filter("asks").select(F.col("key").alias("query"), F.col("id").alias("query_id")), "query").select("query_id", "rank", "vec_id", "score")
