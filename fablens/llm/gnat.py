"""Hard negatives: rows of another label whose score lies in a window below a positive's score.

Each shard has a multiway hyperplane tree. A node picks split points far from each other, gives every row to the nearest one,
and stores for each split point the range of its distances to every sibling subtree. Scores are inner products; with
vectors lifted to one length M, |a - x|^2 = |a|^2 + M^2 - 2 a.x, so a window of scores is an annulus of distances around
the anchor. From an anchor at distance d of a split point, rows of the annulus [r, s] lie at distances [max(d - s, r - d), d + s] of
it; a sibling whose range does not meet that is eliminated. What is left is compared exactly in the leaves.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.llm import meeting
from fablens.sources.shared import materialize

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
SCALE = 256
LABELS = 10
LEAF = 64
BRANCHES = 12
DEPTH = 24
SLACK = 1e-7


class SiblingTree:
    """A tree over the rows of one shard; rows are kept in leaf order."""

    def __init__(self, rows: dict, leaf: int = LEAF, branches: int = BRANCHES):
        vectors = rows["vector"].astype(np.float64)
        squares = (vectors**2).sum(1)
        self.square = squares.max(initial=0)
        self.lift = np.sqrt(np.maximum(0, self.square - squares))
        self.nodes: list[tuple] = []
        self.compared = 0
        order, leaves = [], 0
        work = [(np.arange(len(vectors)), None, 0)]
        while work:
            mine, parent, depth = work.pop()
            here = len(self.nodes)
            if parent is not None:
                self.nodes[parent][2].append(here)
            points = self._split_points(vectors, mine, branches) if len(mine) > leaf and depth < DEPTH else mine[:0]
            if len(points) < 2:  # few rows, or all alike
                self.nodes.append((leaves, leaves + len(mine), [], None, None))
                order.append(mine)
                leaves += len(mine)
                continue
            far = self._between(vectors, mine, points)
            owner = far.argmin(1)
            parts = [p for p in range(len(points)) if (owner == p).any()]
            low = np.array([[far[owner == j, i].min() for j in parts] for i in range(len(points))])
            high = np.array([[far[owner == j, i].max() for j in parts] for i in range(len(points))])
            self.nodes.append((0, 0, [], points, (low, high)))
            work += [(mine[owner == j], here, depth + 1) for j in reversed(parts)]
        self.rows = meeting.take(rows, np.concatenate(order))
        self.nodes = [(b, e, c, None if p is None else vectors[p], r) for b, e, c, p, r in self.nodes]

    def _between(self, vectors: np.ndarray, many: np.ndarray, points: np.ndarray) -> np.ndarray:
        near = vectors[many] @ vectors[points].T + self.lift[many][:, None] * self.lift[points]
        return np.sqrt(np.maximum(0, 2 * (self.square - near)))

    def _split_points(self, vectors: np.ndarray, mine: np.ndarray, branches: int) -> np.ndarray:
        """Of three times as many evenly spaced candidates, each next one farthest from those chosen; none alike."""
        pool = mine[np.unique(np.linspace(0, len(mine) - 1, 3 * branches).astype(int))]
        least = self._between(vectors, mine, pool[:1])[:, 0]
        chosen, nearest = [mine[least.argmax()]], None
        pool = np.append(pool, chosen[0])
        for _ in range(branches - 1):
            far = self._between(vectors, pool, np.array(chosen[-1:]))[:, 0]
            nearest = far if nearest is None else np.minimum(nearest, far)
            if nearest.max() <= SLACK * np.sqrt(self.square):
                break
            chosen.append(pool[nearest.argmax()])
        return np.array(chosen)

    def search(self, best: meeting.Best) -> None:
        queries = best.queries["vector"].astype(np.float64)
        reach = (queries**2).sum(1) + self.square
        slack = SLACK * np.sqrt(reach)
        with np.errstate(invalid="ignore"):
            inner = np.sqrt(np.maximum(0, reach - 2 * np.minimum(best.queries["ceiling"], reach / 2))) - slack
        work = [(0, np.arange(len(queries)))]
        while work:
            node, active = work.pop()
            if not len(active):
                continue
            begin, end, children, points, ranges = self.nodes[node]
            if points is None:
                for a in range(begin, end, 1024):  # many rows alike make a long leaf
                    part = slice(a, min(a + 1024, end))
                    self.compared += len(active) * (part.stop - a)
                    best.offer(active, meeting.take(self.rows, part), np.sqrt(self.square))
                continue
            far = np.sqrt(np.maximum(0, reach[active][:, None] - 2 * queries[active] @ points.T))
            outer = np.sqrt(np.maximum(0, reach[active] - 2 * best.floor[active])) + slack[active]
            least = np.maximum(far - outer[:, None], inner[active][:, None] - far) - slack[active][:, None]
            most = far + (outer + slack[active])[:, None]
            low, high = ranges
            for j, child in enumerate(children):
                meets = ((least <= high[:, j]) & (most >= low[:, j])).all(1)
                work.append((child, active[meets]))


def _windows(anchors: DataFrame, mode: int, floor, ceiling) -> DataFrame:
    return anchors.select("key", "row", "label", F.lit(mode).alias("mode"), floor.cast("double").alias("floor"), ceiling.cast("double").alias("ceiling"), "vector")


def labelled_vectors(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id``, ``label`` and ``vector`` (long components floor(scale * x)).

    Rows with a null id or label, or a vector that is null, empty or holds a null or non-finite component are left out.
    """
    x = F.col(f"`{vector_col}`")
    scaled = F.transform(x, lambda v: F.floor(F.lit(scale).cast("double") * v.cast("double")).cast("long"))
    kept = df.filter(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & meeting.usable(x))
    return kept.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), scaled.alias("vector"))


def hard_negatives(
    vectors: DataFrame,
    is_anchor,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    shard_rows: int = meeting.SHARD_ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score`` and ``negative_score``.

    ``vectors`` has ``id``, ``label`` and ``vector`` (longs; products must stay below 2^53), ``is_anchor`` is a condition on its rows. Scores are inner products, higher first,
    ties to smaller ids. An anchor's positives are its first ``positives`` other rows of its label; for each of them come the first ``negatives`` rows
    of another label with low * positive score <= 100 * score <= high * positive score. A positive without such rows
    (always so for negative scores) gives none. Every row counts by itself, so rows that repeat an id are candidates
    each, and anchors each; vectors of another dimension never meet. Empty tables give no rows.
    """
    held = meeting.number_rows(vectors.select("id", "label", "vector", F.coalesce(is_anchor.cast("boolean"), F.lit(False)).alias("asks")))
    shards = meeting.shard_count(held, shard_rows)
    anchors = held.filter("asks").withColumn("row", F.col("key"))
    every = _windows(anchors, meeting.SAME, F.lit(float("-inf")), F.lit(float("inf")))
    found = meeting.search(held, every, positives, shards, SiblingTree)
    pairs = found.select(
        F.col("query").alias("row"), F.col("vec_id").alias("positive_id"), F.col("vec_key").alias("positive_key"), F.col("score").alias("positive_score")
    )
    pairs = materialize(pairs.select(F.monotonically_increasing_id().alias("key"), "*"), "positives")
    # Whole scores within the window; its ends as decimals, so that no product overflows.
    score = F.col("positive_score").cast("decimal(19,0)")
    floor, ceiling = F.ceil(score * low / 100), F.floor(score * high / 100)
    asked = pairs.filter(floor <= ceiling).join(anchors.drop("key"), "row")
    chosen = meeting.search(held, _windows(asked, meeting.OTHER, floor, ceiling), negatives, shards, SiblingTree)
    chosen = chosen.select(F.col("query").alias("key"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = pairs.join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return chosen.join(named, "key").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
