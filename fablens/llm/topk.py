"""Exact top-k inner products by norm-bucketed retrieval.

Every shard holds its vectors by falling length, in buckets of ``BUCKET_ROWS``. A query's
k-th best score so far, divided by its own and the bucket's greatest length, is the cosine that
a vector of the bucket must reach. Above 1 the bucket is skipped, as are all that follow;
a high threshold prunes by coordinates, a low one by the vectors' own lengths.
What is left is verified with exact integer products. Queries reach the shards in packs, see ``meeting``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.llm import meeting

K = 5
BUCKET_ROWS = 1024
COORDINATE_COSINE = 0.5
FOCUS = 3
SLACK = 1e-9


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id`` and ``vector`` (long components floor(scale * x)) of every row that can take part.

    Rows with a null id, a null or empty vector, or a null or non-finite component are left out. Rows that repeat an id stay.
    """
    x = F.col(f"`{vector_col}`")
    scaled = F.transform(x, lambda v: F.floor(F.lit(scale).cast("double") * v.cast("double")).cast("long"))
    rows = df.filter(F.col(f"`{id_col}`").isNotNull() & meeting.usable(x))
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), scaled.alias("vector"))


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(1))


class NormBuckets:
    """The rows of one shard and dimension, by falling length."""

    def __init__(self, rows: dict):
        lengths = _lengths(rows["vector"])
        order = np.argsort(-lengths, kind="stable")
        self.rows, self.lengths = meeting.take(rows, order), lengths[order]

    def search(self, best: meeting.Best) -> None:
        queries = best.queries["vector"]
        size = _lengths(queries)
        units = queries / np.maximum(size, 1e-300)[:, None]
        focus = np.argsort(-np.abs(units), axis=1)[:, :FOCUS]
        for begin in range(0, len(self.lengths), BUCKET_ROWS):
            part = slice(begin, begin + BUCKET_ROWS)
            longest = self.lengths[begin]
            active = np.flatnonzero(size * longest * (1 + SLACK) >= best.floor)
            if not len(active):
                break  # the next buckets are shorter still
            reach = size[active] * longest
            cosine = np.where(reach > 0, best.floor[active] / np.maximum(reach, 1e-300), -np.inf)
            sharp = cosine >= COORDINATE_COSINE
            rows, lengths = meeting.take(self.rows, part), self.lengths[part]
            self._by_length(best, active[~sharp], size, rows, lengths)
            if sharp.any():
                sharply = active[sharp]
                query, row = near_axes(units[sharply], focus[sharply], cosine[sharp], rows["vector"], lengths)
                best.offer_pairs(sharply[query], row, rows)
            best.settle()

    def _by_length(self, best: meeting.Best, active: np.ndarray, size: np.ndarray, rows: dict, lengths: np.ndarray) -> None:
        """All products with the longest vectors that can still reach the threshold."""
        if not len(active):
            return
        need = np.where(size[active] > 0, best.floor[active] / np.maximum(size[active], 1e-300), -np.inf).min()
        n = int(np.searchsorted(-lengths, -need * (1 - SLACK), "right")) if need > 0 else len(lengths)
        if n:
            best.offer(active, meeting.take(rows, slice(0, n)), lengths[0])


def near_axes(units: np.ndarray, focus: np.ndarray, cosine: np.ndarray, vectors: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose vector, in the query's greatest coordinates, lies as near as the cosine asks for."""
    unit = vectors / np.maximum(lengths, 1e-300)[:, None]
    fits = np.ones((len(units), len(vectors)), bool)
    cosine = np.minimum(cosine, 1) - SLACK
    for f in range(focus.shape[1]):
        at = focus[:, f]
        mid = units[np.arange(len(units)), at]
        width = np.sqrt(np.maximum(0, (1 - mid**2) * (1 - cosine**2))) + SLACK
        # A cone that holds the axis itself reaches up to 1, or down to -1.
        low = np.where(mid < -cosine + SLACK, -2, mid * cosine - width)
        high = np.where(mid > cosine - SLACK, 2, mid * cosine + width)
        near = unit[:, at].T
        fits &= (near >= low[:, None]) & (near <= high[:, None])
    return np.nonzero(fits)


def top_products(vectors: DataFrame, is_query, k: int = K, shard_rows: int = meeting.SHARD_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's k greatest inner products.

    ``vectors`` has an ``id`` and a ``vector`` of longs; ``is_query`` is a condition on its rows. A query never meets its own row, nor vectors of another
    dimension; rows that repeat an id are candidates each, and queries each. Ties go to the smaller id; with fewer than k candidates all are
    returned. A zero vector scores 0. Empty tables give no rows. Products must fit a long.
    """
    asks = F.coalesce(is_query.cast("boolean"), F.lit(False)).alias("asks")
    held = meeting.number_rows(vectors.select("id", "vector", F.lit(0).cast("long").alias("label"), asks))
    queries = held.filter("asks").select(
        "key", F.col("key").alias("row"), "label", F.lit(meeting.ANY).alias("mode"), F.lit(float("-inf")).alias("floor"), F.lit(float("inf")).alias("ceiling"), "vector"
    )
    found = meeting.search(held, queries, k, meeting.shard_count(held, shard_rows), NormBuckets)
    named = held.filter("asks").select(F.col("key").alias("query"), F.col("id").alias("query_id"))
    return found.join(named, "query").select("query_id", "rank", "vec_id", "score")
