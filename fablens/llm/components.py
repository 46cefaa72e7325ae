"""Connected components by alternating star steps; the graph never meets in one task or on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.sources.shared import discard, materialize


def _lowest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour below each node. Written, so that joins with it can split a hot node."""
    return materialize(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("least")), "least")


def _checksum(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node of the edges.

    ``edges`` has two columns of one ordered type. Loops, repeated and reversed edges are fine; edges
    with a null end are left out. Each round hangs every node below the smallest node it knows (large
    star), then every node's lower neighbours below the smallest of them (small star), until
    all edges lead to roots. A hub is one row per task before shuffling.
    """
    a, b = (F.col(c) for c in edges.columns)
    both = edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
    held = materialize(both.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    before = _checksum(held)
    while before[0]:
        low = _lowest(held)
        hung = held.join(low, held["lo"] == low["node"], "left").select("hi", F.coalesce("least", "lo").alias("lo"))
        hung = materialize(hung.distinct(), "edges")
        below = _lowest(hung)
        met = hung.join(below, hung["hi"] == below["node"]).select("hi", "lo", "least")
        # An edge to the least neighbour stays; other neighbours are hung below it.
        new = met.select(F.when(F.col("lo") == F.col("least"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("least").alias("lo"))
        after = materialize(new.distinct(), "edges")
        now = _checksum(after)
        discard(held, low, hung, below)
        held = after
        if now == before:
            break
        before = now
    roots = held.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return held.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
