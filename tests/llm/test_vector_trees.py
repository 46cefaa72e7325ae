import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fablens.llm import gnat, meeting, vp_tree


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def product(a, b):
    total = 0 * a[0]
    for x, y in zip(a, b):
        total += x * y
    return total


def brute_nearest(rows, k):
    ok = [(n, i, v) for n, (i, v) in enumerate(rows) if i is not None and usable(v) and any(v)]
    out = []
    for n, i, v in ok:
        if i % 20 == 0:
            scores = sorted((-product(v, w), j) for m, j, w in ok if m != n and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def run_nearest(spark, rows, k, **kw):
    df = spark.createDataFrame([(i, v, f"{i}", 1.5) for i, v in rows], "vec_id bigint, embedding array<double>, key string, score double")
    found = vp_tree.nearest(df.repartition(3), F.col("vec_id") % 20 == 0, k, **kw).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)


def points(spread, n, dim, seed=3):
    r = np.random.default_rng(seed)
    if spread == "clusters":
        v = r.normal(size=(12, dim))[r.integers(0, 12, n)] + 0.2 * r.normal(size=(n, dim))
    elif spread == "ties":
        v = r.integers(-1, 2, (n, dim)).astype(float)
    else:
        v = r.normal(size=(n, dim)) * r.uniform(0, 3, (n, 1))
    return v


@pytest.mark.parametrize("spread", ["clusters", "lengths", "ties"])
def test_factor_one_is_exact(spark, monkeypatch, spread):
    monkeypatch.setattr(vp_tree, "LEAF", 8)
    rows = list(enumerate(points(spread, 900, 6).tolist()))
    assert run_nearest(spark, rows, 7, factor=1.0, shard_rows=200) == brute_nearest(rows, 7)


def test_relaxed_factor_prunes_more_and_keeps_recall():
    n, asked, k = 20_000, 400, vp_tree.K
    v = points("clusters", n, 32)
    rows = {"key": np.arange(n), "id": np.arange(n), "label": np.zeros(n, np.int64), "vector": v}
    scores = v[:asked] @ v.T
    scores[np.arange(asked), np.arange(asked)] = -np.inf
    want = {(i, int(j)) for i in range(asked) for j in np.argsort(-scores[i])[:k]}
    compared = []
    for factor in (1.0, vp_tree.FACTOR):
        queries = {**{c: x[:asked] for c, x in rows.items()}, "row": np.arange(asked), "mode": np.zeros(asked, int)}
        queries |= {"floor": np.full(asked, -np.inf), "ceiling": np.full(asked, np.inf)}
        tree = vp_tree.VantageTree(rows, factor)
        best = meeting.Best(queries, k)
        tree.search(best)
        query, _, _, keys = best.settle()
        recall = len(want & set(zip(query.tolist(), keys.tolist()))) / len(want)
        assert recall == 1 if factor == 1 else recall >= 0.9
        compared.append(tree.compared / asked / n)
    assert compared[1] < compared[0] < 1
    assert compared[1] < 0.25


def test_odd_rows_of_the_nearest(spark):
    one, zero = [1.0, -0.5], [0.0, 0.0]
    rows = [(0, one), (1, zero), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (None, one), (6, [])]
    rows += [(20, zero), (7, one), (7, one), (8, [2.0, 2.0]), (8, [1.0, 1.0]), (9, [1.0]), (40, [1.0]), (60, [3.0, 4.0]), (60, [4.0, 3.0])]
    assert run_nearest(spark, rows, 20) == brute_nearest(rows, 20)
    assert run_nearest(spark, [(0, one)], 20) == run_nearest(spark, [(1, one)], 20) == []
    assert run_nearest(spark, [], 3) == []


def test_a_third_of_all_rows_alike(spark, monkeypatch):
    monkeypatch.setattr(vp_tree, "LEAF", 16)
    monkeypatch.setattr(gnat, "LEAF", 16)
    v = points("lengths", 900, 5)
    v[::3] = v[0]
    rows = list(enumerate(v.tolist()))
    assert run_nearest(spark, rows, 5, factor=1.0, shard_rows=300) == brute_nearest(rows, 5)
    labelled = [(i, i % 4, x) for i, x in rows]
    assert run_mining(spark, labelled, shard_rows=300) == brute_mining(labelled)


def brute_mining(rows):
    ok = [(n, i, y, [math.floor(256 * x) for x in v]) for n, (i, y, v) in enumerate(rows) if i is not None and y is not None and usable(v)]
    out = []
    for n, i, y, q in ok:
        if i % 50 == 0:
            scored = sorted((-product(q, w), j, m, z) for m, j, z, w in ok if m != n and len(w) == len(q))
            for s, j, _, _ in [t for t in scored if t[3] == y][:5]:
                low = [(t, m) for t, m, _, z in scored if z != y and 50 * -s <= 100 * -t <= 95 * -s]
                out += [(i, j, r + 1, m, -s, -t) for r, (t, m) in enumerate(low[:3])]
    return sorted(out)


def run_mining(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id bigint, label int, embedding array<double>, row string, rank int")
    found = gnat.hard_negatives(gnat.labelled_vectors(df), F.col("id") % 50 == 0, **kw).collect()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[c] for c in names) for r in found)


@pytest.mark.parametrize("spread", ["clusters", "lengths", "ties"])
def test_mining_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(gnat, "LEAF", 8)
    r = random.Random(5)
    rows = [(i, r.randrange(4), v) for i, v in enumerate(points(spread, 800, 6).tolist())]
    found = run_mining(spark, rows, shard_rows=150)
    assert found == brute_mining(rows)
    assert len(found) > 50


def test_siblings_are_eliminated():
    """On clusters most leaves lie outside the annulus of a near window."""
    n = 20_000
    v = np.floor(256 * points("clusters", n, 16)).astype(np.int64)
    rows = {"key": np.arange(n), "id": np.arange(n), "label": np.arange(n) % 3, "vector": v}
    own = (v[:100] ** 2).sum(1)
    queries = {**{c: x[:100] for c, x in rows.items()}, "row": np.arange(100), "mode": np.full(100, meeting.OTHER)}
    queries |= {"floor": 0.97 * own, "ceiling": 0.99 * own}
    tree = gnat.SiblingTree(rows)
    best = meeting.Best(queries, n)
    tree.search(best)
    query, _, _, keys = best.settle()
    scores = v[:100] @ v.T
    fits = (scores >= queries["floor"][:, None]) & (scores <= queries["ceiling"][:, None]) & (rows["label"][:100, None] != rows["label"])
    fits[np.arange(100), np.arange(100)] = False
    assert set(zip(query.tolist(), keys.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(fits))))
    assert tree.compared / 100 / n < 0.6


def test_odd_rows_of_mining(spark):
    one = [1.0, 0.5]
    rows = [(0, 1, one), (1, 1, [1.0, 1.0]), (2, 2, [0.9, 0.1]), (3, None, one), (None, 1, one), (4, 1, None), (5, 2, [None, 1.0]), (6, 2, [float("nan"), 0.0])]
    rows += [(50, 2, [-1.0, -1.0]), (7, 2, one), (7, 2, one), (8, 3, [0.7, 0.7]), (100, 1, [2.0]), (9, 1, []), (150, 5, [0.0, 0.0]), (10, 5, [0.0, 0.0])]
    assert run_mining(spark, rows) == brute_mining(rows)
    assert run_mining(spark, []) == run_mining(spark, [(0, 1, one)]) == []
