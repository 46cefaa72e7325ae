import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fablens.llm import topk


def brute(rows, k=5):
    ok = []
    for n, (i, v) in enumerate(rows):
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((n, i, [math.floor(256 * x) for x in v]))
    out = []
    for m, i, q in ok:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for n, j, v in ok if n != m and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    vectors = topk.integer_vectors(df, "vec_id", "embedding", 256)
    found = topk.top_products(vectors, F.col("id") % 50 == 0, **kw).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)


@pytest.mark.parametrize("bucket", [1024, 8])
@pytest.mark.parametrize("spread", ["lengths", "unit", "ties"])
def test_equals_brute_force(spark, monkeypatch, bucket, spread):
    monkeypatch.setattr(topk, "BUCKET_ROWS", bucket)
    r = random.Random(spread)
    rows = []
    for i in range(600):
        v = [r.gauss(0, 1) for _ in range(8)]
        if spread == "unit":
            n = math.sqrt(sum(x * x for x in v))
            v = [x / n for x in v]
        elif spread == "ties":
            v = [float(r.randrange(-1, 2)) for _ in range(8)]
        else:
            v = [x * r.random() ** 4 * 10 for x in v]
        rows.append((i, v))
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("dim", [64, 12])
def test_dominant_coordinates_in_several_buckets(spark, dim):
    """Heavy tails at alike lengths: a query's great coordinate, of either sign, bounds a wide cone."""
    r = np.random.default_rng(dim)
    v = r.standard_t(1.2, (6000, dim))
    v *= (r.uniform(0.95, 1, 6000) / np.sqrt((v**2).sum(1)))[:, None]
    q = np.floor(256 * v).astype(np.int64)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id bigint, embedding array<double>").coalesce(1)
    vectors = topk.integer_vectors(df, "vec_id", "embedding", 256).coalesce(1)
    found = topk.top_products(vectors, F.col("id") % 10 == 0).collect()
    want = []
    for i in range(0, 6000, 10):
        scores = q @ q[i]
        order = [int(j) for j in np.lexsort((np.arange(6000), -scores))[:6] if j != i][:5]
        want += [(i, n + 1, j, int(scores[j])) for n, j in enumerate(order)]
    assert sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in found) == want


def test_cone_around_a_negative_axis():
    unit = np.array([[-0.8, 0.6]])
    pairs = topk.near_axes(unit, np.array([[0, 1]]), np.array([0.5]), np.array([[-100, 0]]), np.array([100.0]))
    assert [x.tolist() for x in pairs] == [[0], [0]]


def test_odd_rows(spark):
    zero, one = [0.0, 0.0], [1.0, -0.5]
    rows = [(0, one), (1, zero), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (None, one)]
    rows += [(50, zero), (50, one), (6, one), (6, one), (7, [2.0, 2.0]), (7, [1.0, 1.0]), (8, [1.0]), (100, [1.0]), (150, []), (9, [-1e6, 3e6])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(1, one)]) == []
    assert run(spark, [(0, one)]) == []


@pytest.mark.parametrize("bucket", [1024, 16])
def test_many_packs_meet_many_shards(spark, monkeypatch, bucket):
    """Half of all rows ask, in 50 packs and more, over a dozen shards; nothing of it passes the driver."""
    monkeypatch.setattr(topk, "BUCKET_ROWS", bucket)
    r = random.Random(4)
    rows = [(i * 25, [r.gauss(0, 1) * (1 + i % 9) for _ in range(4)]) for i in range(6400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(60)
    vectors = topk.integer_vectors(df, "vec_id", "embedding", 256)
    found = topk.top_products(vectors, F.col("id") % 50 == 0, shard_rows=500).collect()
    q = np.array([[math.floor(256 * x) for x in v] for _, v in rows])
    want = []
    for i in range(0, 6400, 2):
        scores = q @ q[i]
        scores[i] = -(2**62)
        order = np.lexsort((np.arange(6400), -scores))[:5]
        want += [(i * 25, n + 1, int(j) * 25, int(scores[j])) for n, j in enumerate(order)]
    assert sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in found) == want


def test_products_near_the_range_of_a_long(spark):
    r = random.Random(8)
    rows = [(i, [r.choice([-1, 1]) * (2.0**22 + r.randrange(4)) for _ in range(3)]) for i in range(120)]
    assert run(spark, rows) == brute(rows)
