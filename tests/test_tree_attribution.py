"""Attributions of tree models against all subsets of sensors, and what alerts carry of them."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from fablens.operators import models, tree_attribution

SCHEMA = "production_id bigint, y int, values array<double>"


@pytest.fixture(scope="module")
def lots(spark):
    r = np.random.default_rng(3)
    x = np.round(r.normal(size=(240, 4)), 2)
    y = ((x[:, 0] > 0) & (x[:, 1] > 0.3)) | (x[:, 2] > 1)
    rows = [(i, int(y[i]), x[i].tolist()) for i in range(240)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1), x


def fitted(lots, kind):
    if kind == "boosted":
        return models.train_gbt(lots, 4)
    return models.train_random_forest(lots, 5, 3)


def expectation(nodes, at, x, known, weigh, leaf):
    """The tree's mean over what is unknown, by walking it."""
    node = nodes[at]
    if node["left"] < 0:
        return leaf(node)
    if node["sensor"] in known:
        return expectation(nodes, node["left"] if x[node["sensor"]] <= node["threshold"] else node["right"], x, known, weigh, leaf)
    left, right = (weigh(nodes[node[s]]) / weigh(node) for s in ("left", "right"))
    return left * expectation(nodes, node["left"], x, known, weigh, leaf) + right * expectation(nodes, node["right"], x, known, weigh, leaf)


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_equals_all_subsets(spark, lots, kind):
    df, x = lots
    model = fitted(df, kind)
    trees = {}
    for row in tree_attribution.model_nodes(model, spark).collect():
        trees.setdefault(row["tree"], {})[row["id"]] = row
    if kind == "boosted":
        weigh, leaf, scale = (lambda n: n["stats"][0]), (lambda n: n["prediction"]), model.stages[-1].treeWeights
    else:
        weigh, leaf, scale = (lambda n: sum(n["stats"])), (lambda n: n["stats"][1] / sum(n["stats"])), [1 / 5] * 5
    score = lambda v, s: sum(scale[t] * expectation(nodes, 0, v, s, weigh, leaf) for t, nodes in trees.items())
    found = {}
    paths = tree_attribution.path_table(model, spark)
    for row in tree_attribution.tree_shap(df.limit(25), paths).collect():
        found[row["production_id"], row["sensor_id"] - 1] = row["shap"]
    seen = {i for i, _ in found}
    assert len(seen) == 25
    for i in seen:
        for j in range(4):
            rest = [k for k in range(4) if k != j]
            want = 0.0
            for n in range(4):
                for s in combinations(rest, n):
                    want += factorial(n) * factorial(3 - n) / factorial(4) * (score(x[i], {*s, j}) - score(x[i], set(s)))
            assert found.get((i, j), 0.0) == pytest.approx(want, abs=1e-12)
    assert spark.range(1).select(tree_attribution.base_value(paths)).first()[0] == pytest.approx(score(x[0], set()), abs=1e-12)


def test_missing_readings_lie_in_no_interval(spark, lots):
    df, _ = lots
    paths = tree_attribution.path_table(fitted(df, "forest"), spark)
    gone = df.limit(3).withColumn("values", F.transform("values", lambda v: F.lit(None).cast("double")))
    total = tree_attribution.tree_shap(gone, paths).groupBy("production_id").agg(F.sum("shap").alias("s")).collect()
    base = spark.range(1).select(tree_attribution.base_value(paths)).first()[0]
    assert [r["s"] + base for r in total] == pytest.approx([0.0] * 3, abs=1e-12)


def test_a_model_that_tests_nothing(spark):
    same = spark.createDataFrame([(i, i % 2, [1.0, 1.0]) for i in range(20)], SCHEMA).coalesce(1)
    shap, base = tree_attribution.explain_model(models.train_random_forest(same, 2, 3), same)
    assert shap.count() == 0
    assert spark.range(1).select(base).first()[0] == pytest.approx(0.5, abs=0.3)


@pytest.mark.parametrize("name", ["logistic", "forest", "boosted"])
def test_any_winner_is_explained(lots, name):
    df, _ = lots
    model = models.train_logistic(df) if name == "logistic" else fitted(df, name)
    shap, base = tree_attribution.explain_model(model, df)
    total = shap.groupBy("production_id").agg(F.sum("shap").alias("total"))
    gaps = tree_attribution.tree_margin(model, df).join(total, "production_id").select(F.abs(F.col("total") + base - F.col("margin")))
    assert max(r[0] for r in gaps.collect()) < 1e-9
    alerts = df.select("production_id")
    with_drivers = tree_attribution.alerts_with_drivers(alerts, shap, 2).collect()
    assert len(with_drivers) == 240
    assert all([d["driver_rank"] for d in r["drivers"]] == [1, 2] for r in with_drivers)
    assert all(abs(r["drivers"][0]["shap"]) >= abs(r["drivers"][1]["shap"]) for r in with_drivers)
    none = tree_attribution.alerts_with_drivers(alerts, shap.limit(0)).collect()
    assert {tuple(r["drivers"]) for r in none} == {()}


def test_only_tree_models_have_paths(spark, lots):
    with pytest.raises(ValueError):
        tree_attribution.path_table(models.train_logistic(lots[0]), spark)
