"""Importance of a forest whose trees no process holds: MLlib's rules, whichever nodes are split by counts or grown in a task."""

import uuid

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier

from fablens.operators import forest, models
from fablens.plans import learned
from fablens.sources.shared import materialize

ROWS, SENSORS = 1500, 6


@pytest.fixture(scope="module")
def train(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(ROWS, SENSORS))
    x[:, 3], x[:, 4] = r.integers(1, 6, ROWS), 1.0
    y = (x[:, 0] + x[:, 1] ** 2 + r.normal(size=ROWS) > 2.2).astype(int)
    rows = [(i, int(y[i]), x[i].tolist()) for i in range(ROWS)]
    return materialize(spark.createDataFrame(rows, "production_id bigint, y int, values array<double>").repartition(3), "forest")


def found(train, trees, depth, **options):
    weights = {r["y"]: r["weight"] for r in models.class_weights(train).collect()}
    return forest.importances(train, weights, ROWS, SENSORS, trees, depth, 42, **options)


def test_one_tree_on_all_rows_equals_mllib(train):
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="y", weightCol="weight", maxDepth=4).fit(models.fit_frame(train))
    whole = {"per_node": SENSORS, "bootstrap": False}
    assert found(train, 1, 4, **whole) == pytest.approx(tree.featureImportances.toArray(), abs=1e-9)


@pytest.mark.parametrize("depth", [0, 1, 5, 30])
def test_nodes_split_by_counts_give_the_same_tree(train, monkeypatch, depth):
    whole = {"per_node": SENSORS, "bootstrap": False}
    in_one_task = found(train, 1, depth, **whole)
    monkeypatch.setattr(forest, "LOCAL_CELLS", 100 * SENSORS)
    assert found(train, 1, depth, **whole) == pytest.approx(in_one_task, abs=1e-12)


def test_forest_agrees_with_mllib(train, monkeypatch):
    learner = RandomForestClassifier(featuresCol="features", labelCol="y", weightCol="weight", numTrees=40, maxDepth=8, featureSubsetStrategy="sqrt", seed=42)
    known = learner.fit(models.fit_frame(train)).featureImportances.toArray()
    assert np.abs(found(train, 40, 8) - known).max() < 0.04
    monkeypatch.setattr(forest, "LOCAL_CELLS", 300 * SENSORS)
    assert np.abs(found(train, 40, 8) - known).max() < 0.04


def test_more_nodes_than_a_pass_counts(train, monkeypatch):
    whole = {"per_node": SENSORS, "bootstrap": False}
    together = found(train, 1, 30, **whole)
    monkeypatch.setattr(forest, "NODES", 3)
    assert found(train, 1, 30, **whole) == pytest.approx(together, abs=1e-12)


def test_deep_forest_takes_few_jobs_and_no_model(spark, train, monkeypatch):
    """A job per level, and all nodes on the driver, is what made the ranking forest fail."""
    monkeypatch.setattr(models, "train_random_forest", None)
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "importance")
    try:
        rows = models.rf_importance(train, list(range(1, SENSORS + 1)), trees=10, depth=30).collect()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sum(r["rf_importance"] for r in rows) == pytest.approx(1)
    assert rows[4]["rf_importance"] == 0  # constant
    assert 0 < len(jobs) <= 20


def test_one_class_has_no_importance(train):
    only = train.where("y = 0")
    assert set(forest.importances(only, {0: 0.5}, only.count(), SENSORS, 3, 5, 42)) == {0.0}


@pytest.mark.parametrize("values, y", [([1.0, None], 0), ([1.0, float("nan")], 0), ([1.0, float("inf")], 1), ([1.0], 1)])
def test_incomplete_rows_raise(spark, values, y):
    df = spark.createDataFrame([(1, 0, [1.0, 2.0]), (2, 1, [2.0, 1.0]), (3, y, values)], "production_id bigint, y int, values array<double>")
    with pytest.raises(Exception, match="a training"):
        models.rf_importance(df, [1, 2], 2, 3)


def test_rows_that_come_twice_weigh_twice(spark):
    """Twice each row is the same tree; the bounds and shares stay."""
    rows = [(i, i % 3 % 2, [float(i % 7), float(i % 5)]) for i in range(60)]
    once = spark.createDataFrame(rows, "production_id bigint, y int, values array<double>")
    twice = once.union(once)
    one, two = (forest.importances(d, {0: 0.75, 1: 1.5}, d.count(), 2, 1, 30, 42, 2, False) for d in (once, twice))
    assert one == pytest.approx(two, abs=1e-9)


def test_learned_ranking_blends_without_a_model(train, monkeypatch):
    """feature_ranking: the forest's importance and mutual information of every sensor, no fitted forest on the driver."""
    monkeypatch.setattr(models, "train_random_forest", None)
    sensors = [11, 12, 13, 14, 15, 16]
    rows = {r["sensor_id"]: r for r in learned.learned_ranking(train, sensors).collect()}
    assert sorted(rows) == sensors
    top = {c: max(r[c] for r in rows.values()) for c in ("rf_importance", "mutual_info")}
    for r in rows.values():
        blend = 0.7 * r["rf_importance"] / top["rf_importance"] + 0.3 * r["mutual_info"] / top["mutual_info"]
        assert r["composite_score"] == pytest.approx(blend, abs=1e-9)
    assert rows[15]["composite_score"] == 0  # constant
    assert max(rows, key=lambda s: rows[s]["rf_importance"]) in (11, 12)  # the two that the class was made of
