"""Learned models: invariants, not values."""

import random

import pytest
from pyspark.sql import functions as F

from fablens.operators import attribution, models, selection


@pytest.fixture(scope="module")
def sets(spark):
    r = random.Random(11)
    rows = []
    for i in range(400):
        y = int(r.random() < 0.2)
        rows.append((i, y, [r.gauss(1.5 * y, 1), r.gauss(0, 1), r.gauss(-y, 2), 1.0]))
    df = spark.createDataFrame(rows, "production_id bigint, y int, values array<double>")
    from fablens.sources.shared import materialize

    return materialize(df.where("production_id < 300"), "tr"), materialize(df.where("production_id >= 300"), "te")


def scores(df):
    return {r["production_id"]: r["p"] for r in df.collect()}


def test_class_weights_sum_to_the_rows(spark, sets):
    train, _ = sets
    weights = models.class_weights(train).collect()
    assert sum(r["rows"] * r["weight"] for r in weights) == pytest.approx(300)
    assert models.with_weights(train).agg(F.sum("weight")).first()[0] == pytest.approx(300)


def test_dummy_scores_the_majority(spark, sets):
    assert set(scores(models.score_dummy(*sets)).values()) == {0.0}


def test_logistic_is_stable_under_repartition(spark, sets):
    train, test = sets
    a = scores(models.score_lots(models.train_logistic(train), test))
    b = scores(models.score_lots(models.train_logistic(train.repartition(5)), test))
    assert all(0 <= p <= 1 for p in a.values())
    assert max(abs(a[k] - b[k]) for k in a) < 1e-6


def test_logistic_meets_its_optimality_condition(spark, sets):
    """At the optimum, w + C * sum(weight * (p - y) * z) = 0 on population-scaled inputs."""
    import numpy as np

    train, _ = sets
    model = models.train_logistic(train)
    rows = models.score_lots(model, models.with_weights(train)).collect()
    x = np.array([r["values"] for r in rows])
    y = np.array([r["y"] for r in rows])
    p = np.array([r["p"] for r in rows])
    weight = np.array([r["weight"] for r in rows])
    std = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(std > 0, std, 1)
    n = len(rows)
    w = model.stages[-1].coefficients.toArray() * np.sqrt((n - 1) / n)
    gradient = w + (z * (weight * (p - y))[:, None]).sum(axis=0)
    assert np.abs(gradient).max() < 0.05


def test_forest_importances_sum_to_one(spark, sets):
    train, _ = sets
    ranked = models.rf_importance(train, [1, 2, 3, 4], trees=20, depth=5)
    rows = {r["sensor_id"]: r["rf_importance"] for r in ranked.collect()}
    assert sum(rows.values()) == pytest.approx(1)
    assert max(rows, key=rows.get) == 1 and rows[4] == 0


def test_boosted_scores_are_probabilities(spark, sets):
    train, test = sets
    p = scores(models.score_lots(models.train_gbt(train, iterations=5), test))
    assert len(p) == 100 and all(0 <= v <= 1 for v in p.values())


def test_saved_model_scores_alike(spark, sets, tmp_path):
    train, test = sets
    model = models.train_logistic(train)
    models.save_model(model, str(tmp_path), spark.range(1))
    assert scores(models.score_lots(models.load_model(str(tmp_path)), test)) == scores(models.score_lots(model, test))


def test_closed_form_equals_the_model(spark, sets):
    train, test = sets
    model = models.train_logistic(train)
    fitted = attribution.fit_means(train).withColumn("sd", F.col("std") * F.sqrt(F.col("rows") / (F.col("rows") - 1)))
    z = models.standardize_vectors(test, selection.as_vector(fitted, "mean", 4), selection.as_vector(fitted, "sd", 4))
    weights = selection.as_vector(models.coefficients(model, spark, [1, 2, 3, 4]), "coef", 4)
    closed = scores(models.linear_score(z, weights, float(model.stages[-1].intercept)))
    fitted_scores = scores(models.score_lots(model, test))
    assert max(abs(closed[k] - fitted_scores[k]) for k in closed) < 1e-9


def test_attributions_add_up(spark, sets):
    """Per lot they sum to its margin minus the mean margin."""
    _, test = sets
    weights = F.array(*[F.lit(w) for w in (0.5, -1.0, 0.25, 2.0)])
    means = selection.as_vector(attribution.fit_means(test), "mean", 4)
    sums = attribution.linear_shap(test, weights, means).groupBy("production_id").agg(F.sum("shap").alias("s"))
    margin = F.expr("values[0] * 0.5 - values[1] + values[2] * 0.25 + values[3] * 2")
    rows = test.select("production_id", margin.alias("m")).join(sums, "production_id").collect()
    mean = sum(r["m"] for r in rows) / len(rows)
    assert all(r["s"] == pytest.approx(r["m"] - mean, abs=1e-9) for r in rows)


def test_playbook_default(spark):
    ranking = spark.createDataFrame([("Attribute 60", 2.0), ("Attribute 578", 1.0)], "sensor_code string, mean_abs_shap double")
    rows = {
        r["sensor_code"]: r["recommended_engineering_action"]
        for r in attribution.action_playbook(ranking, attribution.playbook(spark)).collect()
    }
    assert rows["Attribute 60"].startswith("Chamber Plasma RF Matching")
    assert rows["Attribute 578"].startswith("Standard Metrology Audit")


def test_lot_drivers_break_ties_by_sensor(spark):
    lots = spark.createDataFrame([(1, [1.0, -1.0, 3.0, 0.0])], "production_id bigint, values array<double>")
    ones, zeros = F.array(*[F.lit(1.0)] * 4), F.array(*[F.lit(0.0)] * 4)
    rows = attribution.lot_top_drivers(lots, ones, zeros, 3).collect()
    assert [(r["driver_rank"], r["sensor_id"], r["shap"]) for r in rows] == [(1, 3, 3.0), (2, 1, 1.0), (3, 2, -1.0)]
