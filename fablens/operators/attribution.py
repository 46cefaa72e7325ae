"""Linear attribution: how far each sensor moves a lot's risk score.

For a linear score with independent inputs the Shapley value of sensor j is
coef_j * (z_j - mean_j). It is computed inside each row's array; nothing is
shuffled until values are averaged per sensor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fablens import constants as K
from fablens.functions import numbers as N
from fablens.sources.shared import literal_table, materialize
from fablens.sources.telemetry import to_readings


def fit_means(vectors: DataFrame) -> DataFrame:
    """Mean, population deviation and count per sensor of an array column, written once."""
    stats = (
        to_readings(vectors)
        .groupBy("sensor_id")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("rows"))
    )
    return materialize(stats, "sensor-means")


def contributions(values: Column, weights: Column, means: Column) -> Column:
    """Array of coef * (value - mean)."""
    centred = F.zip_with(values, means, lambda v, m: v - m)
    return F.zip_with(centred, weights, lambda d, w: d * w)


def linear_shap(vectors: DataFrame, weights: Column, means: Column) -> DataFrame:
    """Long form: one attribution per lot and sensor."""
    return (
        vectors.withColumns({"_w": weights, "_m": means})
        .withColumn("values", contributions(F.col("values"), F.col("_w"), F.col("_m")))
        .transform(to_readings)
        .withColumnRenamed("value", "shap")
    )


def shap_importance(shap: DataFrame) -> DataFrame:
    """Mean absolute attribution per sensor, strongest first."""
    return (
        shap.groupBy("sensor_id")
        .agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
        .select("sensor_id", N.sensor_code(F.col("sensor_id")).alias("sensor_code"), "mean_abs_shap")
        .orderBy(F.desc("mean_abs_shap"), "sensor_id")
    )


def playbook(spark, entries=None) -> DataFrame:
    """Recommended actions as a table."""
    return literal_table(spark, ["sensor_code", "action"], entries or K.PLAYBOOK)


def action_playbook(ranking: DataFrame, actions: DataFrame, default: str = K.DEFAULT_ACTION) -> DataFrame:
    """Look up each sensor's action; sensors without one get the standard audit."""
    return (
        ranking.join(actions, "sensor_code", "left")
        .withColumn("recommended_engineering_action", F.coalesce("action", F.lit(default)))
        .drop("action")
    )


def top_risk_drivers(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("mean_abs_shap"), "sensor_id").limit(k)


def lot_top_drivers(vectors: DataFrame, weights: Column, means: Column, n: int = 3) -> DataFrame:
    """The n strongest sensors of every lot, picked inside the row.

    The n-th largest size is found on plain numbers; only sensors that reach it
    (n, or more on ties) are built as structs and ordered, ties by sensor.
    """
    shap = F.col("_shap")
    sizes = F.sort_array(F.transform(shap, lambda s: F.abs(s)), asc=False)
    cutoff = F.coalesce(F.get(sizes, F.lit(n - 1)), F.lit(0.0))
    entries = F.transform(
        shap,
        lambda s, i: F.when(
            F.abs(s) >= F.col("_cutoff"),
            F.struct((-F.abs(s)).alias("order"), (i + 1).alias("sensor_id"), s.alias("shap")),
        ),
    )
    top = F.slice(F.array_sort(F.array_compact(entries)), 1, n)
    return (
        vectors.withColumns({"_w": weights, "_m": means})
        .select("production_id", contributions(F.col("values"), F.col("_w"), F.col("_m")).alias("_shap"))
        .withColumn("_cutoff", cutoff)
        .select("production_id", F.posexplode_outer(top).alias("_pos", "d"))
        .where("_pos is not null")
        .select("production_id", (F.col("_pos") + 1).alias("driver_rank"), "d.sensor_id", "d.shap")
    )
