"""Daily defect forecast: learner, baseline, error and bounds."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fablens import constants as K
from fablens.operators import series
from fablens.operators.models import FIT_CELLS


def train_defect_forecast(
    train: DataFrame, by: list[str] | None = None, iterations: int = 100, seed: int = 42
) -> PipelineModel:
    """Boosted regression on the five series features.

    With ``by`` (numeric ids) one model is pooled over all series, the id being a feature.
    """
    assembler = VectorAssembler(inputCols=series.FEATURES + (by or []), outputCol="features")
    learner = GBTRegressor(
        featuresCol="features",
        labelCol="defect_runs",
        maxIter=iterations,
        stepSize=0.1,
        maxDepth=5,
        minInstancesPerNode=20,
        seed=seed,
    )
    few = max(1, -(-train.count() * len(assembler.getInputCols()) // FIT_CELLS))
    return Pipeline(stages=[assembler, learner]).fit(train.coalesce(few))


def forecast_predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Predicted defects; a count is never below 0."""
    return (
        model.transform(features)
        .withColumn("predicted", F.greatest("prediction", F.lit(0.0)))
        .drop("prediction", "features")
    )


def seasonal_naive_forecast(features: DataFrame) -> DataFrame:
    """Last week's value of the same weekday."""
    return features.withColumn("predicted", F.col("defect_runs_lag7").cast("double"))


def forecast_error(predicted: DataFrame, by: list[str] | None = None) -> DataFrame:
    miss = F.col("defect_runs") - F.col("predicted")
    return predicted.groupBy(*(by or [])).agg(
        F.count("*").alias("days"), F.avg(F.abs(miss)).alias("mae"), F.sqrt(F.avg(miss * miss)).alias("rmse")
    )


def forecast_table(predicted: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Report rows; the exposure is taken from the unrounded prediction."""
    return predicted.select(
        *(by or []),
        F.date_format("run_date", "yyyy-MM-dd").alias("forecast_date"),
        F.col("defect_runs").alias("actual_defects"),
        F.round("predicted", 1).alias("predicted_defects"),
        F.round(F.col("predicted") * K.SCRAP_COST, 2).alias("predicted_scrap_exposure_gbp"),
    ).orderBy(*(by or []), "forecast_date")


def forecast_bounds(
    calibration: DataFrame, predicted: DataFrame, z: float = 1.96, by: list[str] | None = None
) -> DataFrame:
    """Prediction -/+ z residual deviations of the calibration days, floored at 0."""
    spread = F.stddev_samp(F.col("defect_runs") - F.col("predicted")).alias("residual_std")
    if by:
        widened = predicted.join(calibration.groupBy(*by).agg(spread), by)
    else:
        widened = predicted.withColumn("residual_std", calibration.agg(spread).scalar())
    half = F.col("residual_std") * z
    return widened.select(
        *(by or []),
        "run_date",
        "predicted",
        F.greatest(F.col("predicted") - half, F.lit(0.0)).alias("lower"),
        (F.col("predicted") + half).alias("upper"),
    )


def conformal_bounds(calibration: DataFrame, predicted: DataFrame, miss: float = 0.05, by: list[str] | None = None) -> DataFrame:
    """Prediction -/+ a ranked calibration error, floored at 0: the ceil((n + 1)(1 - miss))-th smallest of n absolute errors.

    A new day like the calibration days lies outside with probability ``miss`` at most, whatever the errors' distribution. With too few
    calibration days for that (n < 1 / miss - 1) there are no finite bounds, and both are NULL. The ordered window runs over days of one series.
    """
    by = by or []
    known = calibration.where(F.col("predicted").isNotNull() & F.col("defect_runs").isNotNull())
    errors = known.select(*by, F.abs(F.col("defect_runs") - F.col("predicted")).alias("_error"))
    series_of = Window.partitionBy(*by)
    rank = F.ceil(F.round((F.count("*").over(series_of) + 1) * (1 - miss), 9))
    ranked = errors.withColumns({"_rank": rank, "_at": F.row_number().over(series_of.orderBy("_error"))})
    half = F.min(F.when(F.col("_at") == F.col("_rank"), F.col("_error"))).alias("half_width")
    widths = ranked.groupBy(*by).agg(half, F.count("*").alias("calibration_days"))
    if by:
        widened = predicted.join(widths, by, "left")
    else:
        packed = widths.select(F.struct("half_width", "calibration_days")).scalar()
        widened = predicted.withColumn("_w", packed).select("*", "_w.half_width", "_w.calibration_days")
    return widened.select(
        *by,
        "run_date",
        "predicted",
        F.coalesce("calibration_days", F.lit(0)).alias("calibration_days"),
        F.greatest(F.col("predicted") - F.col("half_width"), F.when(F.col("half_width").isNotNull(), 0.0)).alias("lower"),
        (F.col("predicted") + F.col("half_width")).alias("upper"),
    )
