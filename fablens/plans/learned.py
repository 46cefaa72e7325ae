"""Learned models. No SQL gives their scores, so each query returns what must hold of them, row by row."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fablens import constants as K
from fablens.operators import attribution, dispatch, evaluation, forecast, models, selection, series, star
from fablens.plans import checks as Q
from fablens.plans.ranking import split_vectors, train_medians
from fablens.plans.registry import query
from fablens.plans.risk import width
from fablens.plans.timeline import daily, tool_daily
from fablens.plans.warehouse import masked_stats
from fablens.sources import telemetry
from fablens.sources.shared import materialize, new_path

# The units of the later 20 %, which no model has seen.
HELD_OUT = """placed AS (
  SELECT vec_id AS production_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y,
         row_number() OVER (ORDER BY vec_id) <= floor(0.8 * count(*) OVER ()) AS is_train
  FROM embeddings), held_out AS (SELECT production_id, y FROM placed WHERE NOT is_train)"""
IN_RANGE = f"WITH {HELD_OUT} SELECT production_id, y, TRUE AS in_range FROM held_out"


def training_sets(spark, folder):
    """Imputed candidate sensors of both sides of the split, written once."""
    train, test = split_vectors(spark, folder)
    medians, n = train_medians(train), width(spark, folder)
    sensors = star.candidate_ids(star.dim_sensor(masked_stats(spark, folder)))
    sides = []
    for name, side in (("train", train), ("test", test)):
        filled = models.pick_sensors(selection.impute_vectors(side, medians, n), sensors)
        sides.append(materialize(filled.select("production_id", "event_ts", "y", "values"), name))
    return sides[0], sides[1], sensors


def in_range(scored):
    return scored.select("production_id", "y", F.col("p").between(0, 1).alias("in_range"))


@query(
    "train_dummy_majority",
    f"""WITH {HELD_OUT} SELECT production_id, y,
        (SELECT CASE WHEN sum(y) * 2 > count(*) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END FROM placed WHERE is_train) AS p
        FROM held_out""",
)
def train_dummy_majority(spark, folder):
    train, test, _ = training_sets(spark, folder)
    return models.score_dummy(train, test).select("production_id", "y", "p")


@query("train_logistic", IN_RANGE)
def train_logistic(spark, folder):
    train, test, _ = training_sets(spark, folder)
    return in_range(models.score_lots(models.train_logistic(train), test))


@query("train_random_forest", IN_RANGE)
def train_random_forest(spark, folder):
    train, test, _ = training_sets(spark, folder)
    return in_range(models.score_lots(models.train_random_forest(train), test))


@query("train_gbt", IN_RANGE)
def train_gbt(spark, folder):
    train, test, _ = training_sets(spark, folder)
    return in_range(models.score_lots(models.train_gbt(train), test))


@query(
    "rf_importance",
    f"WITH {Q.RANKING} SELECT sensor_id, TRUE AS non_negative, CAST(1 AS DOUBLE) AS total FROM sensor_state",
)
def rf_importance(spark, folder):
    """Every candidate sensor has an importance; they add up to 1."""
    train, _, sensors = training_sets(spark, folder)
    found = models.rf_importance(train, sensors)
    total = found.agg(F.round(F.sum("rf_importance"), 6)).scalar()
    return found.select("sensor_id", (F.col("rf_importance") >= 0).alias("non_negative"), total.alias("total"))


def learned_ranking(train, sensors):
    """Forest importance blended with mutual information."""
    readings = telemetry.to_readings(train, "y").withColumnRenamed("sensor_id", "slot")
    slots = F.array(*[F.lit(s) for s in sensors])
    readings = readings.withColumn("sensor_id", F.get(slots, F.col("slot") - 1)).drop("slot")
    both = models.rf_importance(train, sensors).join(selection.mutual_information(readings), "sensor_id")
    return selection.composite_rank(both)


@query(
    "feature_ranking",
    f"""WITH {Q.RANKING} SELECT sensor_id, round(mutual_info, 6) AS mutual_info, TRUE AS in_range FROM ranking""",
)
def feature_ranking(spark, folder):
    """Mutual information is checked as it is, the blend with the forest's importance by its range."""
    train, _, sensors = training_sets(spark, folder)
    ranked = learned_ranking(train, sensors)
    inside = F.col("composite_score").between(0, 1 + 1e-9)
    return ranked.select("sensor_id", F.round("mutual_info", 6).alias("mutual_info"), inside.alias("in_range"))


def risk_study(spark, folder, top_k=50):
    """Split, impute, rank, keep the top sensors, fit the candidates and compare their costs."""
    train, test, sensors = training_sets(spark, folder)
    top = selection.select_top_k(learned_ranking(train, sensors), top_k).collect()
    chosen = [r["sensor_id"] for r in top]
    slots = [sensors.index(s) + 1 for s in chosen]
    train, test = (
        materialize(models.pick_sensors(side, slots), name) for side, name in ((train, "x-train"), (test, "x-test"))
    )
    fitted, scored = models.train_and_score(train, test)
    scored = materialize(scored, "scored")
    return fitted, scored, train, test


MODEL_NAMES = ", ".join(f"('{m}')" for m in (models.DUMMY, models.LOGISTIC, models.FOREST, models.BOOSTED))


@query(
    "trained_leaderboard",
    f"""WITH {HELD_OUT} SELECT model, count(*) AS lots, CAST(sum(y) AS BIGINT) AS defects
        FROM held_out CROSS JOIN (VALUES {MODEL_NAMES}) v(model) GROUP BY model""",
)
def trained_leaderboard(spark, folder):
    """The four candidates on the held-out rows; each one's counts add up to all of them."""
    _, scored, _, _ = risk_study(spark, folder)
    defects = F.col("true_positives") + F.col("false_negatives")
    lots = defects + F.col("false_positives") + F.col("true_negatives")
    return evaluation.model_leaderboard(scored).select("model", lots.alias("lots"), defects.alias("defects"))


def threshold_of(spark, path):
    return spark.read.schema("optimal_threshold double").json(f"{path}/metadata").scalar()


@query("save_and_load_model", f"WITH {HELD_OUT} SELECT production_id, TRUE AS same, TRUE AS on_grid FROM held_out")
def save_and_load_model(spark, folder):
    """Scores of the reloaded model equal those of the fitted one; its threshold came along."""
    train, test, _ = training_sets(spark, folder)
    model = models.train_logistic(train)
    scored = models.score_lots(model, test)
    path = new_path(spark, "champion")
    board = evaluation.model_leaderboard(models.as_scored(models.LOGISTIC, scored))
    models.save_model(model, path, evaluation.champion(board))
    again = models.score_lots(models.load_model(path), test)
    joined = scored.select("production_id", "p").join(
        again.select("production_id", F.col("p").alias("p_loaded")), "production_id"
    )
    return joined.select(
        "production_id", (F.col("p") == F.col("p_loaded")).alias("same"), threshold_of(spark, path).between(0.02, 0.9).alias("on_grid")
    )


def champion_alerts_frame(spark, folder):
    """Train, compare, keep the cheapest with its row, reload it, score and route: (alerts, stored scores, path)."""
    fitted, scored, train, test = risk_study(spark, folder)
    best = evaluation.champion(evaluation.model_leaderboard(scored))
    path = new_path(spark, "champion")
    best = materialize(best, "champion-row")
    name = best.first()["model"]
    if name == models.DUMMY:  # nothing to load: its score is the training majority
        best.write.mode("overwrite").json(f"{path}/metadata")
        again = models.score_dummy(train, test)
    else:
        models.save_model(fitted[name], path, best)
        again = models.score_lots(models.load_model(path), test)
    alerts = dispatch.operational_alerts(dispatch.route_lots(again, threshold_of(spark, path)))
    return alerts, scored.where(F.col("model") == name), path


@query(
    "champion_alerts",
    f"""WITH {HELD_OUT} SELECT production_id, CASE WHEN y = 1 THEN 'DEFECT' ELSE 'CONFORMING' END AS actual_quality,
        TRUE AS consistent FROM held_out""",
)
def champion_alerts(spark, folder):
    """Every held-out unit has one alert, and its tier is the one that the stored score and threshold give."""
    alerts, stored, path = champion_alerts_frame(spark, folder)
    t1 = threshold_of(spark, path)
    tier = F.when(F.col("p") >= t1, K.TIER_1).when(F.col("p") >= K.ELEVATED_RISK, K.TIER_2).otherwise(K.TIER_3)
    expected = stored.select("production_id", tier.alias("expected"))
    joined = alerts.join(expected, "production_id")
    return joined.select("production_id", "actual_quality", (F.col("risk_tier") == F.col("expected")).alias("consistent"))


def explain(spark, folder):
    """(attributions per unit and slot, scored units, sensors) of the fitted logistic model on the held-out rows."""
    train, test, sensors = training_sets(spark, folder)
    model = models.train_logistic(train)
    n = len(sensors)
    fitted = attribution.fit_means(train)
    scaled = models.standardize_vectors(
        test,
        selection.as_vector(fitted, "mean", n),
        # The model's scaler divides by the sample deviation.
        selection.as_vector(
            fitted.withColumn("sd", F.col("std") * F.sqrt(F.col("rows") / (F.col("rows") - 1))), "sd", n
        ),
    )
    weights = selection.as_vector(models.coefficients(model, spark, list(range(1, n + 1))), "coef", n)
    means = selection.as_vector(attribution.fit_means(scaled), "mean", n)
    margins = model.transform(models._features(test)).select(
        "production_id", vector_to_array("rawPrediction")[1].alias("margin")
    )
    return attribution.linear_shap(scaled, weights, means), margins, sensors


def learned_playbook(spark, folder):
    """Attribution of the fitted logistic model over the held-out rows, with actions."""
    shap, _, sensors = explain(spark, folder)
    ids = F.array(*[F.lit(s) for s in sensors])
    shap = shap.withColumn("sensor_id", F.get(ids, F.col("sensor_id") - 1))
    return attribution.action_playbook(attribution.shap_importance(shap), attribution.playbook(spark))


@query("explain_logistic", f"WITH {HELD_OUT} SELECT production_id, TRUE AS adds_up FROM held_out")
def explain_logistic(spark, folder):
    """A unit's attributions add up to its margin, less the mean margin."""
    shap, margins, _ = explain(spark, folder)
    margins = materialize(margins, "margins")
    mean = margins.agg(F.avg("margin")).scalar()
    sums = shap.groupBy("production_id").agg(F.sum("shap").alias("total")).join(margins, "production_id")
    return sums.select("production_id", (F.abs(F.col("total") - (F.col("margin") - mean)) < 1e-6).alias("adds_up"))


@query(
    "learned_playbook",
    f"""WITH {Q.RANKING} SELECT sensor_id, CASE 'Attribute ' || sensor_id
          {" ".join(f"WHEN '{code}' THEN '{action}'" for code, action in K.PLAYBOOK)}
          ELSE '{K.DEFAULT_ACTION}' END AS recommended_engineering_action FROM sensor_state""",
)
def learned_playbook_query(spark, folder):
    return learned_playbook(spark, folder).select("sensor_id", "recommended_engineering_action")


def forecast_frame(spark, folder, by, days=14, exclude_current=False):
    """Predictions of every day. The fit ends ``2 * days`` before the end; the days between it and the holdout calibrate."""
    source = tool_daily(spark, folder) if by else daily(spark, folder)
    dense = series.calendar_densify(source, by)
    features = series.forecast_features(dense, by, exclude_current)
    marked = series.holdout_tail(features, 2 * days, by).withColumnRenamed("is_holdout", "is_late")
    marked = materialize(series.holdout_tail(marked, days, by), "series")
    model = forecast.train_defect_forecast(marked.where("not is_late"), by)
    return forecast.forecast_predict(model, marked)


def held_out_report(predicted, by):
    report = forecast.forecast_table(predicted.where("is_holdout"), by)
    fine = (F.col("predicted_defects") >= 0) & (F.col("predicted_scrap_exposure_gbp") >= 0)
    return report.select(*by, "forecast_date", "actual_defects", fine.alias("non_negative"))


TOOL_TAIL = f"""{Q.TOOL_DAILY}, tail AS (
  SELECT *, run_date > max(run_date) OVER (PARTITION BY tool) - 14 AS is_holdout FROM tool_filled)"""
TOOL_REPORT = f"""WITH {TOOL_TAIL} SELECT tool, strftime(run_date, '%Y-%m-%d') AS forecast_date, defect_runs AS actual_defects,
    TRUE AS non_negative FROM tail WHERE is_holdout"""
PLANT_REPORT = f"""WITH {Q.DAILY} SELECT strftime(run_date, '%Y-%m-%d') AS forecast_date, defect_runs AS actual_defects,
    TRUE AS non_negative FROM daily WHERE run_date > (SELECT max(run_date) FROM daily) - 14"""


@query("train_defect_forecast", TOOL_REPORT)
def train_defect_forecast(spark, folder):
    """One model pooled over all tools, on the published features, whose rolling window holds the day itself (parity)."""
    return held_out_report(forecast_frame(spark, folder, ["tool"]), ["tool"])


@query("train_defect_forecast_past_only", TOOL_REPORT)
def train_defect_forecast_past_only(spark, folder):
    """The same on features that know only earlier days."""
    return held_out_report(forecast_frame(spark, folder, ["tool"], exclude_current=True), ["tool"])


@query("train_plant_forecast", PLANT_REPORT)
def train_plant_forecast(spark, folder):
    """One series for the whole plant."""
    return held_out_report(forecast_frame(spark, folder, [], exclude_current=True), [])


@query(
    "learned_forecast_error",
    f"""WITH {TOOL_TAIL} SELECT tool, count(*) AS days, TRUE AS consistent FROM tail WHERE is_holdout GROUP BY tool""",
)
def learned_forecast_error(spark, folder):
    """MAE and RMSE of the learned model per tool: the first never exceeds the second, nor that by more than sqrt(days)."""
    predicted = forecast_frame(spark, folder, ["tool"], exclude_current=True).where("is_holdout")
    error = forecast.forecast_error(predicted, ["tool"])
    fine = (F.col("mae") <= F.col("rmse") + 1e-9) & (F.col("rmse") <= F.col("mae") * F.sqrt("days") + 1e-9)
    return error.select("tool", "days", fine.alias("consistent"))


@query(
    "learned_forecast_bounds",
    f"WITH {TOOL_TAIL} SELECT tool, run_date, TRUE AS ordered FROM tail WHERE is_holdout",
)
def learned_forecast_bounds(spark, folder):
    """Bounds from the residuals of days that the fit has not seen."""
    predicted = materialize(forecast_frame(spark, folder, ["tool"], exclude_current=True), "predicted")
    bounds = forecast.forecast_bounds(
        predicted.where("is_late and not is_holdout"), predicted.where("is_holdout"), by=["tool"]
    )
    ordered = (F.col("lower") >= 0) & (F.col("lower") <= F.col("predicted")) & (F.col("predicted") <= F.col("upper"))
    # A tool with fewer than two calibration days has no bounds.
    return bounds.select("tool", "run_date", F.coalesce(ordered, F.lit(True)).alias("ordered"))
