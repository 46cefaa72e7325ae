"""Evaluation of given scores, and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens import constants as K
from fablens.operators import dispatch, evaluation, models, profiling, selection, star
from fablens.operators.attribution import fit_means
from fablens.operators.selection import as_vector
from fablens.plans import checks as Q
from fablens.plans.registry import query
from fablens.plans.warehouse import units
from fablens.sources import bindings as B
from fablens.sources import telemetry
from fablens.streaming import live

MODEL = ["model"]


def lines(spark, folder):
    return B.scored_lines(B.table(spark, folder, "lineitem"))


def contest(spark, folder):
    return B.scored_models(B.table(spark, folder, "lineitem"))


def routed(spark, folder):
    return dispatch.route_lots(B.scored_units(B.table(spark, folder, "events")), 0.14)


def plain_vectors(spark, folder):
    return B.vectors(B.table(spark, folder, "embeddings"))


def width(spark, folder):
    """Number of sensors, from the data."""
    return telemetry.vector_width(B.table(spark, folder, "embeddings"), "embedding")


def fixed_weights(sensors):
    """Weights of the closed-form score: sensor j weighs ((j mod 7) - 3) / 10."""
    return F.array(*[F.lit((j % 7 - 3) / 10) for j in range(1, sensors + 1)])


@query(
    "class_weights",
    """SELECT CASE WHEN label = 0 THEN 1 ELSE 0 END AS y, count(*) AS rows,
       (SELECT count(*) FROM embeddings) / (count(*) * CAST(2 AS DOUBLE)) AS weight FROM embeddings GROUP BY 1""",
)
def class_weights(spark, folder):
    return models.class_weights(plain_vectors(spark, folder))


@query(
    "standardize",
    f"""WITH {Q.readings(masked=False)}, fitted AS (
          SELECT sensor_id, avg(value) AS mean, stddev_pop(value) AS std FROM readings GROUP BY sensor_id)
        SELECT production_id, sensor_id, round((value - mean) / std, 6) AS z FROM readings JOIN fitted USING (sensor_id)""",
)
def standardize(spark, folder):
    vectors = plain_vectors(spark, folder)
    fitted, n = fit_means(vectors), width(spark, folder)
    z = models.standardize_vectors(vectors, as_vector(fitted, "mean", n), as_vector(fitted, "std", n))
    return telemetry.to_readings(z).select("production_id", "sensor_id", F.round("value", 6).alias("z"))


@query("score_lots", f"SELECT production_id, y, round(p, 6) AS p FROM {Q.LINEAR_P} s")
def score_lots(spark, folder):
    scored = models.linear_score(plain_vectors(spark, folder), fixed_weights(width(spark, folder)), -2.2)
    return scored.select("production_id", "y", F.round("p", 6).alias("p"))


CONFUSION = """count(*) FILTER (WHERE y = 0 AND p < 0.14) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 0.14) AS fp,
    count(*) FILTER (WHERE y = 1 AND p < 0.14) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 0.14) AS tp"""


@query("confusion_matrix", f"WITH {Q.SCORED_LINES} SELECT {CONFUSION} FROM scored")
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(lines(spark, folder), 0.14)


@query(
    "cost_of_quality",
    f"""WITH {Q.SCORED_LINES}, m AS (SELECT {CONFUSION} FROM scored)
        SELECT *, fn * CAST(450 AS DOUBLE) + fp * CAST(25 AS DOUBLE) AS cost_gbp FROM m""",
)
def cost_of_quality(spark, folder):
    return evaluation.cost_of_quality(lines(spark, folder), 0.14)


@query(
    "default_threshold_cost",
    f"""WITH {Q.SCORED_MODELS}, m AS (
          SELECT model, count(*) FILTER (WHERE y = 0 AND p <= 0.5) AS tn, count(*) FILTER (WHERE y = 0 AND p > 0.5) AS fp,
                 count(*) FILTER (WHERE y = 1 AND p <= 0.5) AS fn, count(*) FILTER (WHERE y = 1 AND p > 0.5) AS tp
          FROM scored GROUP BY model)
        SELECT *, fn * CAST(450 AS DOUBLE) + fp * CAST(25 AS DOUBLE) AS cost_gbp FROM m""",
)
def default_threshold_cost(spark, folder):
    return evaluation.default_threshold_cost(contest(spark, folder), MODEL)


@query("threshold_curve", f"WITH {Q.SCORED_MODELS}, {Q.CURVE} SELECT * FROM costed")
def threshold_curve(spark, folder):
    return evaluation.threshold_curve(contest(spark, folder), MODEL)


BEST = """best AS (
  SELECT * FROM costed QUALIFY row_number() OVER (PARTITION BY model ORDER BY cost_gbp, threshold) = 1)"""


@query("optimize_threshold", f"WITH {Q.SCORED_MODELS}, {Q.CURVE}, {BEST} SELECT * FROM best")
def optimize_threshold(spark, folder):
    curve = evaluation.threshold_curve(contest(spark, folder), MODEL)
    return evaluation.optimize_threshold(curve, MODEL)


METRICS = """metrics AS (
  SELECT *, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
         (coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) + coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0)) / 2 AS balanced_accuracy,
         coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
         coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
         coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1_score FROM {source})"""


@query(
    "class_metrics",
    f"WITH {Q.SCORED_MODELS}, m AS (SELECT model, {CONFUSION} FROM scored GROUP BY model), "
    + METRICS.format(source="m")
    + " SELECT * FROM metrics",
)
def class_metrics(spark, folder):
    return evaluation.class_metrics(evaluation.confusion_matrix(contest(spark, folder), 0.14, MODEL))


@query("roc_auc", f"WITH {Q.SCORED_MODELS}, {Q.RANK_METRICS} SELECT model, round(roc_auc, 6) AS roc_auc FROM areas")
def roc_auc(spark, folder):
    curve = evaluation.score_curve(evaluation.score_counts(contest(spark, folder), MODEL), MODEL)
    return evaluation.rank_metrics(curve, MODEL).select("model", F.round("roc_auc", 6).alias("roc_auc"))


@query("average_precision", f"WITH {Q.SCORED_MODELS}, {Q.RANK_METRICS} SELECT model, round(pr_auc, 6) AS pr_auc FROM areas")
def average_precision(spark, folder):
    curve = evaluation.score_curve(evaluation.score_counts(contest(spark, folder), MODEL), MODEL)
    return evaluation.rank_metrics(curve, MODEL).select("model", F.round("pr_auc", 6).alias("pr_auc"))


@query(
    "rank_metrics_continuous",
    f"""WITH scored AS (SELECT 'price' AS model, o_totalprice / 1000000 AS p, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders),
        {Q.RANK_METRICS} SELECT round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM areas""",
)
def rank_metrics_continuous(spark, folder):
    """Almost every score is distinct: the running totals are summed slice by slice."""
    scored = B.table(spark, folder, "orders").select(
        (F.col("o_totalprice") / 1000000).alias("p"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y")
    )
    metrics = evaluation.rank_metrics(evaluation.score_curve(evaluation.score_counts(scored)))
    return metrics.select(F.round("roc_auc", 6).alias("roc_auc"), F.round("pr_auc", 6).alias("pr_auc"))


@query(
    "savings_vs_baseline",
    f"""WITH {Q.SCORED_MODELS}, {Q.CURVE}, {BEST}
        SELECT *, CAST((tp + fn) * 450 AS DOUBLE) AS baseline_cost_gbp,
               round(((tp + fn) * 450 - cost_gbp) / CAST((tp + fn) * 450 AS DOUBLE) * 100, 2) AS cost_savings_pct FROM best""",
)
def savings_vs_baseline(spark, folder):
    curve = evaluation.threshold_curve(contest(spark, folder), MODEL)
    return evaluation.savings_vs_baseline(evaluation.optimize_threshold(curve, MODEL))


LEADERBOARD = (
    f"{Q.SCORED_MODELS}, {Q.CURVE}, {BEST}, "
    + METRICS.format(source="best")
    + f""", {Q.RANK_METRICS}, at_default AS (
  SELECT model, count(*) FILTER (WHERE y = 1 AND p <= 0.5) * CAST(450 AS DOUBLE)
              + count(*) FILTER (WHERE y = 0 AND p > 0.5) * CAST(25 AS DOUBLE) AS default_cost_gbp
  FROM scored GROUP BY model), board AS (
  SELECT model, round(accuracy, 4) AS accuracy, round(balanced_accuracy, 4) AS balanced_accuracy,
         round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1_score, 4) AS f1_score,
         round(roc_auc, 4) AS roc_auc, round(pr_auc, 4) AS pr_auc, round(threshold, 3) AS optimal_threshold,
         default_cost_gbp, cost_gbp AS optimal_cost_gbp,
         round(((tp + fn) * 450 - cost_gbp) / CAST((tp + fn) * 450 AS DOUBLE) * 100, 2) AS cost_savings_pct,
         tp AS true_positives, fn AS false_negatives, fp AS false_positives, tn AS true_negatives
  FROM metrics JOIN areas USING (model) JOIN at_default USING (model))"""
)


@query("model_leaderboard", f"WITH {LEADERBOARD} SELECT * FROM board")
def model_leaderboard(spark, folder):
    return evaluation.model_leaderboard(contest(spark, folder))


@query("champion", f"WITH {LEADERBOARD} SELECT * FROM board ORDER BY optimal_cost_gbp, model LIMIT 1")
def champion(spark, folder):
    return evaluation.champion(evaluation.model_leaderboard(contest(spark, folder)))


@query("route_lots", f"WITH {Q.ROUTED} SELECT * FROM routed")
def route_lots(spark, folder):
    return routed(spark, folder).drop("event_ts")


@query("operational_alerts", f"WITH {Q.ALERTS} SELECT * FROM alerts")
def operational_alerts(spark, folder):
    return dispatch.operational_alerts(routed(spark, folder))


@query(
    "route_by_champion",
    f"""WITH {Q.SCORED_UNITS}, labelled AS (SELECT 'value' AS model, p, y FROM scored),
        {Q.CURVE.replace('FROM scored)', 'FROM labelled)')}, cut AS (
          SELECT threshold FROM costed ORDER BY cost_gbp, threshold LIMIT 1)
        SELECT CASE WHEN p >= threshold THEN 'TIER_1_CRITICAL' WHEN p >= 0.08 THEN 'TIER_2_ELEVATED'
                    ELSE 'TIER_3_NOMINAL' END AS risk_tier, count(*) AS lots FROM scored, cut GROUP BY 1""",
)
def route_by_champion(spark, folder):
    """Tier bound taken from the cost-optimal threshold, inside the same query."""
    scored = B.scored_units(B.table(spark, folder, "events"))
    best = evaluation.optimize_threshold(evaluation.threshold_curve(scored))
    tiers = dispatch.route_lots(scored, best.select("threshold").scalar())
    return tiers.groupBy("risk_tier").agg(F.count("*").alias("lots"))


@query(
    "tier_summary",
    f"""WITH {Q.ROUTED} SELECT risk_tier, count(*) AS lots,
        round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM routed) * 100, 1) AS share_pct FROM routed GROUP BY risk_tier""",
)
def tier_summary(spark, folder):
    return dispatch.tier_summary(routed(spark, folder))


@query("dispatch_queue", f"WITH {Q.ALERTS} SELECT * FROM alerts")
def dispatch_queue(spark, folder):
    """The whole queue, in order."""
    return dispatch.dispatch_queue(routed(spark, folder))


@query(
    "dispatch_queue_head",
    f"""WITH {Q.ALERTS} SELECT * FROM alerts ORDER BY CASE alert_urgency WHEN 'URGENT' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END,
        failure_risk_pct DESC, production_id LIMIT 100""",
)
def dispatch_queue_head(spark, folder):
    """A top-k report: the first 100 alerts of the queue."""
    return dispatch.dispatch_queue(routed(spark, folder), 100)


@query(
    "mitigated_cost_by_tier",
    f"""WITH {Q.ROUTED} SELECT risk_tier, CASE WHEN y = 1 THEN 'DEFECT' ELSE 'CONFORMING' END AS actual_quality,
        count(*) AS lots, sum(CASE WHEN risk_tier = 'TIER_3_NOMINAL' AND y = 1 THEN CAST(450 AS DOUBLE)
             WHEN risk_tier = 'TIER_1_CRITICAL' AND y = 0 THEN CAST(25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS cost_gbp
        FROM routed GROUP BY 1, 2""",
)
def mitigated_cost_by_tier(spark, folder):
    return dispatch.mitigated_cost_by_tier(routed(spark, folder))


@query(
    "cost_of_quality_bi",
    f"""WITH {Q.UNITS}, {Q.QUALITY}, {Q.ROUTED}, sums AS (
          SELECT sum(estimated_scrap_cost) AS total_scrap_loss_gbp,
                 count(*) FILTER (WHERE is_defect) * CAST(450 AS DOUBLE) AS baseline_unmitigated_risk_gbp,
                 count(*) FILTER (WHERE is_defect AND risk_tier = 'TIER_3_NOMINAL') * CAST(450 AS DOUBLE)
               + count(*) FILTER (WHERE NOT is_defect AND risk_tier = 'TIER_1_CRITICAL') * CAST(25 AS DOUBLE) AS mitigated_operational_cost_gbp
          FROM quality JOIN routed USING (production_id))
        SELECT *, baseline_unmitigated_risk_gbp - mitigated_operational_cost_gbp AS financial_savings_gbp FROM sums""",
)
def cost_of_quality_bi(spark, folder):
    alerts = dispatch.operational_alerts(routed(spark, folder))
    return dispatch.cost_of_quality_bi(alerts, star.fact_quality_outcome(units(spark, folder)))


# Candidate sensors and medians of the gappy readings; the gate then holds units that miss over 30 % of the candidates.
GAPPY = f"""{Q.readings(gappy=True)}, candidate AS (
  SELECT sensor_id FROM readings GROUP BY sensor_id HAVING count(value) * 2 >= count(*) AND count(DISTINCT value) > 1),
  gate AS (
  SELECT production_id, CAST(count(*) - count(value) AS DOUBLE) / count(*) AS share
  FROM readings JOIN candidate USING (sensor_id) GROUP BY production_id)"""

GAPPY_ALERTS = f"""WITH {GAPPY}, medians AS (SELECT sensor_id, median(value) AS median FROM readings GROUP BY sensor_id), scores AS (
  SELECT production_id, max(y) AS y,
         1 / (1 + exp(-(sum(coalesce(value, median) * (CAST(sensor_id % 7 - 3 AS DOUBLE) / 10)) - 2.2))) AS p
  FROM readings JOIN medians USING (sensor_id) GROUP BY production_id), held AS (
  SELECT production_id, y, CASE WHEN share <= 0.3 THEN p END AS p FROM scores JOIN gate USING (production_id))
  SELECT production_id, printf('LOT_%04d', production_id) AS lot_id, round(p * 100, 2) AS failure_risk_pct,
         CASE WHEN p IS NULL OR p >= 0.14 THEN '{K.TIER_1}' WHEN p >= 0.08 THEN '{K.TIER_2}' ELSE '{K.TIER_3}' END AS risk_tier,
         CASE WHEN p IS NULL OR p >= 0.14 THEN '{K.TIER_1_ACTION}' WHEN p >= 0.08 THEN '{K.TIER_2_ACTION}'
              ELSE '{K.TIER_3_ACTION}' END AS operational_action,
         CASE WHEN p IS NULL OR p >= 0.14 THEN 'URGENT' WHEN p >= 0.08 THEN 'MEDIUM' ELSE 'LOW' END AS alert_urgency,
         CASE WHEN y = 1 THEN 'DEFECT' ELSE 'CONFORMING' END AS actual_quality FROM held"""


def gappy_rules(spark, folder):
    """Weights, intercept, thresholds, medians and candidates for the gappy units."""
    vectors = B.vectors(B.table(spark, folder, "embeddings"), masked=True, gappy=True)
    readings, n = telemetry.to_readings(vectors), width(spark, folder)
    medians = as_vector(selection.fit_medians(readings), "median", n)
    candidates = star.candidate_ids(star.dim_sensor(profiling.sensor_stats(readings)))
    return fixed_weights(n), -2.2, 0.14, K.ELEVATED_RISK, medians, candidates


# Every tenth line has no score: NULL, or NaN where the line number is even.
UNSCORED = """scored AS (
  SELECT l_quantity / 50 AS p, l_orderkey % 10 = 0 AS held, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)"""


def partly_scored(spark, folder):
    lines = B.table(spark, folder, "lineitem")
    gap = F.when(F.col("l_linenumber") % 2 == 0, float("nan"))
    return lines.select(
        F.when(F.col("l_orderkey") % 10 == 0, gap).otherwise(F.col("l_quantity") / 50).alias("p"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
    )


@query(
    "confusion_matrix_unscored",
    f"""WITH {UNSCORED} SELECT count(*) FILTER (WHERE y = 0 AND p < 0.14 AND NOT held) AS tn,
        count(*) FILTER (WHERE y = 0 AND (p >= 0.14 OR held)) AS fp,
        count(*) FILTER (WHERE y = 1 AND p < 0.14 AND NOT held) AS fn,
        count(*) FILTER (WHERE y = 1 AND (p >= 0.14 OR held)) AS tp FROM scored""",
)
def confusion_matrix_unscored(spark, folder):
    """Lots without a score count as flagged, so the four counts add up to all lots."""
    return evaluation.confusion_matrix(partly_scored(spark, folder), 0.14)


@query(
    "threshold_curve_unscored",
    f"""WITH {UNSCORED}, grid AS (SELECT (2 + i) / CAST(100 AS DOUBLE) AS threshold FROM range(89) t(i)), curve AS (
          SELECT threshold, count(*) FILTER (WHERE y = 0 AND p < threshold AND NOT held) AS tn,
                 count(*) FILTER (WHERE y = 0 AND (p >= threshold OR held)) AS fp,
                 count(*) FILTER (WHERE y = 1 AND p < threshold AND NOT held) AS fn,
                 count(*) FILTER (WHERE y = 1 AND (p >= threshold OR held)) AS tp
          FROM scored CROSS JOIN grid GROUP BY threshold)
        SELECT *, fn * CAST(450 AS DOUBLE) + fp * CAST(25 AS DOUBLE) AS cost_gbp FROM curve""",
)
def threshold_curve_unscored(spark, folder):
    return evaluation.threshold_curve(partly_scored(spark, folder))


@query(
    "route_lots_unscored",
    f"""WITH {UNSCORED} SELECT CASE WHEN held OR p >= 0.14 THEN '{K.TIER_1}' WHEN p >= 0.08 THEN '{K.TIER_2}'
        ELSE '{K.TIER_3}' END AS risk_tier, y, count(*) AS lots FROM scored GROUP BY ALL""",
)
def route_lots_unscored(spark, folder):
    """What has no score is held."""
    tiers = dispatch.route_lots(partly_scored(spark, folder), 0.14)
    return tiers.groupBy("risk_tier", "y").agg(F.count("*").alias("lots"))


@query("route_gappy_units", GAPPY_ALERTS)
def route_gappy_units(spark, folder):
    """Units with missing readings: gated over the candidate sensors, imputed, scored and routed."""
    vectors = B.vectors(B.table(spark, folder, "embeddings"), masked=True, gappy=True)
    return live.stream_route_lots(vectors, *gappy_rules(spark, folder))
