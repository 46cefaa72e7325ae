"""Choices made on validation rows, and bounds from ranked errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens import constants as K
from fablens.operators import forecast, models, rolling, series
from fablens.plans import checks as Q
from fablens.plans.learned import training_sets
from fablens.plans.registry import query
from fablens.plans.timeline import NAIVE, daily, naive, tool_daily
from fablens.plans.warehouse import units
from fablens.sources import bindings as B
from fablens.sources.shared import materialize

SEGMENTS = f"""{Q.UNITS}, numbered AS (
  SELECT *, row_number() OVER (ORDER BY event_ts, production_id) AS spot, count(*) OVER () AS n FROM units), placed AS (
  SELECT production_id, event_ts, CASE WHEN raw_label = 1 THEN 1 ELSE 0 END AS y,
         {" + ".join(f"CAST(spot > floor(n * {r}) AS INT)" for r in rolling.RATIOS)} AS fold FROM numbered)"""
TEST = len(rolling.RATIOS)


@query(
    "rolling_folds",
    f"""WITH {SEGMENTS}, counts AS (SELECT fold, count(*) AS rows, CAST(sum(y) AS BIGINT) AS defects FROM placed GROUP BY fold)
        SELECT CAST(fold AS INT) AS fold, (SELECT CAST(sum(rows) AS BIGINT) FROM counts b WHERE b.fold < c.fold) AS train_rows,
               (SELECT CAST(sum(defects) AS BIGINT) FROM counts b WHERE b.fold < c.fold) AS train_defects, rows, defects,
               fold = {TEST} AS is_test FROM counts c WHERE fold > 0""",
)
def rolling_folds(spark, folder):
    """Training rows of each fold, and those it is judged on."""
    runs = units(spark, folder)
    return rolling.fold_summary(runs, rolling.counted_cuts(runs), F.when(F.col("raw_label") == K.FAIL_LABEL, 1).otherwise(0))


SCORES = {"value": ("value / (value + 300)", "value / (value + 300)"), "clock": ("(hour(ts) + 1) / 25.0D", "(hour(ts) + 1) / CAST(25 AS DOUBLE)")}


def scored_segments(spark, folder):
    """Two closed-form scores of every run, with its segment; and the cuts."""
    events = B.table(spark, folder, "events")
    cuts = rolling.counted_cuts(units(spark, folder))
    scores = F.array(*[F.struct(F.lit(n).alias("model"), F.expr(own).alias("p")) for n, (own, _) in SCORES.items()])
    rows = events.select(
        F.col("event_id").alias("production_id"), F.col("ts").alias("event_ts"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("y"), F.explode(scores).alias("s")
    )
    return rows.select("s.model", "production_id", "s.p", "y", rolling.segment(cuts).alias("fold")), cuts


def _cost_sql(where: str, name: str) -> str:
    models_sql = " UNION ALL ".join(
        f"SELECT '{n}' AS model, fold, y, {sql} AS p FROM placed JOIN events ON event_id = production_id" for n, (_, sql) in SCORES.items()
    )
    return f"""{name}_scored AS ({models_sql}), {name} AS (
      SELECT model, threshold, count(*) FILTER (WHERE y = 0 AND p < threshold) AS tn, count(*) FILTER (WHERE y = 0 AND p >= threshold) AS fp,
             count(*) FILTER (WHERE y = 1 AND p < threshold) AS fn, count(*) FILTER (WHERE y = 1 AND p >= threshold) AS tp,
             count(*) FILTER (WHERE y = 1 AND p < threshold) * CAST(450 AS DOUBLE) + count(*) FILTER (WHERE y = 0 AND p >= threshold) * CAST(25 AS DOUBLE) AS cost
      FROM {name}_scored CROSS JOIN (SELECT (2 + i) / CAST(100 AS DOUBLE) AS threshold FROM range(89) t(i)) WHERE {where} GROUP BY model, threshold)"""


@query(
    "rolling_choice",
    f"""WITH {SEGMENTS}, {_cost_sql(f"fold BETWEEN 1 AND {TEST - 1}", "tried")}, {_cost_sql(f"fold = {TEST}", "tested")}, best AS (
          SELECT model, threshold, cost FROM tried QUALIFY row_number() OVER (PARTITION BY model ORDER BY cost, threshold) = 1)
        SELECT b.model, b.threshold, b.cost AS validation_cost_gbp, row_number() OVER (ORDER BY b.cost, b.model) = 1 AS is_champion,
               t.tn, t.fp, t.fn, t.tp, t.cost AS cost_gbp FROM best b JOIN tested t USING (model, threshold)""",
)
def rolling_choice(spark, folder):
    """Threshold and champion from the folds' rows; the test rows give their cost and decide nothing."""
    rows, _ = scored_segments(spark, folder)
    rows = materialize(rows, "scored-segments")
    chosen = rolling.choose(rows.where(F.col("fold").between(1, TEST - 1)))
    return rolling.test_once(chosen, rows.where(F.col("fold") == TEST))


@query(
    "rolling_trained",
    f"""WITH placed AS (
          SELECT vec_id AS production_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y,
                 row_number() OVER (ORDER BY vec_id) AS spot, floor(0.8 * count(*) OVER ()) AS n FROM embeddings), inner_rows AS (
          SELECT production_id, y, CAST(spot > floor(n * 0.5) AS INT) + CAST(spot > floor(n * 0.75) AS INT) AS fold FROM placed WHERE spot <= n)
        SELECT production_id, y, CAST(fold AS INT) AS fold, m AS model, TRUE AS in_range FROM inner_rows CROSS JOIN (VALUES ('{models.LOGISTIC}'), ('{models.DUMMY}')) v(m) WHERE fold = 1""",
)
def rolling_trained(spark, folder):
    """Two learners over the training rows: every validation row is scored by models of earlier rows only."""
    train, _, _ = training_sets(spark, folder)
    cuts = rolling.counted_cuts(train, (0.5, 0.75))

    def logistic(rows):
        model = models.train_logistic(rows)
        return lambda lots: models.score_lots(model, lots)

    fit = {models.LOGISTIC: logistic, models.DUMMY: lambda rows: lambda lots: models.score_dummy(rows, lots)}
    scored = rolling.rolling_scores(train, cuts, fit)
    return scored.select("production_id", "y", "fold", "model", F.col("p").between(0, 1).alias("in_range"))


def _conformal_sql(source: str, by: str) -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""errors AS (
      SELECT {keys}abs(defect_runs - predicted) AS e, row_number() OVER ({part} ORDER BY abs(defect_runs - predicted)) AS spot,
             count(*) OVER ({part}) AS n FROM {source} WHERE NOT is_holdout), widths AS (
      SELECT {keys}any_value(n) AS n, min(e) FILTER (WHERE spot = ceil(round((n + 1) * CAST(0.95 AS DOUBLE), 9))) AS w FROM errors {f"GROUP BY {by}" if by else ""})
    SELECT {keys}run_date, predicted, coalesce(n, 0) AS calibration_days, round(CASE WHEN w IS NOT NULL THEN greatest(predicted - w, 0) END, 6) AS lower,
           round(predicted + w, 6) AS upper FROM {source} {f"LEFT JOIN widths USING ({by})" if by else ", widths"} WHERE is_holdout"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query("conformal_bounds", f"WITH {NAIVE}, {_conformal_sql('marked', '')}")
def conformal_bounds(spark, folder):
    """Bounds of the plant's forecast: the ranked error of the days before the holdout."""
    marked = materialize(naive(spark, folder), "naive-forecast")
    return _rounded(forecast.conformal_bounds(marked.where("not is_holdout"), marked.where("is_holdout")))


TOOL_NAIVE = f"""{Q.TOOL_DAILY}, {Q.features("tool_filled", "tool")}, marked AS (
  SELECT *, CAST(defect_runs_lag7 AS DOUBLE) AS predicted, run_date > max(run_date) OVER (PARTITION BY tool) - 7 AS is_holdout FROM features)"""


@query("conformal_bounds_by_tool", f"WITH {TOOL_NAIVE}, {_conformal_sql('marked', 'tool')}")
def conformal_bounds_by_tool(spark, folder):
    """The same per tool; a tool with too few days has none."""
    dense = series.calendar_densify(tool_daily(spark, folder), ["tool"])
    marked = series.holdout_tail(series.forecast_features(dense, ["tool"]), 7, ["tool"])
    marked = materialize(forecast.seasonal_naive_forecast(marked), "naive-by-tool")
    return _rounded(forecast.conformal_bounds(marked.where("not is_holdout"), marked.where("is_holdout"), by=["tool"]))
