"""Daily series, forecast report and supply queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens.functions import numbers as N
from fablens.operators import forecast, kpi, series, supply
from fablens.plans import checks as Q
from fablens.plans.kpis import cells
from fablens.plans.registry import query
from fablens.plans.warehouse import outcomes
from fablens.sources import bindings as B
from fablens.sources.shared import materialize


def daily(spark, folder):
    return kpi.daily_yield_series(cells(spark, folder, "run_date"))


def tool_daily(spark, folder):
    by_tool = kpi.outcome_cells(outcomes(spark, folder, "tool"), "tool", "run_date")
    return kpi.daily_yield_series(by_tool, "tool")


def features(spark, folder):
    return series.forecast_features(series.calendar_densify(daily(spark, folder)))


def tool_features(spark, folder):
    return series.forecast_features(series.calendar_densify(tool_daily(spark, folder), ["tool"]), ["tool"])


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


IDLE = f"""{Q.DAILY}, busy AS (SELECT * FROM daily WHERE day(run_date) % 7 <> 0), grid AS (
  SELECT CAST(d AS DATE) AS run_date FROM (
    SELECT unnest(generate_series(min(run_date), max(run_date), INTERVAL 1 DAY)) AS d FROM busy))"""


@query(
    "calendar_densify",
    f"""WITH {IDLE} SELECT run_date, coalesce(total_runs, 0) AS total_runs, coalesce(defect_runs, 0) AS defect_runs,
        coalesce(yield_rate_pct, 0) AS yield_rate_pct, coalesce(total_scrap_cost_gbp, 0) AS total_scrap_cost_gbp
        FROM grid LEFT JOIN busy USING (run_date)""",
)
def calendar_densify(spark, folder):
    return series.calendar_densify(daily(spark, folder).where(F.dayofmonth("run_date") % 7 != 0))


@query(
    "calendar_densify_idle_yield",
    f"""WITH {IDLE} SELECT run_date, coalesce(total_runs, 0) AS total_runs, coalesce(defect_runs, 0) AS defect_runs,
        yield_rate_pct, coalesce(total_scrap_cost_gbp, 0) AS total_scrap_cost_gbp
        FROM grid LEFT JOIN busy USING (run_date)""",
)
def calendar_densify_idle_yield(spark, folder):
    """Idle days have no yield rather than a yield of 0 %."""
    busy = daily(spark, folder).where(F.dayofmonth("run_date") % 7 != 0)
    return series.calendar_densify(busy, fill_yield=False)


@query(
    "lag_features",
    f"""WITH {Q.DAILY}, {Q.features('daily')} SELECT run_date, defect_runs, defect_runs_lag1, defect_runs_lag7
        FROM features""",
)
def lag_features(spark, folder):
    lagged = series.lag_features(series.calendar_densify(daily(spark, folder)))
    return lagged.select("run_date", "defect_runs", "defect_runs_lag1", "defect_runs_lag7")


@query(
    "rolling_features",
    f"""WITH {Q.DAILY}, {Q.features('daily')} SELECT run_date, defect_runs_roll7_mean, defect_runs_roll7_std
        FROM features""",
)
def rolling_features(spark, folder):
    rolled = series.rolling_features(series.calendar_densify(daily(spark, folder)))
    return _rounded(
        rolled.select("run_date", "defect_runs_roll7_mean", "defect_runs_roll7_std"),
        "defect_runs_roll7_mean",
        "defect_runs_roll7_std",
    )


@query(
    "rolling_features_past_only",
    f"""WITH {Q.DAILY} SELECT run_date, round(coalesce(avg(defect_runs) OVER f, 0), 6) AS defect_runs_roll7_mean,
        round(coalesce(stddev_samp(defect_runs) OVER f, 0), 6) AS defect_runs_roll7_std FROM daily
        WINDOW f AS (ORDER BY run_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
)
def rolling_features_past_only(spark, folder):
    """Rolling statistics that leave the day's own (target) value out."""
    rolled = series.rolling_features(series.calendar_densify(daily(spark, folder)), exclude_current=True)
    return _rounded(
        rolled.select("run_date", "defect_runs_roll7_mean", "defect_runs_roll7_std"),
        "defect_runs_roll7_mean",
        "defect_runs_roll7_std",
    )


@query("forecast_features", f"WITH {Q.DAILY}, {Q.features('daily')} SELECT * FROM features")
def forecast_features(spark, folder):
    return _rounded(features(spark, folder), "defect_runs_roll7_mean", "defect_runs_roll7_std")


@query(
    "forecast_features_by_tool",
    f"WITH {Q.TOOL_DAILY}, {Q.features('tool_filled', 'tool')} SELECT * FROM features",
)
def forecast_features_by_tool(spark, folder):
    return _rounded(tool_features(spark, folder), "defect_runs_roll7_mean", "defect_runs_roll7_std")


@query(
    "holdout_tail",
    f"""WITH {Q.DAILY} SELECT run_date, defect_runs,
        run_date > (SELECT max(run_date) FROM daily) - 14 AS is_holdout FROM daily""",
)
def holdout_tail(spark, folder):
    marked = series.holdout_tail(series.calendar_densify(daily(spark, folder)))
    return marked.select("run_date", "defect_runs", "is_holdout")


NAIVE = f"""{Q.DAILY}, {Q.features('daily')}, marked AS (
  SELECT *, CAST(defect_runs_lag7 AS DOUBLE) AS predicted,
         run_date > (SELECT max(run_date) FROM daily) - 14 AS is_holdout FROM features)"""


def naive(spark, folder):
    return forecast.seasonal_naive_forecast(series.holdout_tail(features(spark, folder)))


@query("seasonal_naive_forecast", f"WITH {NAIVE} SELECT run_date, defect_runs, predicted FROM marked WHERE is_holdout")
def seasonal_naive_forecast(spark, folder):
    return naive(spark, folder).where("is_holdout").select("run_date", "defect_runs", "predicted")


@query(
    "forecast_error",
    f"""WITH {NAIVE} SELECT count(*) AS days, round(avg(abs(defect_runs - predicted)), 6) AS mae,
        round(sqrt(avg((defect_runs - predicted) * (defect_runs - predicted))), 6) AS rmse FROM marked WHERE is_holdout""",
)
def forecast_error(spark, folder):
    return _rounded(forecast.forecast_error(naive(spark, folder).where("is_holdout")), "mae", "rmse")


@query(
    "forecast_table",
    f"""WITH {NAIVE} SELECT strftime(run_date, '%Y-%m-%d') AS forecast_date, defect_runs AS actual_defects,
        round(predicted, 1) AS predicted_defects, round(predicted * 450, 2) AS predicted_scrap_exposure_gbp
        FROM marked WHERE is_holdout""",
)
def forecast_table(spark, folder):
    return forecast.forecast_table(naive(spark, folder).where("is_holdout"))


@query(
    "forecast_bounds",
    f"""WITH {NAIVE}, spread AS (
          SELECT stddev_samp(defect_runs - predicted) AS s FROM marked WHERE NOT is_holdout)
        SELECT run_date, predicted, round(greatest(predicted - s * CAST(1.96 AS DOUBLE), 0), 6) AS lower,
               round(predicted + s * CAST(1.96 AS DOUBLE), 6) AS upper FROM marked, spread WHERE is_holdout""",
)
def forecast_bounds(spark, folder):
    marked = materialize(naive(spark, folder), "naive-forecast")
    bounds = forecast.forecast_bounds(marked.where("not is_holdout"), marked.where("is_holdout"))
    return _rounded(bounds, "lower", "upper")


def _plan_sql(group: str, source: str) -> str:
    return f"""WITH per_day AS ({source}), stats AS (
      SELECT {group}, CAST(sum(units - defects) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS base_yield,
             coalesce(stddev_samp(CAST(units - defects AS DOUBLE) / units), 0) AS yield_std
      FROM per_day GROUP BY {group}), sized AS (
      SELECT *, CASE WHEN base_yield > 0 THEN CAST(ceil(round(1000 / base_yield, 9)) AS BIGINT) END AS starts,
             CAST(ceil(round(CAST(2.05 AS DOUBLE) * sqrt(21) * (1000 * yield_std), 9)) AS BIGINT) AS buffer FROM stats)
    SELECT {group}, 1000 AS monthly_target_wafers, '98.0%' AS service_level_target,
           printf('%.2f%%', round(base_yield, 4) * 100) AS base_yield_rate_pct, starts AS planned_wafer_starts,
           buffer AS dynamic_safety_buffer, starts + buffer AS total_material_order,
           round(CAST(buffer * 120 AS DOUBLE), 2) AS cost_of_buffer_gbp FROM sized"""


@query(
    "safety_stock_plan",
    _plan_sql(
        "l_suppkey",
        """SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, count(*) AS units, count(*) FILTER (WHERE l_returnflag = 'R') AS defects
           FROM lineitem GROUP BY ALL""",
    ),
)
def safety_stock_plan(spark, folder):
    per_day = B.table(spark, folder, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(
        F.count("*").alias("units"), N.count_where(F.col("l_returnflag") == "R").alias("defects")
    )
    return supply.safety_stock_plan(per_day, ["l_suppkey"])


@query(
    "safety_stock_by_brand",
    _plan_sql(
        "p_brand",
        """SELECT p_brand, CAST(l_shipdate AS DATE) AS day, count(*) AS units, count(*) FILTER (WHERE l_returnflag = 'R') AS defects
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    ),
)
def safety_stock_by_brand(spark, folder):
    """Lines are folded per part and day before the product lookup."""
    per_part = B.table(spark, folder, "lineitem").groupBy(
        F.col("l_partkey").alias("p_partkey"), F.to_date("l_shipdate").alias("day")
    ).agg(
        F.count("*").alias("units"), N.count_where(F.col("l_returnflag") == "R").alias("defects")
    )
    brands = B.table(spark, folder, "part").select("p_partkey", "p_brand")
    per_day = per_part.join(brands, "p_partkey").groupBy("p_brand", "day").agg(
        F.sum("units").alias("units"), F.sum("defects").alias("defects")
    )
    return supply.safety_stock_plan(per_day, ["p_brand"])
