"""Yield, shift, week, weekday and BI queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens import constants as K
from fablens.operators import kpi, star
from fablens.plans import checks as Q
from fablens.plans.registry import query
from fablens.plans.warehouse import SHIFT_CHECK, masked_stats, outcomes
from fablens.sources import bindings as B
from fablens.sources import sinks


def cells(spark, folder, *keys):
    return kpi.outcome_cells(outcomes(spark, folder), *keys)


def line_cells(spark, folder):
    return kpi.line_cells(B.table(spark, folder, "orders"), B.table(spark, folder, "lineitem"))


YIELD_COLUMNS = f"""run_date, {Q.TOTAL} AS total_units_produced, {Q.GOOD} AS conforming_units,
    {Q.DEFECTS} AS defective_units, {Q.YIELD_PCT} AS yield_rate_pct, {Q.DEFECT_PCT} AS defect_rate_pct,
    {Q.DEFECTS} * CAST(450 AS DOUBLE) AS total_scrap_cost_gbp"""

LINES = """lines AS (
  SELECT CAST(o_orderdate AS DATE) AS run_date, l_returnflag = 'R' AS is_defect
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


@query("production_yield_daily", f"WITH {Q.STAR} SELECT {YIELD_COLUMNS} FROM star GROUP BY run_date")
def production_yield_daily(spark, folder):
    return kpi.production_yield_daily(cells(spark, folder, "run_date"))


@query("line_yield_daily", f"WITH {LINES} SELECT {YIELD_COLUMNS} FROM lines GROUP BY run_date")
def line_yield_daily(spark, folder):
    """The same report where the fact table is many lines per order."""
    return kpi.production_yield_daily(line_cells(spark, folder))


@query(
    "shift_performance",
    f"""WITH {Q.STAR} SELECT shift_code, {Q.TOTAL} AS total_runs, {Q.DEFECTS} AS defect_count,
        {Q.DEFECT_PCT} AS shift_defect_rate_pct FROM star GROUP BY shift_code""",
)
def shift_performance(spark, folder):
    return kpi.shift_performance(cells(spark, folder, "shift_code"))


@query("shift_defect_comparison", SHIFT_CHECK)
def shift_defect_comparison(spark, folder):
    return kpi.shift_defect_comparison(cells(spark, folder, "shift_code"))


WEEK_COLUMNS = f"""min(run_date) AS week_start_date, {Q.TOTAL} AS total_wafers, {Q.DEFECTS} AS scrap_wafers,
    {Q.DEFECT_PCT} AS weekly_defect_rate_pct, {Q.DEFECTS} * CAST(450 AS DOUBLE) AS weekly_scrap_cost_gbp"""


@query(
    "weekly_scrap_exposure",
    f"""WITH {Q.STAR} SELECT week_of_year, {WEEK_COLUMNS} FROM star GROUP BY week_of_year""",
)
def weekly_scrap_exposure(spark, folder):
    return kpi.weekly_scrap_exposure(cells(spark, folder, "run_date"), by_year=False)


@query(
    "line_weekly_scrap_exposure",
    f"""WITH {LINES} SELECT CAST(isoyear(run_date) AS INT) AS iso_year, CAST(week(run_date) AS INT) AS week_of_year,
        {WEEK_COLUMNS} FROM lines GROUP BY iso_year, week_of_year""",
)
def line_weekly_scrap_exposure(spark, folder):
    """Several years: weeks keep their ISO year."""
    return kpi.weekly_scrap_exposure(line_cells(spark, folder))


@query(
    "day_of_week_variance",
    f"""WITH {Q.STAR} SELECT day_name, {Q.TOTAL} AS total_wafers, {Q.DEFECTS} AS defect_count,
        {Q.DEFECT_PCT} AS defect_rate_pct FROM star GROUP BY day_name""",
)
def day_of_week_variance(spark, folder):
    return kpi.day_of_week_variance(cells(spark, folder, "run_date"))


def _governance(total, constant, high, quarantined, vetted):
    return f"""WITH {Q.SENSOR} SELECT count(*) AS {total}, count(*) FILTER (WHERE is_constant) AS {constant},
        count(*) FILTER (WHERE quarantine_reason = '{K.REASON_MISSING}') AS {high}, count(*) FILTER (WHERE is_quarantined) AS {quarantined},
        count(*) FILTER (WHERE NOT is_quarantined) AS {vetted} FROM sensor"""


@query(
    "sensor_governance_summary",
    _governance(
        "total_sensors", "constant_sensors", "high_missing_sensors", "quarantined_sensors", "candidate_features_for_ml"
    ),
)
def sensor_governance_summary(spark, folder):
    return kpi.sensor_governance_summary(star.dim_sensor(masked_stats(spark, folder)))


@query(
    "sensor_governance_status",
    _governance(
        "total_instrumentation_sensors",
        "constant_zero_variance",
        "severe_missing_gt_50pct",
        "total_quarantined",
        "vetted_ml_features",
    ),
)
def sensor_governance_status(spark, folder):
    return kpi.sensor_governance_status(star.dim_sensor(masked_stats(spark, folder)))


@query("daily_yield_series", f"WITH {Q.DAILY} SELECT * FROM daily")
def daily_yield_series(spark, folder):
    return kpi.daily_yield_series(cells(spark, folder, "run_date"))


@query(
    "bi_base_measures",
    f"""WITH {Q.STAR} SELECT {Q.TOTAL} AS total_wafers_produced, {Q.GOOD} AS conforming_wafers,
        {Q.DEFECTS} AS defective_wafers, CAST({Q.GOOD} AS DOUBLE) / {Q.TOTAL} AS yield_rate,
        CAST({Q.DEFECTS} AS DOUBLE) / {Q.TOTAL} AS defect_rate FROM star""",
)
def bi_base_measures(spark, folder):
    return kpi.bi_base_measures(cells(spark, folder, "run_date"))


@query(
    "rolling_7d_defect_rate",
    f"""WITH {Q.DAILY} SELECT run_date, CAST(sum(defect_runs) OVER w AS BIGINT) AS defects_7d,
        CAST(sum(total_runs) OVER w AS BIGINT) AS units_7d,
        CAST(sum(defect_runs) OVER w AS DOUBLE) / CAST(sum(total_runs) OVER w AS DOUBLE) AS rolling_defect_rate FROM daily
        WINDOW w AS (ORDER BY run_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
)
def rolling_7d_defect_rate(spark, folder):
    return kpi.rolling_7d_defect_rate(cells(spark, folder, "run_date"))


@query(
    "yield_vs_target",
    f"""WITH {Q.STAR} SELECT run_date, {Q.YIELD_PCT} AS yield_rate_pct, CAST(95 AS DOUBLE) AS target_pct,
        round(CAST({Q.GOOD} AS DOUBLE) / {Q.TOTAL} * 100, 9) >= 95 AS meets_target FROM star GROUP BY run_date""",
)
def yield_vs_target(spark, folder):
    return kpi.yield_vs_target(cells(spark, folder, "run_date"))


@query(
    "daily_yield_by_tool",
    f"WITH {Q.TOOL_DAILY} SELECT * FROM tool_daily",
)
def daily_yield_by_tool(spark, folder):
    by_tool = kpi.outcome_cells(outcomes(spark, folder, "tool"), "tool", "run_date")
    return kpi.daily_yield_series(by_tool, "tool")


@query(
    "analytics_views",
    f"""WITH {Q.STAR}, daily AS (SELECT run_date, {Q.TOTAL} AS n, {Q.YIELD_PCT} AS pct FROM star GROUP BY run_date),
        shift AS (SELECT shift_code, {Q.TOTAL} AS n, {Q.DEFECT_PCT} AS pct FROM star GROUP BY shift_code),
        {Q.SENSOR}
        SELECT 'best_day' AS report, max(pct) AS figure FROM daily
        UNION ALL SELECT 'worst_shift', max(pct) FROM shift
        UNION ALL SELECT 'candidates', CAST(count(*) AS DOUBLE) FROM sensor WHERE NOT is_quarantined""",
)
def analytics_views(spark, folder):
    """The three reporting views, read back through SQL."""
    by_shift = cells(spark, folder, "run_date", "shift_code")
    sinks.register_views(
        v_production_yield_daily=kpi.production_yield_daily(by_shift),
        v_shift_performance=kpi.shift_performance(by_shift),
        v_sensor_governance_summary=kpi.sensor_governance_summary(star.dim_sensor(masked_stats(spark, folder))),
    )
    return sinks.scan_sql(
        spark,
        """SELECT 'best_day' AS report, max(yield_rate_pct) AS figure FROM v_production_yield_daily
           UNION ALL SELECT 'worst_shift', max(shift_defect_rate_pct) FROM v_shift_performance
           UNION ALL SELECT 'candidates', double(candidate_features_for_ml) FROM v_sensor_governance_summary""",
    )


@query(
    "daily_cells",
    f"""WITH {Q.STAR} SELECT run_date, shift_code, {Q.TOTAL} AS units, {Q.DEFECTS} AS defects,
        sum(estimated_scrap_cost) AS scrap_cost FROM star GROUP BY run_date, shift_code""",
)
def daily_cells(spark, folder):
    """The summary grain from which every report above can be regrouped."""
    return cells(spark, folder, "run_date", "shift_code").select(
        "run_date", "shift_code", "units", "defects", F.col("scrap_cost")
    )
