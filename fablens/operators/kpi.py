"""Yield and scrap KPIs.

Every KPI is a regrouping of additive cells: units, defects and scrap cost per
key. ``outcome_cells`` folds raw outcomes once (map-side first, so a dominant
day or shift moves one row per task); the KPI functions accept those cells at
any finer grain. A written daily cell table therefore serves every report and
is extended one day at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fablens import constants as K
from fablens.functions import calendar as C
from fablens.functions import numbers as N


def outcome_cells(outcomes: DataFrame, *keys: str) -> DataFrame:
    return outcomes.groupBy(*keys).agg(
        F.count("*").alias("units"),
        N.count_where(F.col("is_defect")).alias("defects"),
        F.sum("estimated_scrap_cost").alias("scrap_cost"),
    )


def regroup(cells: DataFrame, *keys) -> DataFrame:
    return cells.groupBy(*keys).agg(
        F.sum("units").alias("units"), F.sum("defects").alias("defects"), F.sum("scrap_cost").alias("scrap_cost")
    )


def line_cells(orders: DataFrame, lineitem: DataFrame, scrap_cost: float = K.SCRAP_COST) -> DataFrame:
    """Daily cells of order lines (a returned line is a defect), N:1 joined to their order.

    Lines are folded per order before the join, so an order holding a third of
    all lines reaches the join as one row, and the join reuses that shuffle.
    """
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("units"), N.count_where(F.col("l_returnflag") == "R").alias("defects")
    )
    joined = orders.select("o_orderkey", C.run_date(F.col("o_orderdate")).alias("run_date")).join(
        per_order, "o_orderkey"
    )
    return joined.groupBy("run_date").agg(
        F.sum("units").alias("units"),
        F.sum("defects").alias("defects"),
        (F.sum("defects") * scrap_cost).alias("scrap_cost"),
    )


def _conforming():
    return F.col("units") - F.col("defects")


def _defect_pct(name: str):
    return N.pct(F.col("defects"), F.col("units")).alias(name)


def _yield_pct(name: str = "yield_rate_pct"):
    return N.pct(_conforming(), F.col("units")).alias(name)


def production_yield_daily(cells: DataFrame) -> DataFrame:
    return (
        regroup(cells, "run_date")
        .select(
            "run_date",
            F.col("units").alias("total_units_produced"),
            _conforming().alias("conforming_units"),
            F.col("defects").alias("defective_units"),
            _yield_pct(),
            _defect_pct("defect_rate_pct"),
            F.col("scrap_cost").alias("total_scrap_cost_gbp"),
        )
        .orderBy("run_date")
    )


def shift_performance(cells: DataFrame) -> DataFrame:
    return (
        regroup(cells, "shift_code")
        .select(
            "shift_code",
            F.col("units").alias("total_runs"),
            F.col("defects").alias("defect_count"),
            _defect_pct("shift_defect_rate_pct"),
        )
        .orderBy(F.desc("shift_defect_rate_pct"), "shift_code")
    )


def shift_defect_comparison(cells: DataFrame) -> DataFrame:
    return (
        regroup(cells, "shift_code")
        .select(
            "shift_code",
            F.col("units").alias("total_runs"),
            F.col("defects").alias("defective_units"),
            _defect_pct("defect_rate_pct"),
            _yield_pct(),
            F.col("scrap_cost").alias("total_scrap_cost_gbp"),
        )
        .orderBy(F.desc("defect_rate_pct"), "shift_code")
    )


def weekly_scrap_exposure(cells: DataFrame, by_year: bool = True) -> DataFrame:
    """Per ISO week. ``by_year=False`` groups by week number alone (a span within one year)."""
    day = F.col("run_date")
    keys = ([C.iso_year(day).alias("iso_year")] if by_year else []) + [C.week_of_year(day).alias("week_of_year")]
    names = (["iso_year"] if by_year else []) + ["week_of_year"]
    return (
        cells.groupBy(*keys)
        .agg(
            F.min("run_date").alias("week_start_date"),
            F.sum("units").alias("units"),
            F.sum("defects").alias("defects"),
            F.sum("scrap_cost").alias("weekly_scrap_cost_gbp"),
        )
        .select(
            *names,
            "week_start_date",
            F.col("units").alias("total_wafers"),
            F.col("defects").alias("scrap_wafers"),
            _defect_pct("weekly_defect_rate_pct"),
            "weekly_scrap_cost_gbp",
        )
        .orderBy(*names)
    )


def day_of_week_variance(cells: DataFrame) -> DataFrame:
    return (
        regroup(cells, C.day_name(F.col("run_date")).alias("day_name"))
        .select(
            "day_name",
            F.col("units").alias("total_wafers"),
            F.col("defects").alias("defect_count"),
            _defect_pct("defect_rate_pct"),
        )
        .orderBy(F.desc("defect_rate_pct"), "day_name")
    )


def _governance(sensors: DataFrame, total: str, constant: str, high: str, quarantined: str, vetted: str) -> DataFrame:
    return sensors.agg(
        F.count("*").alias(total),
        N.count_where(F.col("is_constant")).alias(constant),
        # By the reason, which comes from the unrounded rate as the quarantine does.
        N.count_where(F.col("quarantine_reason") == K.REASON_MISSING).alias(high),
        N.count_where(F.col("is_quarantined")).alias(quarantined),
        N.count_where(~F.col("is_quarantined")).alias(vetted),
    )


def sensor_governance_summary(sensors: DataFrame) -> DataFrame:
    return _governance(
        sensors,
        "total_sensors",
        "constant_sensors",
        "high_missing_sensors",
        "quarantined_sensors",
        "candidate_features_for_ml",
    )


def sensor_governance_status(sensors: DataFrame) -> DataFrame:
    return _governance(
        sensors,
        "total_instrumentation_sensors",
        "constant_zero_variance",
        "severe_missing_gt_50pct",
        "total_quarantined",
        "vetted_ml_features",
    )


def daily_yield_series(cells: DataFrame, *by: str) -> DataFrame:
    """Input of the forecast: one row per day, or per day and group."""
    return regroup(cells, *by, "run_date").select(
        *by,
        "run_date",
        F.col("units").alias("total_runs"),
        F.col("defects").alias("defect_runs"),
        _yield_pct(),
        F.col("scrap_cost").alias("total_scrap_cost_gbp"),
    )


def bi_base_measures(cells: DataFrame) -> DataFrame:
    totals = regroup(cells)
    return totals.select(
        F.coalesce("units", F.lit(0)).alias("total_wafers_produced"),
        F.coalesce(_conforming(), F.lit(0)).alias("conforming_wafers"),
        F.coalesce("defects", F.lit(0)).alias("defective_wafers"),
        N.safe_divide(_conforming(), F.col("units")).alias("yield_rate"),
        N.safe_divide(F.col("defects"), F.col("units")).alias("defect_rate"),
    )


def rolling_7d_defect_rate(cells: DataFrame, days: int = 7) -> DataFrame:
    """Defects over units of the trailing calendar days: a ratio of sums.

    The ordered window runs over one row per day, never over raw runs.
    """
    trailing = Window.orderBy(F.unix_date("run_date")).rangeBetween(-(days - 1), 0)
    return (
        regroup(cells, "run_date")
        .select(
            "run_date",
            F.sum("defects").over(trailing).alias("defects_7d"),
            F.sum("units").over(trailing).alias("units_7d"),
        )
        .withColumn("rolling_defect_rate", N.safe_divide(F.col("defects_7d"), F.col("units_7d")))
    )


def yield_vs_target(cells: DataFrame, target_pct: float = K.YIELD_TARGET_PCT) -> DataFrame:
    return regroup(cells, "run_date").select(
        "run_date",
        _yield_pct(),
        F.lit(target_pct).alias("target_pct"),
        (N.pct(_conforming(), F.col("units"), 9) >= target_pct).alias("meets_target"),
    )
