"""Wafer starts and safety stock per product group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens import constants as K
from fablens.functions import numbers as N


def safety_stock_plan(
    daily: DataFrame,
    by: list[str],
    target: int = K.MONTHLY_TARGET,
    z: float = K.SERVICE_LEVEL_Z,
    lead_days: int = K.LEAD_TIME_DAYS,
    unit_cost: float = K.WAFER_COST,
    service_level: float = K.SERVICE_LEVEL,
) -> DataFrame:
    """Starts and buffer from each group's own yield and day-to-day deviation.

    ``daily`` holds one row per group and day (units, defects). Values are
    rounded to 9 places before the ceiling so that float noise cannot add a unit.
    A group without a good unit has no finite number of starts (NULL).
    """
    good = F.col("units") - F.col("defects")
    stats = daily.groupBy(*by).agg(
        F.try_divide(F.sum(good).cast("double"), F.sum("units")).alias("base_yield"),
        F.coalesce(F.stddev_samp(F.try_divide(good.cast("double"), F.col("units"))), F.lit(0.0)).alias("yield_std"),
    )
    return plan_from_yield(stats, by, target, z, lead_days, unit_cost, service_level)


def plan_from_yield(
    stats: DataFrame,
    by: list[str],
    target: int = K.MONTHLY_TARGET,
    z: float = K.SERVICE_LEVEL_Z,
    lead_days: int = K.LEAD_TIME_DAYS,
    unit_cost: float = K.WAFER_COST,
    service_level: float = K.SERVICE_LEVEL,
) -> DataFrame:
    """The plan for known yields (columns base_yield, yield_std)."""

    def whole(x):
        return F.ceil(F.round(x, 9)).cast("bigint")

    starts = whole(F.try_divide(F.lit(float(target)), F.col("base_yield")))
    buffer = whole(F.lit(z) * F.sqrt(F.lit(float(lead_days))) * (F.lit(float(target)) * F.col("yield_std")))
    sized = stats.withColumns({"planned_wafer_starts": starts, "dynamic_safety_buffer": buffer})
    return sized.select(
        *by,
        F.lit(target).alias("monthly_target_wafers"),
        N.percent_text(F.lit(service_level), 1).alias("service_level_target"),
        N.percent_text(F.round("base_yield", 4), 2).alias("base_yield_rate_pct"),
        "planned_wafer_starts",
        "dynamic_safety_buffer",
        (F.col("planned_wafer_starts") + F.col("dynamic_safety_buffer")).alias("total_material_order"),
        F.round(F.col("dynamic_safety_buffer") * unit_cost, 2).alias("cost_of_buffer_gbp"),
    )
