"""Daily series: gap filling, lags, rolling statistics, holdout.

All windows here run over daily rows. With ``by`` (tool, line, product) there
is one series per group and the windows are partitioned by it; a group holds at
most one row per calendar day, however many runs it had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fablens import constants as K
from fablens.functions import calendar as C

SERIES, FEATURES = K.SERIES, K.FEATURES


def _ordered(by: list[str]):
    return Window.partitionBy(*by).orderBy("run_date") if by else Window.orderBy("run_date")


def calendar_densify(daily: DataFrame, by: list[str] | None = None, fill_yield: bool = True) -> DataFrame:
    """Every calendar day between the first and the last, missing days filled with 0.

    ``fill_yield=False`` leaves the yield of an idle day NULL instead of 0 %.
    Each day brings along the idle days up to the next one, so the series is
    read once and nothing is joined.
    """
    by = by or []
    until = F.date_sub(F.lead("run_date").over(_ordered(by)), 1)
    spans = daily.withColumn("_until", F.coalesce(until, "run_date"))
    days = spans.withColumn("_day", F.explode(F.sequence("run_date", "_until")))

    def value(column: str) -> Column:
        idle = F.lit(0) if fill_yield or column != "yield_rate_pct" else F.lit(None)
        filled = F.when(F.col("_day") == F.col("run_date"), F.col(column)).otherwise(idle)
        return filled.cast(daily.schema[column].dataType).alias(column)

    return days.select(*by, F.col("_day").alias("run_date"), *[value(c) for c in SERIES if c in daily.columns])


def lag_features(daily: DataFrame, column: str = "defect_runs", by: list[str] | None = None) -> DataFrame:
    order = _ordered(by or [])
    return daily.withColumns(
        {f"{column}_lag{k}": F.coalesce(F.lag(column, k).over(order), F.lit(0)) for k in (1, 7)}
    )


def rolling_features(
    daily: DataFrame, column: str = "defect_runs", by: list[str] | None = None, exclude_current: bool = False
) -> DataFrame:
    """7-row mean and sample deviation. ``exclude_current`` keeps the day's own value out."""
    frame = _ordered(by or []).rowsBetween(-7, -1) if exclude_current else _ordered(by or []).rowsBetween(-6, 0)
    mean = F.avg(column).over(frame)
    return daily.withColumns(
        {
            f"{column}_roll7_mean": F.coalesce(mean, F.lit(0.0)) if exclude_current else mean,
            f"{column}_roll7_std": F.coalesce(F.stddev_samp(column).over(frame), F.lit(0.0)),
        }
    )


def forecast_features(dense: DataFrame, by: list[str] | None = None, exclude_current: bool = False) -> DataFrame:
    lagged = lag_features(dense, "defect_runs", by)
    rolled = rolling_features(lagged, "defect_runs", by, exclude_current)
    return rolled.withColumn("day_of_week", C.day_of_week(F.col("run_date")))


def holdout_tail(dense: DataFrame, days: int = 14, by: list[str] | None = None) -> DataFrame:
    """Mark the last ``days`` days of each series as holdout."""
    last = F.max("run_date").over(Window.partitionBy(*(by or [])))
    return dense.withColumn("is_holdout", F.col("run_date") > F.date_sub(last, days))
