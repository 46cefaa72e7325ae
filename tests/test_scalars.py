"""Scalar rules. Published figures used as expectations are fixed values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fablens.functions import calendar as C
from fablens.functions import numbers as N
from fablens.operators import evaluation


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "hour, shift",
    [(5, "NIGHT"), (6, "DAY"), (13, "DAY"), (14, "EVENING"), (21, "EVENING"), (22, "NIGHT"), (0, "NIGHT")],
)
def test_shift_bounds(spark, hour, shift):
    ts = F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp_ntz")
    assert one(spark, C.assign_shift(ts)) == f"{shift}_SHIFT"


def test_shift_of_missing_time(spark):
    assert one(spark, C.assign_shift(F.lit(None).cast("timestamp_ntz"))) is None


@pytest.mark.parametrize("text", ["19/07/2008 11:55:00", "2008-07-19 11:55:00", "19/07/2008 11:55", "2008-07-19 11:55"])
def test_mixed_timestamps(spark, text):
    assert one(spark, C.parse_ts_mixed(F.lit(text))) == datetime(2008, 7, 19, 11, 55)


def test_day_first(spark):
    assert one(spark, C.parse_ts_mixed(F.lit("03/04/2008 00:00:00"))) == datetime(2008, 4, 3)
    assert one(spark, C.parse_ts_mixed(F.lit("not a time"))) is None


@pytest.mark.parametrize(
    "day, year, week", [(date(2008, 12, 29), 2009, 1), (date(2010, 1, 3), 2009, 53), (date(2024, 1, 1), 2024, 1)]
)
def test_iso_weeks(spark, day, year, week):
    assert one(spark, C.iso_year(F.lit(day))) == year
    assert one(spark, C.week_of_year(F.lit(day))) == week


def test_monday_is_zero(spark):
    assert one(spark, C.day_of_week(F.lit(date(2024, 1, 1)))) == 0
    assert one(spark, C.day_of_week(F.lit(date(2024, 1, 7)))) == 6


def test_safe_divide(spark):
    assert one(spark, N.safe_divide(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, N.safe_divide(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, N.pct(F.lit(1), F.lit(0))) is None


def test_codes_keep_long_ids(spark):
    assert one(spark, N.lot_code(F.lit(7))) == "LOT_0007"
    assert one(spark, N.lot_code(F.lit(9999))) == "LOT_9999"
    assert one(spark, N.lot_code(F.lit(123456))) == "LOT_123456"
    assert one(spark, N.lot_code(F.lit(-5))) == "LOT_-005"
    assert one(spark, N.sensor_alias(F.lit(12))) == "sensor_012"
    assert one(spark, N.percent_text(F.lit(0.98), 1)) == "98.0%"


def test_nan_is_missing(spark):
    assert one(spark, N.nan_to_null(F.lit(float("nan")))) is None
    assert one(spark, N.nan_to_null(F.lit(1.5))) == 1.5


def test_grid_index_at_and_beside_every_threshold(spark):
    import math

    grid = [(2 + i) / 100.0 for i in range(89)]
    probes = [0.0, 0.019, 0.5, 0.905, 1.0, 2.0, -1.0]
    for t in grid:
        probes += [t, math.nextafter(t, 0), math.nextafter(t, 1)]
    rows = spark.createDataFrame([(p,) for p in probes], "p double").select("p", N.grid_index(F.col("p")).alias("i"))
    for row in rows.collect():
        expected = max((i for i, t in enumerate(grid) if row["p"] >= t), default=-1)
        assert row["i"] == expected, row


def published(spark):
    return spark.createDataFrame([(134, 163, 2, 15)], "tn bigint, fp bigint, fn bigint, tp bigint")


def test_published_confusion_matrix(spark):
    """tp 15, fn 2, fp 163, tn 134 give the published cost, savings and metrics."""
    row = evaluation.savings_vs_baseline(evaluation.class_metrics(evaluation.with_cost(published(spark)))).first()
    assert row["cost_gbp"] == 4975.0
    assert row["baseline_cost_gbp"] == 7650.0
    assert row["cost_savings_pct"] == 34.97
    rounded = {c: round(row[c], 4) for c in ("accuracy", "balanced_accuracy", "precision", "recall", "f1_score")}
    assert rounded == {
        "accuracy": 0.4745,
        "balanced_accuracy": 0.6668,
        "precision": 0.0843,
        "recall": 0.8824,
        "f1_score": 0.1538,
    }


def test_no_predicted_positives(spark):
    matrix = spark.createDataFrame([(297, 0, 17, 0)], "tn bigint, fp bigint, fn bigint, tp bigint")
    row = evaluation.class_metrics(matrix).first()
    assert (row["precision"], row["recall"], row["f1_score"]) == (0.0, 0.0, 0.0)
    assert row["balanced_accuracy"] == 0.5


def test_governance_counts_by_the_unrounded_rate(spark):
    """A sensor with 50.004 % missing is quarantined for it and counted so, though its rate rounds to 50.00."""
    from fablens.operators import kpi, star

    stats = spark.createDataFrame(
        [(1, "a", 50.004, False, 1.0), (2, "b", 50.0, False, 1.0), (3, "c", 0.0, True, 1.0), (4, "d", 100.0, True, None)],
        "sensor_id int, sensor_code string, missing_rate double, is_constant boolean, mean double",
    ).withColumns({c: F.lit(1.0) for c in ("std", "min", "max")})
    sensors = star.dim_sensor(stats)
    row = kpi.sensor_governance_summary(sensors).first()
    assert (row["high_missing_sensors"], row["constant_sensors"], row["quarantined_sensors"], row["candidate_features_for_ml"]) == (2, 2, 3, 1)
    assert kpi.sensor_governance_status(sensors).first()["severe_missing_gt_50pct"] == 2
