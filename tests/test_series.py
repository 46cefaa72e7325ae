import statistics
from datetime import date, timedelta

import pytest

from fablens.operators import forecast, series, supply

DAY = date(2024, 3, 1)


def daily(spark, counts, tool=None):
    """Series from {day offset: defects}."""
    rows = [(tool or 1, DAY + timedelta(days=d), 10, n, 100.0 - 10 * n, 450.0 * n) for d, n in counts.items()]
    schema = "tool bigint, run_date date, total_runs bigint, defect_runs bigint, yield_rate_pct double, total_scrap_cost_gbp double"
    return spark.createDataFrame(rows, schema)


def test_gaps_are_filled(spark):
    dense = series.calendar_densify(daily(spark, {0: 1, 3: 2, 4: 3}).drop("tool")).orderBy("run_date").collect()
    assert [r["defect_runs"] for r in dense] == [1, 0, 0, 2, 3]
    assert [r["yield_rate_pct"] for r in dense] == [90.0, 0.0, 0.0, 80.0, 70.0]


def test_idle_yield_may_stay_null(spark):
    dense = series.calendar_densify(daily(spark, {0: 1, 2: 2}).drop("tool"), fill_yield=False).orderBy("run_date").collect()
    assert [r["yield_rate_pct"] for r in dense] == [90.0, None, 80.0]
    assert [r["total_runs"] for r in dense] == [10, 0, 10]


def test_groups_have_their_own_calendar(spark):
    both = daily(spark, {0: 1, 2: 1}, tool=1).union(daily(spark, {5: 1, 9: 1}, tool=2))
    counts = {r["tool"]: r["count"] for r in series.calendar_densify(both, ["tool"]).groupBy("tool").count().collect()}
    assert counts == {1: 3, 2: 5}


def test_first_day_features(spark):
    first = series.forecast_features(daily(spark, {0: 4, 1: 6}).drop("tool")).orderBy("run_date").first()
    assert (first["defect_runs_lag1"], first["defect_runs_lag7"]) == (0, 0)
    assert (first["defect_runs_roll7_mean"], first["defect_runs_roll7_std"]) == (4.0, 0.0)


def test_rolling_window_is_seven_rows(spark):
    values = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3]
    rows = series.forecast_features(daily(spark, dict(enumerate(values))).drop("tool")).orderBy("run_date").collect()
    assert rows[9]["defect_runs_roll7_mean"] == pytest.approx(statistics.mean(values[3:10]))
    assert rows[9]["defect_runs_roll7_std"] == pytest.approx(statistics.stdev(values[3:10]))
    assert rows[9]["defect_runs_lag7"] == values[2]
    past = series.rolling_features(daily(spark, dict(enumerate(values))).drop("tool"), exclude_current=True)
    last = past.orderBy("run_date").collect()[9]
    assert last["defect_runs_roll7_mean"] == pytest.approx(statistics.mean(values[2:9]))


def test_holdout_is_the_last_days(spark):
    marked = series.holdout_tail(daily(spark, {i: 1 for i in range(20)}).drop("tool"), 14)
    assert marked.where("is_holdout").count() == 14
    assert marked.where("is_holdout").agg({"run_date": "min"}).first()[0] == DAY + timedelta(days=6)


def test_forecast_report_uses_the_unrounded_prediction(spark):
    rows = spark.createDataFrame([(DAY, 3, 2.26)], "run_date date, defect_runs bigint, predicted double")
    row = forecast.forecast_table(rows).first()
    assert (row["forecast_date"], row["predicted_defects"], row["predicted_scrap_exposure_gbp"]) == ("2024-03-01", 2.3, 1017.0)


def test_forecast_error(spark):
    rows = spark.createDataFrame([(1, 2.0), (5, 2.0)], "defect_runs bigint, predicted double")
    row = forecast.forecast_error(rows).first()
    assert row["mae"] == 2.0 and row["rmse"] == pytest.approx(5.0**0.5)


def test_published_safety_stock(spark):
    """Yield 93.36 %, deviation 2.5 %: 1,072 starts, 235 buffer units, GBP 28,200."""
    stats = spark.createDataFrame([("line", 0.9336, 0.025)], "line string, base_yield double, yield_std double")
    row = supply.plan_from_yield(stats, ["line"]).first()
    assert row["planned_wafer_starts"] == 1072
    assert row["dynamic_safety_buffer"] == 235
    assert row["total_material_order"] == 1307
    assert row["cost_of_buffer_gbp"] == 28200.0
    assert (row["service_level_target"], row["base_yield_rate_pct"]) == ("98.0%", "93.36%")


def test_group_without_good_units(spark):
    rows = spark.createDataFrame([("a", 5, 5), ("a", 3, 3)], "g string, units bigint, defects bigint")
    row = supply.safety_stock_plan(rows, ["g"]).first()
    assert row["planned_wafer_starts"] is None and row["dynamic_safety_buffer"] == 0
