"""Rolling-origin folds and conformal bounds."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fablens.operators import forecast, rolling

RUNS = "production_id bigint, event_ts timestamp_ntz, y int, x double"


def runs(spark, n=200):
    r = np.random.default_rng(2)
    x = r.random(n)
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=i // 3), int(r.random() < x[i]), float(x[i])) for i in range(n)]
    return spark.createDataFrame(rows, RUNS), rows


def test_folds_see_earlier_rows_only(spark):
    df, rows = runs(spark)
    cuts = rolling.counted_cuts(df, (0.5, 0.6, 0.8))
    seen = []

    def learner(train):
        last = train.agg(F.max("event_ts"), F.max("production_id"), F.count("*")).first()
        seen.append((last[1], last[2]))
        return lambda lots: lots.withColumn("p", F.col("x"))

    scored = rolling.rolling_scores(df, cuts, {"a": learner}).collect()
    assert seen == [(99, 100), (119, 120)]
    assert sorted((r["production_id"], r["fold"]) for r in scored) == [(i, 1 if i < 120 else 2) for i in range(100, 160)]
    summary = {r["fold"]: r for r in rolling.fold_summary(df, cuts, F.col("y")).collect()}
    assert [(summary[f]["train_rows"], summary[f]["rows"], summary[f]["is_test"]) for f in (1, 2, 3)] == [(100, 20, False), (120, 40, False), (160, 40, True)]
    assert summary[3]["train_defects"] == sum(r[2] for r in rows[:160])


def cost(rows, t, p):
    return sum(450 for r in rows if r[2] and p(r) < t) + sum(25 for r in rows if not r[2] and p(r) >= t)


def test_the_test_rows_decide_nothing(spark):
    df, rows = runs(spark)
    scores = {"own": lambda r: r[3], "turned": lambda r: 1 - r[3]}
    fits = {"own": lambda _: lambda lots: lots.withColumn("p", F.col("x")), "turned": lambda _: lambda lots: lots.withColumn("p", 1 - F.col("x"))}
    cuts = rolling.counted_cuts(df, (0.5, 0.6, 0.8))
    chosen, tested = rolling.rolling_study(df, cuts, fits)
    grid = [(2 + i) / 100 for i in range(89)]
    valid, test = rows[100:160], rows[160:]
    want = {n: min((cost(valid, t, p), t) for t in grid) for n, p in scores.items()}
    found = {r["model"]: (r["validation_cost_gbp"], r["threshold"]) for r in chosen.collect()}
    assert found == want
    best = min(want, key=lambda n: (want[n][0], n))
    [row] = tested.collect()
    assert (row["model"], row["cost_gbp"]) == (best, cost(test, want[best][1], scores[best]))
    # Other outcomes in the test rows change its cost, never the choice.
    other = df.withColumn("y", F.when(F.col("production_id") >= 160, 1 - F.col("y")).otherwise(F.col("y")))
    again, _ = rolling.rolling_study(other, cuts, fits)
    assert {r["model"]: (r["validation_cost_gbp"], r["threshold"]) for r in again.collect()} == want


def test_ratios_must_rise(spark):
    for ratios in ((0.5, 0.5), (0.8, 0.4), (0.0, 0.5), (0.5, 1.0)):
        with pytest.raises(ValueError):
            rolling.counted_cuts(runs(spark)[0], ratios)


DAYS = "tool int, run_date date, defect_runs bigint, predicted double"


def test_conformal_bounds_cover(spark):
    """Skewed errors, 200 series: about 95 of 100 held-out days lie inside, where the normal rule would not promise it."""
    r = np.random.default_rng(4)
    rows = [(s, date(2024, 1, 1) + timedelta(days=d), int(10 + r.exponential(6)), 12.0) for s in range(200) for d in range(60)]
    df = spark.createDataFrame(rows, DAYS)
    late = F.col("run_date") >= F.lit(date(2024, 2, 10))
    bounds = forecast.conformal_bounds(df.where(~late), df.where(late), by=["tool"])
    joined = bounds.join(df.where(late).select("tool", "run_date", "defect_runs"), ["tool", "run_date"])
    covered = joined.agg(F.avg((F.col("defect_runs").between(F.col("lower"), F.col("upper"))).cast("int"))).first()[0]
    assert 0.94 < covered < 0.985
    assert {r["calibration_days"] for r in bounds.collect()} == {40}


def test_rank_and_odd_series(spark):
    start = date(2024, 1, 1)
    rows = [(1, start + timedelta(days=d), d + 1, 0.0) for d in range(19)]  # errors 1..19: the 19th is the bound
    rows += [(2, start + timedelta(days=d), 5, 4.0) for d in range(18)]  # one too few
    rows += [(3, start, None, 1.0)]
    new = [(t, date(2025, 1, 1), None, 3.0) for t in (1, 2, 3, 4)]
    found = forecast.conformal_bounds(spark.createDataFrame(rows, DAYS), spark.createDataFrame(new, DAYS), by=["tool"])
    got = {r["tool"]: (r["calibration_days"], r["lower"], r["upper"]) for r in found.collect()}
    assert got == {1: (19, 0.0, 22.0), 2: (18, None, None), 3: (0, None, None), 4: (0, None, None)}
    [whole] = forecast.conformal_bounds(spark.createDataFrame(rows[:19], DAYS), spark.createDataFrame(new[:1], DAYS)).collect()
    assert (whole["lower"], whole["upper"]) == (0.0, 22.0)
