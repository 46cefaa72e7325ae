import random

import pytest
from pyspark.sql import functions as F

from fablens.operators import dispatch, evaluation
from fablens.operators.ranked import running_totals


def scored(spark, rows):
    return spark.createDataFrame(rows, "p double, y int").repartition(5)


def auc(rows):
    pos = [p for p, y in rows if y == 1]
    neg = [p for p, y in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def average_precision(rows):
    total, seen_pos, seen = 0.0, 0, 0
    n_pos = sum(y for _, y in rows)
    for p in sorted({p for p, _ in rows}, reverse=True):
        here = [y for q, y in rows if q == p]
        seen += len(here)
        seen_pos += sum(here)
        total += sum(here) / n_pos * seen_pos / seen
    return total


CASES = {
    "continuous": lambda r, i: r.random(),
    "ties": lambda r, i: r.randrange(10) / 10,
    "one score holds a third": lambda r, i: 0.2 if i % 3 == 0 else r.random(),
    "crowded": lambda r, i: 0.05 + r.random() * 1e-7,
}


@pytest.mark.parametrize("case", CASES)
def test_rank_metrics_equal_brute_force(spark, case):
    r = random.Random(case)
    rows = [(CASES[case](r, i), int(r.random() < 0.2)) for i in range(900)]
    row = evaluation.rank_metrics(evaluation.score_curve(evaluation.score_counts(scored(spark, rows)))).first()
    assert row["roc_auc"] == pytest.approx(auc(rows), abs=1e-12)
    assert row["pr_auc"] == pytest.approx(average_precision(rows), abs=1e-12)


def test_one_class_has_no_auc(spark):
    row = evaluation.rank_metrics(evaluation.score_curve(evaluation.score_counts(scored(spark, [(0.1, 0), (0.2, 0)])))).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None


def brute_curve(rows):
    out = []
    for i in range(89):
        t = (2 + i) / 100.0
        tp = sum(1 for p, y in rows if y == 1 and p >= t)
        fp = sum(1 for p, y in rows if y == 0 and p >= t)
        fn = sum(y for _, y in rows) - tp
        tn = len(rows) - tp - fp - fn
        out.append((t, tn, fp, fn, tp, fn * 450.0 + fp * 25.0))
    return out


def test_curve_equals_brute_force_and_lowest_threshold_wins(spark):
    r = random.Random(9)
    rows = [(r.choice([r.random(), r.randrange(100) / 100]), int(r.random() < 0.1)) for _ in range(400)]
    curve = evaluation.threshold_curve(scored(spark, rows))
    folded = evaluation.threshold_curve(evaluation.score_counts(scored(spark, rows)))
    assert sorted(map(tuple, curve.collect())) == sorted(map(tuple, folded.collect()))
    got = [tuple(x) for x in curve.select("threshold", "tn", "fp", "fn", "tp", "cost_gbp").orderBy("threshold").collect()]
    assert got == brute_curve(rows)
    best = evaluation.optimize_threshold(curve).first()
    assert (best["cost_gbp"], best["threshold"]) == min((c[5], c[0]) for c in got)


def test_tied_costs(spark):
    best = evaluation.optimize_threshold(evaluation.threshold_curve(evaluation.score_counts(scored(spark, [(0.6, 1), (0.3, 0)])))).first()
    assert best["threshold"] == 0.31 and best["cost_gbp"] == 0.0


def test_scores_below_the_grid_count(spark):
    curve = evaluation.threshold_curve(evaluation.score_counts(scored(spark, [(0.0, 1), (0.01, 0)])))
    assert curve.count() == 89
    assert {(r["fn"], r["tn"], r["tp"], r["fp"]) for r in curve.collect()} == {(1, 1, 0, 0)}


def test_confusion_from_rows_and_counts_agree(spark):
    rows = scored(spark, [(0.14, 1), (0.14, 0), (0.13, 1), (0.9, 0), (0.1, 0)])
    direct = evaluation.confusion_matrix(rows, 0.14).first()
    folded = evaluation.confusion_at(evaluation.score_counts(rows), F.col("p") >= 0.14).first()
    assert direct.asDict() == folded.asDict() == {"tn": 1, "fp": 2, "fn": 1, "tp": 1}


def test_running_totals_by_group(spark):
    r = random.Random(2)
    rows = [(g, float(v), r.randrange(5)) for g in ("a", "b", "c") for v in r.sample(range(10_000), 400 if g == "a" else 30)]
    df = spark.createDataFrame(rows, "g string, v double, n bigint")
    for descending in (False, True):
        got = {(x["g"], x["v"]): x["n_upto"] for x in running_totals(df, ["g"], "v", ["n"], descending).collect()}
        for g, v, _ in rows:
            inside = [n for h, w, n in rows if h == g and (w >= v if descending else w <= v)]
            assert got[g, v] == sum(inside)


def test_leaderboard_order_and_champion(spark):
    rows = [("bad", 0.9, 0), ("bad", 0.1, 1), ("good", 0.1, 0), ("good", 0.9, 1), ("also good", 0.2, 0), ("also good", 0.8, 1)]
    board = evaluation.model_leaderboard(spark.createDataFrame(rows, "model string, p double, y int"))
    assert [r["model"] for r in board.collect()] == ["also good", "good", "bad"]
    assert evaluation.champion(board).first()["model"] == "also good"


def test_champion_never_costs_more_than_flagging_none(spark):
    r = random.Random(4)
    rows = [("m", r.random() * 0.85, int(r.random() < 0.3)) for _ in range(300)]
    row = evaluation.model_leaderboard(spark.createDataFrame(rows, "model string, p double, y int")).first()
    assert row["optimal_cost_gbp"] <= 450.0 * (row["true_positives"] + row["false_negatives"])


def test_routing_bounds(spark):
    df = spark.createDataFrame([(1, 0.14, 1), (2, 0.08, 0), (3, 0.0799, 0), (4, 0.1399, 1)], "production_id bigint, p double, y int")
    tiers = {r["production_id"]: r["risk_tier"] for r in dispatch.route_lots(df, 0.14).collect()}
    assert tiers == {1: "TIER_1_CRITICAL", 2: "TIER_2_ELEVATED", 3: "TIER_3_NOMINAL", 4: "TIER_2_ELEVATED"}


def test_low_first_bound_leaves_tier_2_empty(spark):
    df = spark.createDataFrame([(i, i / 100, 0) for i in range(30)], "production_id bigint, p double, y int")
    tiers = {r["risk_tier"] for r in dispatch.route_lots(df, 0.05).collect()}
    assert tiers == {"TIER_1_CRITICAL", "TIER_3_NOMINAL"}


def test_unscored_rows_count_everywhere(spark):
    scored = spark.createDataFrame([(0.5, 1), (None, 0), (float("nan"), 1), (0.01, 0)], "p double, y int")
    matrix = evaluation.confusion_matrix(scored, 0.14).first().asDict()
    assert matrix == {"tn": 1, "fp": 1, "fn": 0, "tp": 2}
    for row in evaluation.threshold_curve(scored).collect():
        assert row["tn"] + row["fp"] + row["fn"] + row["tp"] == 4
        if round(row["threshold"], 2) == 0.14:
            assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 1, 0, 2)
    again = evaluation.confusion_matrix(evaluation.score_counts(scored), 0.14).first().asDict()
    assert again == matrix
