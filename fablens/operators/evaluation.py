"""Cost-sensitive evaluation of risk scores.

Scored rows have columns p and y (0 or 1). Confusion counts and the threshold
curve fold them straight into a handful of groups. ROC-AUC and average
precision need every distinct score, so they start from ``score_counts``:
positives and negatives per model and score. Every function takes either form,
and all models at once. Rows without a score (NULL or NaN) count as flagged at every
threshold, as routing holds them, so that counts add up to the input rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fablens import constants as K
from fablens.functions import numbers as N
from fablens.operators.ranked import running_totals
from fablens.sources.shared import materialize


def _tallies(frame: DataFrame) -> tuple[Column, Column]:
    """Positives and negatives that a row stands for: one scored row, or a score's counts."""
    if "y" in frame.columns:
        return F.when(F.col("y") == 1, 1).otherwise(0), F.when(F.col("y") == 0, 1).otherwise(0)
    return F.col("pos"), F.col("neg")


def score_counts(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    pos, neg = _tallies(scored)
    # Unscored rows stand together above every score.
    p = F.when(N.is_unscored(F.col("p")), float("inf")).otherwise(F.col("p")).alias("p")
    return scored.groupBy(*(by or []), p).agg(F.sum(pos).alias("pos"), F.sum(neg).alias("neg"))


def confusion_at(scores: DataFrame, flagged: Column, by: list[str] | None = None) -> DataFrame:
    """tn, fp, fn, tp where ``flagged`` says which scores are predicted defects. One aggregate."""
    pos, neg = _tallies(scores)
    flagged = N.is_unscored(F.col("p")) | flagged

    def total(column: Column, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, column)), F.lit(0))

    return scores.groupBy(*(by or [])).agg(
        total(neg, ~flagged).alias("tn"),
        total(neg, flagged).alias("fp"),
        total(pos, ~flagged).alias("fn"),
        total(pos, flagged).alias("tp"),
    )


def confusion_matrix(scores: DataFrame, threshold: float, by: list[str] | None = None) -> DataFrame:
    return confusion_at(scores, F.col("p") >= threshold, by)


def with_cost(matrix: DataFrame, c_fn: float = K.SCRAP_COST, c_fp: float = K.INSPECTION_COST) -> DataFrame:
    return matrix.withColumn("cost_gbp", F.col("fn") * c_fn + F.col("fp") * c_fp)


def cost_of_quality(
    scored: DataFrame, threshold: float, c_fn: float = K.SCRAP_COST, c_fp: float = K.INSPECTION_COST
) -> DataFrame:
    return with_cost(confusion_matrix(scored, threshold), c_fn, c_fp)


def default_threshold_cost(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Cost of a classifier's own decision: the defect class must be the likelier one (p > 0.5)."""
    return with_cost(confusion_at(scored, F.col("p") > 0.5, by))


def threshold_curve(
    scores: DataFrame, by: list[str] | None = None, c_fn: float = K.SCRAP_COST, c_fp: float = K.INSPECTION_COST
) -> DataFrame:
    """Confusion counts and cost at every grid threshold, from one pass over the scores.

    Each score falls into the slot of the highest threshold it reaches; the
    89 thresholds are then running sums over at most 90 slots per model.
    """
    by = by or []
    pos, neg = _tallies(scores)
    slot = F.when(N.is_unscored(F.col("p")) | (F.col("p") > 1), K.GRID_STEPS - 1).otherwise(N.grid_index(F.col("p")))
    slots = scores.groupBy(*by, slot.alias("slot")).agg(
        F.sum(pos).alias("pos"), F.sum(neg).alias("neg")
    )
    # Scores below the grid (slot -1) count in the totals but make no threshold.
    packed = slots.groupBy(*by).agg(
        F.sum("pos").alias("all_pos"),
        F.sum("neg").alias("all_neg"),
        F.map_from_entries(F.collect_list(F.struct("slot", F.struct("pos", "neg")))).alias("at"),
    )
    grid = packed.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(K.GRID_STEPS - 1))))
    here = F.try_element_at("at", "slot")
    filled = grid.withColumns({c: F.coalesce(here[c], F.lit(0)) for c in ("pos", "neg")})
    at_or_above = Window.partitionBy(*by).orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, 0)
    tp, fp = F.sum("pos").over(at_or_above), F.sum("neg").over(at_or_above)
    curve = filled.select(*by, "slot", "all_pos", "all_neg", tp.alias("tp"), fp.alias("fp"))
    return with_cost(
        curve.select(
            *by,
            N.grid_threshold(F.col("slot")).alias("threshold"),
            (F.col("all_neg") - F.col("fp")).alias("tn"),
            "fp",
            (F.col("all_pos") - F.col("tp")).alias("fn"),
            "tp",
        ),
        c_fn,
        c_fp,
    )


def optimize_threshold(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Cheapest threshold; the lowest one wins a tie."""
    by = by or []
    best = F.min(F.struct("cost_gbp", "threshold", "tn", "fp", "fn", "tp")).alias("best")
    return curve.groupBy(*by).agg(best).select(*by, "best.*")


def class_metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy, balanced accuracy, precision, recall and F1; 0 where a denominator is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    recall = N.safe_divide(tp, tp + fn)
    specificity = N.safe_divide(tn, tn + fp)
    # A class that does not occur has no recall to average.
    balanced = (
        F.when(tp + fn == 0, specificity).when(tn + fp == 0, recall).otherwise((recall + specificity) / 2)
    )
    return matrix.withColumns(
        {
            "accuracy": N.safe_divide(tp + tn, tp + tn + fp + fn),
            "balanced_accuracy": balanced,
            "precision": N.safe_divide(tp, tp + fp),
            "recall": recall,
            "f1_score": N.safe_divide(tp * 2, tp * 2 + fp + fn),
        }
    )


def score_curve(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts at or above each distinct score, highest score first."""
    return running_totals(counts, by or [], "p", ["pos", "neg"], descending=True)


def rank_metrics(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """ROC-AUC (ties averaged) and step-wise average precision; NULL without both classes."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp, fp = F.col("pos_upto").cast("double"), F.col("neg_upto").cast("double")
    sums = curve.groupBy(*(by or [])).agg(
        F.sum(pos).alias("_p"),
        F.sum(neg).alias("_n"),
        # A negative loses to every positive scored above it and halves its ties.
        F.sum(neg * (tp - pos / 2)).alias("_wins"),
        F.sum(pos * tp / (tp + fp)).alias("_steps"),
    )
    return sums.select(
        *(by or []),
        F.try_divide("_wins", F.col("_p") * F.col("_n")).alias("roc_auc"),
        F.try_divide("_steps", F.col("_p")).alias("pr_auc"),
    )


def savings_vs_baseline(matrix: DataFrame, c_fn: float = K.SCRAP_COST) -> DataFrame:
    """Cost if nothing were flagged, and the share of it saved."""
    baseline = (F.col("tp") + F.col("fn")) * c_fn
    return matrix.withColumn("baseline_cost_gbp", baseline).withColumn(
        "cost_savings_pct", N.pct(F.col("baseline_cost_gbp") - F.col("cost_gbp"), F.col("baseline_cost_gbp"))
    )


def model_leaderboard(scored: DataFrame) -> DataFrame:
    """One row per model (columns model, p, y), cheapest first: row 1 is the champion."""
    by = ["model"]
    counts = materialize(score_counts(scored, by), "score-counts")
    best = savings_vs_baseline(class_metrics(optimize_threshold(threshold_curve(counts, by), by)))
    default = with_cost(confusion_at(counts, F.col("p") > 0.5, by)).select(
        "model", F.col("cost_gbp").alias("default_cost_gbp")
    )
    ranks = rank_metrics(score_curve(counts, by), by)
    rounded = [F.round(c, 4).alias(c) for c in ("accuracy", "balanced_accuracy", "precision", "recall", "f1_score")]
    return (
        best.join(default, "model")
        .join(ranks, "model")
        .select(
            "model",
            *rounded,
            F.round("roc_auc", 4).alias("roc_auc"),
            F.round("pr_auc", 4).alias("pr_auc"),
            F.round("threshold", 3).alias("optimal_threshold"),
            "default_cost_gbp",
            F.col("cost_gbp").alias("optimal_cost_gbp"),
            "cost_savings_pct",
            F.col("tp").alias("true_positives"),
            F.col("fn").alias("false_negatives"),
            F.col("fp").alias("false_positives"),
            F.col("tn").alias("true_negatives"),
        )
        .orderBy("optimal_cost_gbp", "model")
    )


def champion(leaderboard: DataFrame) -> DataFrame:
    """The cheapest model's row."""
    return leaderboard.orderBy("optimal_cost_gbp", "model").limit(1)
