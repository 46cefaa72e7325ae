"""Rolling-origin evaluation: choices are made on validation rows, and the test rows are seen once.

The time line is cut at counted points into segments. Fold f trains on all segments before f and is judged on segment f; the
threshold and the champion come from those validation rows of all folds together; what comes after the last cut is the test, which only the
champion's final score meets.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fablens.operators import evaluation
from fablens.operators.split import Cut, chronological_cut, in_training
from fablens.sources.shared import materialize

RATIOS = (0.4, 0.5, 0.6, 0.7, 0.8)


def counted_cuts(df: DataFrame, ratios: tuple[float, ...] = RATIOS, ts: str = "event_ts", key: str = "production_id") -> list[Cut]:
    """Cut points at floor(ratio * n) rows in (timestamp, id) order, rising; counted on a written copy of the two columns."""
    if list(ratios) != sorted(set(ratios)) or not 0 < ratios[0] <= ratios[-1] < 1:
        raise ValueError("ratios must rise between 0 and 1")
    rows = materialize(df.select(ts, key), "time-line")
    return [chronological_cut(rows, ts, key, r) for r in ratios]


def segment(cuts: list[Cut], ts: str = "event_ts", key: str = "production_id") -> Column:
    """How many cuts a row lies behind: 0 is only trained on, 1 to n - 1 are validated in the fold of that number, n is the test.

    A row without a timestamp lies behind all cuts.
    """
    return sum((F.when(F.coalesce(in_training(c, ts, key), F.lit(False)), 0).otherwise(1) for c in cuts), F.lit(0))


def fold_summary(df: DataFrame, cuts: list[Cut], y: Column, ts: str = "event_ts", key: str = "production_id") -> DataFrame:
    """Per fold: ``train_rows``, ``train_defects``, ``rows`` and ``defects`` of the rows it is judged on; the last one is the test.

    One aggregate to a row per segment; the training rows are its running sums.
    """
    counts = df.groupBy(segment(cuts, ts, key).alias("fold")).agg(F.count("*").alias("rows"), F.sum(y).alias("defects"))
    packed = counts.agg(F.array_sort(F.collect_list(F.struct("fold", "rows", "defects"))).alias("_all"))
    rows = packed.select("_all", F.explode("_all").alias("_f"))
    before = F.filter("_all", lambda s: s["fold"] < F.col("_f.fold"))
    total = lambda field: F.aggregate(before, F.lit(0).cast("bigint"), lambda a, s: a + s[field])
    return rows.where("_f.fold > 0").select(
        F.col("_f.fold").alias("fold"), total("rows").alias("train_rows"), total("defects").alias("train_defects"),
        F.col("_f.rows").alias("rows"), F.col("_f.defects").alias("defects"), (F.col("_f.fold") == len(cuts)).alias("is_test"),
    )


def choose(validation: DataFrame) -> DataFrame:
    """Per model the cheapest threshold over the validation rows of all folds, its cost, and whether the model is the cheapest (ties: by name)."""
    best = evaluation.optimize_threshold(evaluation.threshold_curve(validation, ["model"]), ["model"])
    first = best.agg(F.min(F.struct("cost_gbp", "model"))["model"]).scalar()
    return best.select("model", "threshold", F.col("cost_gbp").alias("validation_cost_gbp"), (F.col("model") == first).alias("is_champion"))


def test_once(chosen: DataFrame, test: DataFrame) -> DataFrame:
    """The chosen models with their confusion counts and cost on the test rows, each at the threshold that validation gave it."""
    scores = evaluation.score_counts(test, ["model"]).join(chosen.select("model", "threshold"), "model")
    matrix = evaluation.confusion_at(scores, F.col("p") >= F.col("threshold"), ["model"])
    return chosen.join(evaluation.with_cost(matrix), "model")


def rolling_scores(df: DataFrame, cuts: list[Cut], fit: dict[str, Callable[[DataFrame], Callable[[DataFrame], DataFrame]]], ts: str = "event_ts", key: str = "production_id") -> DataFrame:
    """``model``, ``fold``, key, ``p`` and ``y`` of every validation row, scored by models that have seen earlier segments only.

    ``fit[name](train)`` returns a function that adds ``p`` to rows. Training rows are written per fold, as a learner reads them often.
    """
    marked = materialize(df.withColumn("fold", segment(cuts, ts, key)), "segments")
    parts = []
    for fold in range(1, len(cuts)):
        train = materialize(marked.where(F.col("fold") < fold).drop("fold"), f"fold-{fold}")
        rows = marked.where(F.col("fold") == fold)
        parts += [learn(train)(rows).select(F.lit(name).alias("model"), "fold", key, "p", "y") for name, learn in fit.items()]
    return materialize(reduce(DataFrame.unionByName, parts), "validation-scores")


def rolling_study(df: DataFrame, cuts: list[Cut], fit: dict, ts: str = "event_ts", key: str = "production_id") -> tuple[DataFrame, DataFrame]:
    """(choice per model, the champion's test result): threshold and champion from the folds, one refit before the test, one look at it."""
    chosen = materialize(choose(rolling_scores(df, cuts, fit, ts, key)), "chosen")
    name = chosen.where("is_champion").first()["model"]
    place = segment(cuts, ts, key)
    train = materialize(df.where(place < len(cuts)), "before-test")
    test = fit[name](train)(df.where(place == len(cuts))).select(F.lit(name).alias("model"), key, "p", "y")
    return chosen, test_once(chosen.where("is_champion"), materialize(test, "test-scores"))
