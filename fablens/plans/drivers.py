"""Attribution of tree models and of whichever champion wins."""

from __future__ import annotations

from itertools import combinations
from math import factorial

from pyspark.sql import functions as F

from fablens import constants as K
from fablens.operators import dispatch, evaluation, models, tree_attribution
from fablens.plans.learned import HELD_OUT, training_sets
from fablens.plans.registry import query
from fablens.sources import bindings as B
from fablens.sources.shared import materialize

# A given tree: sensor 1 first, then sensor 2 on its upper and sensor 3 on its lower side.
CUTS, VALUES = (0.0, 0.05, -0.05), (0.8, 0.3, 0.4, 0.1)


def _given_tree_check() -> str:
    def score(known):
        p = [f"CAST(x{j} > {CUTS[j - 1]} AS INT)" if j in known else f"n{j}" for j in (1, 2, 3)]
        a, b, c, d = VALUES
        return f"({p[0]} * ({p[1]} * {a} + (1 - {p[1]}) * {b}) + (1 - {p[0]}) * ({p[2]} * {c} + (1 - {p[2]}) * {d}))"

    def shapley(j):
        others = [i for i in (1, 2, 3) if i != j]
        sets = [s for n in range(3) for s in combinations(others, n)]
        return " + ".join(f"CAST({factorial(len(s)) * factorial(2 - len(s))} AS DOUBLE) / 6 * ({score((*s, j))} - {score(s)})" for s in sets)

    parts = " UNION ALL ".join(f"SELECT production_id, {j} AS sensor_id, round({shapley(j)}, 9) AS shap FROM met" for j in (1, 2, 3))
    return f"""WITH x AS (
      SELECT vec_id AS production_id, {", ".join(f"CAST(embedding[{j}] AS DOUBLE) AS x{j}" for j in (1, 2, 3))} FROM embeddings), met AS (
      SELECT x.*, s.* FROM x CROSS JOIN (
        SELECT avg(CAST(x1 > {CUTS[0]} AS INT)) AS n1, avg(CAST(x2 > {CUTS[1]} AS INT)) FILTER (WHERE x1 > {CUTS[0]}) AS n2,
               avg(CAST(x3 > {CUTS[2]} AS INT)) FILTER (WHERE x1 <= {CUTS[0]}) AS n3 FROM x) s)
      SELECT production_id, CAST(sensor_id AS INT) AS sensor_id, shap FROM ({parts})"""


@query("tree_shap", _given_tree_check())
def tree_shap(spark, folder):
    """Shapley values of a given tree whose shares come from the data; the check adds up all subsets."""
    vectors = B.vectors(B.table(spark, folder, "embeddings")).select("production_id", "values")
    above = [F.get("values", F.lit(j)) > CUTS[j] for j in range(3)]
    share = lambda up, where: F.avg(F.when(where, up.cast("int")))
    shares = vectors.agg(share(above[0], F.lit(True)).alias("n1"), share(above[1], above[0]).alias("n2"), share(above[2], ~above[0]).alias("n3"))

    def step(sensor, up):
        low, high = (F.lit(CUTS[sensor - 1]), F.lit(float("inf"))) if up else (F.lit(float("-inf")), F.lit(CUTS[sensor - 1]))
        part = F.col(f"n{sensor}") if up else 1 - F.col(f"n{sensor}")
        return F.struct(F.lit(sensor).alias("sensor"), low.alias("low"), high.alias("high"), part.alias("share"))

    leaves = [(VALUES[0], (1, True), (2, True)), (VALUES[1], (1, True), (2, False)), (VALUES[2], (1, False), (3, True)), (VALUES[3], (1, False), (3, False))]
    rows = F.array(*[F.struct(F.lit(0).alias("tree"), F.lit(v).alias("value"), F.array(*[step(*s) for s in path]).alias("steps")) for v, *path in leaves])
    paths = materialize(shares.select(F.inline(rows)), "tree-paths")
    return tree_attribution.tree_shap(vectors, paths).withColumn("shap", F.round("shap", 9))


def adds_up(model, lots):
    """Per unit: whether the attributions and the base value give the model's own margin."""
    shap, base = tree_attribution.explain_model(model, lots)
    total = shap.groupBy("production_id").agg(F.sum("shap").alias("total"))
    joined = tree_attribution.tree_margin(model, lots).join(total, "production_id", "left")
    gap = F.coalesce("total", F.lit(0.0)) + base - F.col("margin")
    return joined.select("production_id", (F.abs(gap) < 1e-9).alias("adds_up"))


ADDS_UP = f"WITH {HELD_OUT} SELECT production_id, TRUE AS adds_up FROM held_out"


@query("explain_boosted", ADDS_UP)
def explain_boosted(spark, folder):
    train, test, _ = training_sets(spark, folder)
    return adds_up(models.train_gbt(train, 20), test)


@query("explain_forest", ADDS_UP)
def explain_forest(spark, folder):
    train, test, _ = training_sets(spark, folder)
    return adds_up(models.train_random_forest(train, 20), test)


@query(
    "champion_drivers",
    f"""WITH {HELD_OUT} SELECT production_id, CASE WHEN y = 1 THEN 'DEFECT' ELSE 'CONFORMING' END AS actual_quality,
        TRUE AS explained, TRUE AS ordered FROM held_out""",
)
def champion_drivers(spark, folder):
    """Alerts of the cheapest of three small candidates, a tree model among them or not, each with its three strongest sensors."""
    train, test, sensors = training_sets(spark, folder)
    fitted = {models.LOGISTIC: models.train_logistic(train), models.FOREST: models.train_random_forest(train, 10, 5), models.BOOSTED: models.train_gbt(train, 10)}
    scored = {name: models.score_lots(model, test) for name, model in fitted.items()}
    parts = [models.as_scored(name, frame) for name, frame in scored.items()]
    board = evaluation.model_leaderboard(materialize(parts[0].union(parts[1]).union(parts[2]), "scored"))
    best = evaluation.champion(board).select("model", "optimal_threshold").first()
    alerts = dispatch.operational_alerts(dispatch.route_lots(scored[best["model"]], best["optimal_threshold"]))
    shap, _ = tree_attribution.explain_model(fitted[best["model"]], test)
    out = tree_attribution.alerts_with_drivers(alerts, shap)
    sizes = F.transform("drivers", lambda d: F.abs(d["shap"]))
    ordered = sizes == F.sort_array(sizes, asc=False)
    known = F.forall("drivers", lambda d: d["sensor_id"].between(1, len(sensors)))
    tier = F.col("risk_tier").isin(K.TIER_1, K.TIER_2, K.TIER_3)
    return out.select("production_id", "actual_quality", ((F.size("drivers") == 3) & known & tier).alias("explained"), ordered.alias("ordered"))
