"""Exact attribution of tree models: how far each sensor moves a lot's score.

A fitted forest or boosted model is compiled to a path table, one row per leaf: for every sensor that the path tests the interval that leads
to the leaf, and the share of training weight that takes this way when the sensor is unknown. The
score with only the sensors of a set S known is then a sum over leaves of value * product over sensors of (in the interval: 1 or 0) for
known and (share) for unknown ones, and Shapley values are sums over leaves, too. With o the 0/1 and z the share of a sensor,

    phi_j = sum over leaves of value * (o_j - z_j) * integral over t in [0, 1] of product over g <> j of (t o_g + (1 - t) z_g)

The integrand is a polynomial of one degree less than the path has sensors, so Gauss-Legendre nodes give it exactly. All of it is
built-in arithmetic: a lot meets the leaves inside its row, and only one row per lot and sensor is shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fablens.operators.attribution import linear_shap
from fablens.sources.shared import materialize, new_path

NODE = "tree int, id int, prediction double, stats array<double>, gain double, left int, right int, sensor int, threshold double"
PATH = "tree int, value double, steps array<struct<sensor:int,low:double,high:double,share:double>>"
#: Models with more nodes are refused: the path table is built in the driver and sent to every task.
MOST_NODES = 2_000_000


def model_nodes(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """The nodes of all trees, from the model's own files."""
    path = new_path(spark, "tree-model")
    model.write().save(path)
    [stage] = [s for s in model.stages if hasattr(s, "trees")]
    place = f"{path}/stages/{len(model.stages) - 1}_{stage.uid}"
    data = spark.read.parquet(f"{place}/data")
    node = F.col("nodeData")
    return data.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["prediction"].alias("prediction"),
        node["impurityStats"].alias("stats"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("sensor"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
    )


def _leaves(nodes: dict, classifier: bool, scale: float) -> list[tuple]:
    """(value, steps) of a tree's leaves; the steps of one sensor are merged to an interval."""
    weigh = (lambda n: sum(n["stats"])) if classifier else (lambda n: n["stats"][0])
    out, work = [], [(0, {})]
    while work:
        at, steps = work.pop()
        node = nodes[at]
        if node["left"] < 0:
            share = node["stats"][1] / sum(node["stats"]) if classifier else node["prediction"]
            out.append((scale * share, [(s + 1, *v) for s, v in sorted(steps.items())]))
            continue
        sensor, total = node["sensor"], weigh(node)
        low, high, share = steps.get(sensor, (float("-inf"), float("inf"), 1.0))
        left, right = weigh(nodes[node["left"]]) / total, weigh(nodes[node["right"]]) / total
        work.append((node["left"], {**steps, sensor: (low, min(high, node["threshold"]), share * left)}))
        work.append((node["right"], {**steps, sensor: (max(low, node["threshold"]), high, share * right)}))
    return out


def path_table(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """One row per leaf: its ``tree``, ``value`` and ``steps`` (sensor, interval (low, high], share), written once.

    Values add up over the trees to the forest's defect probability, or to the boosted model's margin: half its log odds. The table has at
    most trees * 2^depth rows, which the model's own parameters bound; a larger model than ``MOST_NODES`` raises.
    """
    kind = type(model.stages[-1]).__name__
    classifier = kind.startswith("RandomForest")
    if not classifier and not kind.startswith("GBT"):
        raise ValueError(f"{kind} is no tree ensemble")
    held = materialize(model_nodes(model, spark), "tree-nodes")
    if held.count() > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes")
    trees: dict[int, dict] = {}
    for row in held.toLocalIterator():
        trees.setdefault(row["tree"], {})[row["id"]] = row
    weight = [1 / len(trees)] * len(trees) if classifier else model.stages[-1].treeWeights
    rows = [(tree, value, steps) for tree, nodes in sorted(trees.items()) for value, steps in _leaves(nodes, classifier, weight[tree])]
    return materialize(spark.createDataFrame(rows, PATH), "tree-paths")


def tree_margin(model: PipelineModel, lots: DataFrame) -> DataFrame:
    """``production_id`` and ``margin``, the score that attributions add up to (with ``base_value``)."""
    from fablens.operators.models import _features

    scored = model.transform(_features(lots))
    if type(model.stages[-1]).__name__.startswith("RandomForest"):
        return scored.select("production_id", vector_to_array("probability")[1].alias("margin"))
    return scored.select("production_id", vector_to_array("rawPrediction")[1].alias("margin"))


def base_value(paths: DataFrame) -> Column:
    """The score when nothing is known, as a scalar subquery."""
    share = F.aggregate("steps", F.lit(1.0), lambda a, s: a * s["share"])
    return paths.agg(F.coalesce(F.sum(F.col("value") * share), F.lit(0.0))).scalar()


def tree_shap(vectors: DataFrame, paths: DataFrame) -> DataFrame:
    """``production_id``, ``sensor_id`` (position in ``values``) and ``shap`` for every sensor that some tree tests.

    A missing reading lies in no interval. Leaves are dealt to as many columns as the longest path has sensors; what is unused has
    the whole line as its interval and share 1, and adds nothing.
    """
    longest = paths.agg(F.max(F.size("steps"))).first()[0] or 0
    if not longest:
        return vectors.select("production_id", F.lit(0).alias("sensor_id"), F.lit(0.0).alias("shap")).limit(0)
    at, weight = np.polynomial.legendre.leggauss((longest + 1) // 2)
    at, weight = ((at + 1) / 2).tolist(), (weight / 2).tolist()
    slots = [F.get("steps", F.lit(i)) for i in range(longest)]
    fields = [F.struct(F.coalesce(s["sensor"], F.lit(0)).alias("n"), s["low"].alias("a"), s["high"].alias("b"), s["share"].alias("z")).alias(f"s{i}") for i, s in enumerate(slots)]
    leaves = paths.agg(F.collect_list(F.struct("value", *fields))).scalar()
    met = vectors.select("production_id", "values", F.explode(leaves).alias("_leaf"))

    def known(slot: Column) -> Column:
        x = F.get("values", slot["n"] - 1)
        inside = F.coalesce((x > slot["a"]) & (x <= slot["b"]), F.lit(False))
        return F.when((slot["n"] == 0) | inside, 1.0).otherwise(0.0)

    met = met.select("production_id", F.col("_leaf.value").alias("_v"), *[c for i in range(longest) for c in (
        F.col(f"_leaf.s{i}.n").alias(f"_n{i}"), known(F.col(f"_leaf.s{i}")).alias(f"_o{i}"), F.coalesce(f"_leaf.s{i}.z", F.lit(1.0)).alias(f"_z{i}"))])
    factor = lambda i, t: F.lit(t) * F.col(f"_o{i}") + F.lit(1 - t) * F.col(f"_z{i}")
    whole = {}
    for m, t in enumerate(at):
        product = factor(0, t)
        for i in range(1, longest):
            product = product * factor(i, t)
        whole[f"_r{m}"] = product
    met = met.withColumns(whole)

    def moved(i: int) -> Column:
        total = F.lit(0.0)
        for m, (t, w) in enumerate(zip(at, weight)):
            total = total + F.lit(w) * F.col(f"_r{m}") / factor(i, t)
        return F.col("_v") * (F.col(f"_o{i}") - F.col(f"_z{i}")) * total

    parts = met.select("production_id", F.inline(F.array(*[F.struct(F.col(f"_n{i}").alias("sensor_id"), moved(i).alias("shap")) for i in range(longest)])))
    return parts.where("sensor_id > 0").groupBy("production_id", "sensor_id").agg(F.sum("shap").alias("shap"))


def explain_model(model: PipelineModel, lots: DataFrame) -> tuple[DataFrame, Column | float]:
    """(attributions of ``lots``, base value) of a fitted candidate, whichever it is: they add up to its margin.

    A logistic model's base is its margin at the training means.
    """
    last = model.stages[-1]
    if hasattr(last, "trees"):
        paths = path_table(model, lots.sparkSession)
        return tree_shap(lots, paths), base_value(paths)
    scaler = model.stages[0]
    slopes = [w / d if d > 0 else 0.0 for w, d in zip(last.coefficients.toArray().tolist(), scaler.std.toArray().tolist())]
    weights, means = (F.array(*[F.lit(float(v)) for v in c]) for c in (slopes, scaler.mean.toArray()))
    return linear_shap(lots, weights, means), float(last.intercept)


def alerts_with_drivers(alerts: DataFrame, shap: DataFrame, n: int = 3) -> DataFrame:
    """Alerts with their ``drivers``: the n strongest sensors and how far each moves the score; empty where nothing is explained."""
    entry = F.struct("driver_rank", "sensor_id", "shap")
    drivers = top_drivers(shap, n).groupBy("production_id").agg(F.array_sort(F.collect_list(entry)).alias("drivers"))
    none = F.array().cast("array<struct<driver_rank:int,sensor_id:int,shap:double>>")
    return alerts.join(drivers, "production_id", "left").withColumn("drivers", F.coalesce("drivers", none))


def top_drivers(shap: DataFrame, n: int = 3) -> DataFrame:
    """The n strongest sensors of every lot: ``production_id``, ``driver_rank``, ``sensor_id``, ``shap``; ties by sensor.

    Folded per lot before the shuffle: a lot's sensors meet in one row, as many as the model tests.
    """
    entry = F.struct((-F.abs("shap")).alias("order"), "sensor_id", "shap")
    best = shap.groupBy("production_id").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, n).alias("d"))
    return best.select("production_id", F.posexplode("d").alias("_pos", "d")).select(
        "production_id", (F.col("_pos") + 1).alias("driver_rank"), "d.sensor_id", "d.shap"
    )
