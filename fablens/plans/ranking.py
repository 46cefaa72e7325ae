"""Split, imputation, feature ranking and attribution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens import constants as K
from fablens.operators import attribution, selection, split, star
from fablens.plans import checks as Q
from fablens.plans.registry import query
from fablens.plans.risk import fixed_weights, plain_vectors, width
from fablens.plans.warehouse import masked, masked_stats, units
from fablens.sources import bindings as B
from fablens.sources import telemetry
from fablens.sources.shared import literal_table, materialize


def split_vectors(spark, folder):
    return split.chronological_split(masked(spark, folder))


def train_medians(train):
    return selection.fit_medians(telemetry.to_readings(train))


def imputed_vectors(spark, folder):
    """Training and test arrays, both filled with the training medians; cut and medians are computed once."""
    train, test = split_vectors(spark, folder)
    medians, n = train_medians(train), width(spark, folder)
    return selection.impute_vectors(train, medians, n), selection.impute_vectors(test, medians, n)


def imputed_readings(spark, folder):
    return telemetry.to_readings(imputed_vectors(spark, folder)[0], "y")


def ranking(spark, folder, readings=None):
    readings = imputed_readings(spark, folder) if readings is None else readings
    both = selection.separation_score(readings).join(selection.mutual_information(readings), "sensor_id")
    candidates = star.candidate_sensors(star.dim_sensor(masked_stats(spark, folder)))
    return selection.composite_rank(both.join(candidates.select("sensor_id"), "sensor_id"), importance="separation")


PLACED = """placed AS (
  SELECT *, row_number() OVER (ORDER BY event_ts, production_id) <= floor(0.8 * count(*) OVER ()) AS is_train FROM units)"""


@query("chronological_split", f"WITH {Q.UNITS}, {PLACED} SELECT production_id, is_train FROM placed")
def chronological_split(spark, folder):
    runs = units(spark, folder)
    return runs.select("production_id", split.in_training(split.chronological_cut(runs)).alias("is_train"))


@query(
    "chronological_split_ties",
    """WITH placed AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(0.8 * count(*) OVER ()) AS is_train FROM orders)
       SELECT o_orderkey, is_train FROM placed""",
)
def chronological_split_ties(spark, folder):
    """Orders carry only a date, so the cut falls among ids of one day."""
    orders = B.table(spark, folder, "orders")
    cut = split.chronological_cut(orders, "o_orderdate", "o_orderkey")
    return orders.select("o_orderkey", split.in_training(cut, "o_orderdate", "o_orderkey").alias("is_train"))


@query(
    "split_summary",
    f"""WITH {Q.UNITS}, {PLACED} SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, count(*) AS rows,
        count(*) FILTER (WHERE raw_label = 1) AS defects,
        round(CAST(count(*) FILTER (WHERE raw_label = 1) AS DOUBLE) / count(*), 6) AS defect_rate FROM placed GROUP BY 1""",
)
def split_summary(spark, folder):
    runs = units(spark, folder)
    inside = split.in_training(split.chronological_cut(runs))
    return split.split_summary(runs, inside, F.when(F.col("raw_label") == 1, 1).otherwise(0))


@query("fit_medians", f"WITH {Q.MEDIANS} SELECT sensor_id, median FROM medians")
def fit_medians(spark, folder):
    train, _ = split_vectors(spark, folder)
    return train_medians(train)


@query(
    "fit_medians_by_tool",
    "SELECT user_id AS tool, median(value) AS median FROM events GROUP BY user_id",
)
def fit_medians_by_tool(spark, folder):
    readings = B.table(spark, folder, "events").select(F.col("user_id").alias("tool"), "value")
    return selection.fit_medians(readings, by="tool")


@query(
    "impute_median_train",
    f"""WITH {Q.MEDIANS} SELECT production_id, sensor_id, coalesce(value, median) AS value
        FROM readings JOIN medians USING (sensor_id)""",
)
def impute_median_train(spark, folder):
    vectors = masked(spark, folder)
    train, _ = split_vectors(spark, folder)
    readings = telemetry.to_readings(vectors)
    return selection.impute(readings, train_medians(train)).select("production_id", "sensor_id", "value")


@query(
    "mutual_information",
    f"WITH {Q.MUTUAL} SELECT sensor_id, round(mutual_info, 6) AS mutual_info FROM mutual",
)
def mutual_information(spark, folder):
    scores = selection.mutual_information(imputed_readings(spark, folder))
    return scores.select("sensor_id", F.round("mutual_info", 6).alias("mutual_info"))


@query(
    "composite_rank",
    f"""WITH {Q.RANKING} SELECT sensor_id, round(separation, 6) AS separation,
        round(mutual_info, 6) AS mutual_info, round(composite_score, 6) AS composite_score FROM ranking""",
)
def composite_rank(spark, folder):
    columns = ("separation", "mutual_info", "composite_score")
    return ranking(spark, folder).select("sensor_id", *[F.round(c, 6).alias(c) for c in columns])


@query(
    "rank_desc",
    f"""WITH {Q.RANKING} SELECT sensor_id, CAST(row_number() OVER (ORDER BY composite_score DESC, sensor_id) AS INT) AS rank
        FROM ranking""",
)
def rank_desc(spark, folder):
    return selection.rank_desc(ranking(spark, folder), "composite_score", "sensor_id").select("sensor_id", "rank")


@query(
    "select_top_k",
    f"""WITH {Q.RANKING} SELECT sensor_id, round(composite_score, 6) AS composite_score FROM ranking
        ORDER BY ranking.composite_score DESC, sensor_id LIMIT 50""",
)
def select_top_k(spark, folder):
    top = selection.select_top_k(ranking(spark, folder))
    return top.select("sensor_id", F.round("composite_score", 6).alias("composite_score"))


@query(
    "selected_readings",
    f"""WITH {Q.RANKING}, top AS (SELECT sensor_id FROM ranking ORDER BY composite_score DESC, sensor_id LIMIT 50)
        SELECT production_id, sensor_id, value FROM imputed JOIN top USING (sensor_id)""",
)
def selected_readings(spark, folder):
    """Training readings of the 50 selected sensors."""
    readings = materialize(imputed_readings(spark, folder), "imputed")
    selected = selection.select_top_k(ranking(spark, folder, readings))
    return selection.restrict(readings, selected).select("production_id", "sensor_id", "value")


TOP = f"""{Q.RANKING}, top AS (
  SELECT sensor_id, row_number() OVER (ORDER BY composite_score DESC, sensor_id) AS place FROM ranking
  QUALIFY place <= 50), filled AS (
  SELECT production_id, is_train, sensor_id, coalesce(value, median) AS value
  FROM readings JOIN medians USING (sensor_id) JOIN placed USING (production_id))"""


def _slots(n):
    return ", ".join(f"max(value) FILTER (WHERE place = {i}) AS f{i:02}" for i in range(1, n + 1))


def selected_sensors(spark, folder, readings):
    """The 50 selected sensors, best first: the feature is a top-k."""
    top = selection.select_top_k(ranking(spark, folder, readings)).select("sensor_id", "composite_score")
    return [r["sensor_id"] for r in top.orderBy(F.desc("composite_score"), "sensor_id").collect()]


def selected_matrices(spark, folder):
    """(train, test) matrices over the selected sensors, and the sensors."""
    train, test = imputed_vectors(spark, folder)
    readings = materialize(telemetry.to_readings(train, "y"), "imputed")
    chosen = selected_sensors(spark, folder, readings)
    sides = [selection.feature_matrix(side.select("production_id", "y", "values"), chosen) for side in (train, test)]
    return *sides, chosen


def ranked_columns(matrix, chosen, *keep):
    """Columns named by rank, so that the check can name them; NULL where there are fewer than 50 sensors."""
    ranked = [F.col(f"sensor_{s}").alias(f"f{i:02}") for i, s in enumerate(chosen, 1)]
    blank = [F.lit(None).cast("double").alias(f"f{i:02}") for i in range(len(chosen) + 1, 51)]
    return matrix.select(*keep, *ranked, *blank)


@query(
    "feature_matrix",
    f"""WITH {TOP} SELECT production_id, CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, {_slots(50)}
        FROM filled JOIN top USING (sensor_id) GROUP BY ALL""",
)
def feature_matrix(spark, folder):
    """The training and the test matrix of the 50 selected sensors."""
    train, test, chosen = selected_matrices(spark, folder)
    sides = [ranked_columns(m, chosen, "production_id", F.lit(n).alias("split")) for n, m in (("train", train), ("test", test))]
    return sides[0].union(sides[1])


@query(
    "selected_features",
    f"""WITH {TOP} SELECT CAST(place AS INT) AS rank, sensor_id, (SELECT count(*) FROM placed WHERE is_train) AS train_rows,
        (SELECT count(*) FROM placed WHERE NOT is_train) AS test_rows FROM top""",
)
def selected_features(spark, folder):
    """The record beside the matrices: the selected sensors and the rows of either side."""
    train, test, chosen = selected_matrices(spark, folder)
    rows = literal_table(spark, ["rank", "sensor_id"], list(enumerate(chosen, 1)))
    counted = [side.agg(F.count("*")).scalar() for side in (train, test)]
    return rows.select("rank", "sensor_id", counted[0].alias("train_rows"), counted[1].alias("test_rows"))


@query(
    "pivot_readings",
    f"""WITH {TOP} SELECT production_id, {_slots(50)} FROM filled JOIN top USING (sensor_id) WHERE is_train GROUP BY production_id""",
)
def pivot_readings(spark, folder):
    """The training matrix from long readings."""
    readings = materialize(imputed_readings(spark, folder), "imputed")
    chosen = selected_sensors(spark, folder, readings)
    return ranked_columns(selection.pivot_readings(readings, chosen), chosen, "production_id")


def shap_inputs(spark, folder):
    vectors, n = plain_vectors(spark, folder), width(spark, folder)
    return vectors, fixed_weights(n), selection.as_vector(attribution.fit_means(vectors), "mean", n)


def shap(spark, folder):
    return attribution.linear_shap(*shap_inputs(spark, folder))


@query("linear_shap", f"WITH {Q.SHAP} SELECT production_id, sensor_id, round(shap, 6) + 0 AS shap FROM shap")
def linear_shap(spark, folder):
    return shap(spark, folder).select("production_id", "sensor_id", (F.round("shap", 6) + 0).alias("shap"))


IMPORTANCE = f"""{Q.SHAP}, importance AS (
  SELECT sensor_id, 'Attribute ' || sensor_id AS sensor_code, round(avg(abs(shap)), 6) AS mean_abs_shap FROM shap
  GROUP BY sensor_id)"""


def importance(spark, folder):
    ranked = attribution.shap_importance(shap(spark, folder))
    return ranked.withColumn("mean_abs_shap", F.round("mean_abs_shap", 6))


@query("shap_importance", f"WITH {IMPORTANCE} SELECT * FROM importance")
def shap_importance(spark, folder):
    return importance(spark, folder)


@query(
    "action_playbook",
    f"""WITH {IMPORTANCE} SELECT *, CASE sensor_code
          {" ".join(f"WHEN '{code}' THEN '{action}'" for code, action in K.PLAYBOOK)}
          ELSE '{K.DEFAULT_ACTION}' END AS recommended_engineering_action
        FROM importance""",
)
def action_playbook(spark, folder):
    return attribution.action_playbook(importance(spark, folder), attribution.playbook(spark))


@query(
    "top_risk_drivers",
    f"WITH {IMPORTANCE} SELECT * FROM importance ORDER BY mean_abs_shap DESC, sensor_id LIMIT 15",
)
def top_risk_drivers(spark, folder):
    return attribution.top_risk_drivers(importance(spark, folder), 15)


@query(
    "lot_top_drivers",
    f"""WITH {Q.SHAP}, placed AS (
          SELECT *, row_number() OVER (PARTITION BY production_id ORDER BY abs(shap) DESC, sensor_id) AS place FROM shap)
        SELECT production_id, CAST(place AS INT) AS driver_rank, sensor_id, round(shap, 6) AS shap FROM placed WHERE place <= 3""",
)
def lot_top_drivers(spark, folder):
    drivers = attribution.lot_top_drivers(*shap_inputs(spark, folder))
    return drivers.withColumn("shap", F.round("shap", 6))
