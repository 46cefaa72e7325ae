"""Results that grow with new data instead of being redone, and estimates without bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens.functions import calendar as C
from fablens.operators import neighbours, profile_states, selection, star
from fablens.plans import checks as Q
from fablens.plans.ranking import imputed_readings
from fablens.plans.registry import query
from fablens.plans.warehouse import masked, masked_stats
from fablens.sources import telemetry
from fablens.sources.shared import materialize, new_path


def daily_readings(spark, folder):
    """Masked readings with the day of their unit."""
    vectors = masked(spark, folder)
    return telemetry.to_readings(vectors.withColumn("run_date", C.run_date(F.col("event_ts"))), "run_date")


def grown_states(spark, folder):
    """All days but the last at once, then the last one by itself."""
    readings = daily_readings(spark, folder)
    last = readings.agg(F.max("run_date")).first()[0]
    path = new_path(spark, "profile-states")
    profile_states.store_states(profile_states.profile_states(readings.where(F.col("run_date") < F.lit(last))), path)
    return profile_states.store_states(profile_states.profile_states(readings.where(F.col("run_date") == F.lit(last))), path)


@query(
    "incremental_profile",
    f"""WITH {Q.STATS} SELECT sensor_id, sensor_code, n_rows AS rows, missing_count, round(missing_rate, 6) AS missing_rate,
        is_constant, round(mean, 9) AS mean, round(std, 9) AS std, lo AS min, hi AS max, TRUE AS unique_fine, TRUE AS median_fine FROM stats""",
)
def incremental_profile(spark, folder):
    """A profile merged from daily states equals that of all readings; sketches keep their error."""
    profile = materialize(profile_states.states_profile(profile_states.merge_states(grown_states(spark, folder))), "merged-profile")
    exact = masked_stats(spark, folder, exact_unique=True).select("sensor_id", F.col("unique_count").alias("exact"))
    estimates = profile.select("sensor_id", "median_estimate")
    placed = daily_readings(spark, folder).where("value is not null").join(estimates, "sensor_id").groupBy("sensor_id").agg(
        F.avg((F.col("value") < F.col("median_estimate")).cast("int")).alias("below"),
        F.avg((F.col("value") <= F.col("median_estimate")).cast("int")).alias("upto"),
    )
    error = profile_states.RANK_ERROR
    fine = (F.col("below") <= 0.5 + error) & (F.col("upto") >= 0.5 - error)
    gap = F.abs(F.col("unique_count") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * profile_states.DISTINCT_ERROR)
    return profile.join(exact, "sensor_id").join(placed, "sensor_id", "left").select(
        "sensor_id", "sensor_code", "rows", "missing_count", F.round("missing_rate", 6).alias("missing_rate"), "is_constant",
        F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"), "min", "max",
        gap.alias("unique_fine"), F.coalesce(fine, F.lit(True)).alias("median_fine"),
    )


NEIGHBOURS = f"""{Q.IMPUTED}, points AS (
  SELECT production_id, sensor_id, y, value AS x, count(*) OVER (PARTITION BY sensor_id, y) AS of_label FROM imputed), reach AS (
  SELECT a.sensor_id, a.production_id, any_value(a.x) AS x, any_value(a.of_label) AS of_label, least(any_value(a.of_label) - 1, 3) AS k,
         list_sort(list(abs(a.x - b.x)))[least(any_value(a.of_label) - 1, 3)] AS radius
  FROM points a JOIN points b ON a.sensor_id = b.sensor_id AND a.y = b.y AND a.production_id <> b.production_id
  GROUP BY a.sensor_id, a.production_id), inside AS (
  SELECT r.sensor_id, r.production_id, any_value(r.k) AS k, any_value(r.of_label) AS of_label, count(*) AS m
  FROM reach r JOIN points p ON p.sensor_id = r.sensor_id AND p.of_label > 1
    AND p.x BETWEEN r.x - r.radius * (1 - 1e-9) AND r.x + r.radius * (1 - 1e-9)
  GROUP BY r.sensor_id, r.production_id), psi AS (
  SELECT n, -0.5772156649015329 + coalesce(sum(CAST(1 AS DOUBLE) / (n - 1)) FILTER (WHERE n > 1) OVER (ORDER BY n), 0) AS psi
  FROM range(1, (SELECT count(*) + 2 FROM embeddings)) t(n)), near AS (
  SELECT sensor_id, greatest(any_value(total.psi) + avg(k.psi - l.psi - m.psi), 0) AS mutual_info
  FROM (SELECT *, count(*) OVER (PARTITION BY sensor_id) AS n FROM inside) i
  JOIN psi k ON k.n = i.k JOIN psi l ON l.n = i.of_label JOIN psi m ON m.n = i.m JOIN psi total ON total.n = i.n GROUP BY sensor_id)"""


@query("neighbour_information", f"WITH {NEIGHBOURS} SELECT sensor_id, round(mutual_info, 6) AS mutual_info FROM near")
def neighbour_information(spark, folder):
    """The published estimator: three nearest neighbours, no bins."""
    return neighbours.neighbour_information(imputed_readings(spark, folder)).withColumn("mutual_info", F.round("mutual_info", 6))


@query(
    "neighbour_ranking",
    f"""WITH {NEIGHBOURS}, separation AS (
      SELECT sensor_id, CASE WHEN stddev_samp(value) > 0 THEN
             abs(avg(value) FILTER (WHERE y = 1) - avg(value) FILTER (WHERE y = 0)) / stddev_samp(value)
             ELSE 0 END AS separation FROM imputed GROUP BY sensor_id), sensor_state AS (
      SELECT sensor_id FROM readings GROUP BY sensor_id HAVING count(value) * 2 >= count(*) AND count(DISTINCT value) > 1)
      SELECT sensor_id, round(separation / max(separation) OVER () * 0.7 +
               mutual_info / CASE WHEN max(mutual_info) OVER () > 0 THEN max(mutual_info) OVER () ELSE 1 END * 0.3, 6) AS composite_score
      FROM separation JOIN near USING (sensor_id) JOIN sensor_state USING (sensor_id)""",
)
def neighbour_ranking(spark, folder):
    """The blend of separation and neighbour information over the candidate sensors."""
    readings = materialize(imputed_readings(spark, folder), "imputed")
    both = selection.separation_score(readings).join(neighbours.neighbour_information(readings), "sensor_id")
    candidates = star.candidate_sensors(star.dim_sensor(masked_stats(spark, folder))).select("sensor_id")
    ranked = selection.composite_rank(both.join(candidates, "sensor_id"), importance="separation")
    return ranked.select("sensor_id", F.round("composite_score", 6).alias("composite_score"))
