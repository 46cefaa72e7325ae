"""SQL fragments that the checks share: the model's tables over the driver tables."""

from fablens import constants as K

UNITS = """units AS (
  SELECT event_id AS production_id, ts AS event_ts, user_id AS tool,
         CASE WHEN event_type = 'error' THEN 1 ELSE -1 END AS raw_label
  FROM events)"""

PRODUCTION = """production AS (
  SELECT production_id, event_ts AS run_timestamp, CAST(event_ts AS DATE) AS run_date,
         CAST(hour(event_ts) AS INT) AS run_hour,
         CASE WHEN hour(event_ts) BETWEEN 6 AND 13 THEN 'DAY_SHIFT'
              WHEN hour(event_ts) BETWEEN 14 AND 21 THEN 'EVENING_SHIFT'
              ELSE 'NIGHT_SHIFT' END AS shift_code,
         dayname(event_ts) AS day_name, CAST(week(event_ts) AS INT) AS week_of_year,
         monthname(event_ts) AS month_name
  FROM units)"""

QUALITY = """quality AS (
  SELECT production_id, raw_label, raw_label = 1 AS is_defect,
         CASE WHEN raw_label = 1 THEN 'NON_CONFORMING' ELSE 'CONFORMING' END AS defect_classification,
         CASE WHEN raw_label = 1 THEN CAST(450 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS estimated_scrap_cost,
         raw_label = 1 AS reinspection_flag
  FROM units)"""

STAR = f"""{UNITS}, {PRODUCTION}, {QUALITY}, star AS (
  SELECT p.*, q.* EXCLUDE (production_id) FROM production p JOIN quality q USING (production_id))"""

# Measures of one group of the star, in the double form that both engines round alike.
TOTAL = "count(*)"
DEFECTS = "count(*) FILTER (WHERE is_defect)"
GOOD = "count(*) FILTER (WHERE NOT is_defect)"
DEFECT_PCT = f"round(CAST({DEFECTS} AS DOUBLE) / {TOTAL} * 100, 2)"
YIELD_PCT = f"round(CAST({GOOD} AS DOUBLE) / {TOTAL} * 100, 2)"

VALUE_MASKED = """CASE WHEN i % 16 = 3 AND vec_id % 10 < 6 THEN NULL
              WHEN i % 16 = 5 THEN CAST(1 AS DOUBLE)
              ELSE CAST(embedding[i + 1] AS DOUBLE) END"""


def readings(masked: bool = True, gappy: bool = False) -> str:
    value = VALUE_MASKED if masked else "CAST(embedding[i + 1] AS DOUBLE)"
    if gappy:
        value = f"""CASE WHEN vec_id % 20 = 7 AND i % 5 < 2 OR vec_id % 20 = 8 AND i % 5 = 1 THEN NULL ELSE {value} END"""
    return f"""readings AS (
  SELECT vec_id AS production_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y,
         CAST(i + 1 AS INT) AS sensor_id, {value} AS value
  FROM (SELECT *, unnest(range(len(embedding))) AS i FROM embeddings))"""


STATS = f"""{readings()}, stats AS (
  SELECT sensor_id, 'Attribute ' || sensor_id AS sensor_code, count(*) AS n_rows,
         count(*) - count(value) AS missing_count,
         CAST(count(*) - count(value) AS DOUBLE) / count(*) * 100 AS missing_rate,
         count(DISTINCT value) AS unique_count, count(DISTINCT value) <= 1 AS is_constant,
         avg(value) AS mean, stddev_samp(value) AS std, min(value) AS lo, max(value) AS hi
  FROM readings GROUP BY sensor_id)"""

SENSOR = f"""{STATS}, sensor AS (
  SELECT sensor_id, sensor_code, printf('sensor_%03d', sensor_id) AS sensor_alias,
         'INSPECTION_METRIC' AS category, is_constant, round(missing_rate, 2) AS missing_rate_pct,
         missing_rate > 50 OR is_constant AS is_quarantined,
         CASE WHEN missing_rate > 50 THEN 'HIGH_MISSING_RATE_GT_50_PCT'
              WHEN is_constant THEN 'ZERO_VARIANCE_CONSTANT_FEATURE' ELSE 'NONE' END AS quarantine_reason,
         round(mean, 4) AS mean_val, round(std, 4) AS std_val, round(lo, 4) AS min_val, round(hi, 4) AS max_val
  FROM stats)"""

# Training rows: the first 80 % by time, which for sensor arrays is the order of vec_id.
TRAIN = f"""{readings()}, placed AS (
  SELECT vec_id AS production_id,
         row_number() OVER (ORDER BY vec_id) <= floor(0.8 * count(*) OVER ()) AS is_train
  FROM embeddings), train AS (
  SELECT r.* FROM readings r JOIN placed USING (production_id) WHERE is_train)"""

MEDIANS = f"""{TRAIN}, medians AS (SELECT sensor_id, median(value) AS median FROM train GROUP BY sensor_id)"""

IMPUTED = f"""{MEDIANS}, imputed AS (
  SELECT production_id, y, sensor_id, coalesce(value, median) AS value
  FROM train JOIN medians USING (sensor_id))"""

MUTUAL = f"""{IMPUTED}, bounds AS (
  SELECT sensor_id, min(value) AS lo, max(value) AS hi FROM imputed GROUP BY sensor_id), binned AS (
  SELECT sensor_id, y, CASE WHEN hi = lo THEN 0
         ELSE least(CAST(floor((value - lo) / (hi - lo) * 10) AS INT), 9) END AS bin
  FROM imputed JOIN bounds USING (sensor_id)), cells AS (
  SELECT sensor_id, bin, y, CAST(count(*) AS DOUBLE) AS n FROM binned GROUP BY ALL), parts AS (
  SELECT *, sum(n) OVER (PARTITION BY sensor_id) AS t, sum(n) OVER (PARTITION BY sensor_id, bin) AS b,
         sum(n) OVER (PARTITION BY sensor_id, y) AS c FROM cells), mutual AS (
  SELECT sensor_id, greatest(sum(n / t * ln(n * t / (b * c))), 0) AS mutual_info FROM parts GROUP BY sensor_id)"""

RANKING = f"""{MUTUAL}, separation AS (
  SELECT sensor_id, CASE WHEN stddev_samp(value) > 0 THEN
         abs(avg(value) FILTER (WHERE y = 1) - avg(value) FILTER (WHERE y = 0)) / stddev_samp(value)
         ELSE 0 END AS separation FROM imputed GROUP BY sensor_id), sensor_state AS (
  SELECT sensor_id FROM readings GROUP BY sensor_id
  HAVING count(value) * 2 >= count(*) AND count(DISTINCT value) > 1), ranking AS (
  SELECT sensor_id, separation, mutual_info,
         separation / max(separation) OVER () * 0.7 + mutual_info / max(mutual_info) OVER () * 0.3
           AS composite_score
  FROM separation JOIN mutual USING (sensor_id) JOIN sensor_state USING (sensor_id))"""

SCORED_LINES = """scored AS (
  SELECT l_quantity / 50 AS p, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)"""

SCORED_MODELS = """scored AS (
  SELECT 'quantity' AS model, l_quantity / 50 AS p, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem
  UNION ALL SELECT 'discount', l_discount * 5, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END FROM lineitem
  UNION ALL SELECT 'tax', l_tax * 8, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END FROM lineitem
  UNION ALL SELECT 'none', CAST(0 AS DOUBLE), CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END FROM lineitem)"""

CURVE = """grid AS (SELECT CAST(i AS INT) AS slot, (2 + i) / CAST(100 AS DOUBLE) AS threshold FROM range(89) t(i)), curve AS (
  SELECT model, threshold,
         count(*) FILTER (WHERE y = 0 AND p < threshold) AS tn, count(*) FILTER (WHERE y = 0 AND p >= threshold) AS fp,
         count(*) FILTER (WHERE y = 1 AND p < threshold) AS fn, count(*) FILTER (WHERE y = 1 AND p >= threshold) AS tp
  FROM (SELECT model, p, y FROM scored) CROSS JOIN grid GROUP BY model, threshold), costed AS (
  SELECT *, fn * CAST(450 AS DOUBLE) + fp * CAST(25 AS DOUBLE) AS cost_gbp FROM curve)"""

RANK_METRICS = """per_score AS (
  SELECT model, p, CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS pos,
         CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) AS neg FROM scored GROUP BY model, p), ranked AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM per_score
  WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS UNBOUNDED PRECEDING)), areas AS (
  SELECT model, sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS roc_auc,
         sum(pos * tp / (tp + fp)) / sum(pos) AS pr_auc FROM ranked GROUP BY model)"""

SCORED_UNITS = """scored AS (
  SELECT event_id AS production_id, value / (value + 300) AS p,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y FROM events)"""

ROUTED = f"""{SCORED_UNITS}, routed AS (
  SELECT *, CASE WHEN p >= 0.14 THEN 'TIER_1_CRITICAL' WHEN p >= 0.08 THEN 'TIER_2_ELEVATED'
                 ELSE 'TIER_3_NOMINAL' END AS risk_tier,
         CASE WHEN p >= 0.14 THEN '{K.TIER_1_ACTION}' WHEN p >= 0.08 THEN '{K.TIER_2_ACTION}'
              ELSE '{K.TIER_3_ACTION}' END AS operational_action,
         CASE WHEN p >= 0.14 THEN 'URGENT' WHEN p >= 0.08 THEN 'MEDIUM' ELSE 'LOW' END AS alert_urgency
  FROM scored)"""

ALERTS = f"""{ROUTED}, alerts AS (
  SELECT production_id, printf('LOT_%04d', production_id) AS lot_id, round(p * 100, 2) AS failure_risk_pct,
         risk_tier, operational_action, alert_urgency,
         CASE WHEN y = 1 THEN 'DEFECT' ELSE 'CONFORMING' END AS actual_quality FROM routed)"""

DAILY = f"""{STAR}, daily AS (
  SELECT run_date, {TOTAL} AS total_runs, {DEFECTS} AS defect_runs, {YIELD_PCT} AS yield_rate_pct,
         sum(estimated_scrap_cost) AS total_scrap_cost_gbp FROM star GROUP BY run_date)"""

TOOL_DAILY = f"""{UNITS}, {QUALITY}, tool_daily AS (
  SELECT tool, CAST(event_ts AS DATE) AS run_date, {TOTAL} AS total_runs, {DEFECTS} AS defect_runs,
         {YIELD_PCT} AS yield_rate_pct, sum(estimated_scrap_cost) AS total_scrap_cost_gbp
  FROM units JOIN quality USING (production_id) GROUP BY tool, run_date), tool_dense AS (
  SELECT tool, CAST(d AS DATE) AS run_date FROM (
    SELECT tool, unnest(generate_series(min(run_date), max(run_date), INTERVAL 1 DAY)) AS d
    FROM tool_daily GROUP BY tool)), tool_filled AS (
  SELECT tool, run_date, coalesce(total_runs, 0) AS total_runs, coalesce(defect_runs, 0) AS defect_runs,
         coalesce(yield_rate_pct, 0) AS yield_rate_pct, coalesce(total_scrap_cost_gbp, 0) AS total_scrap_cost_gbp
  FROM tool_dense LEFT JOIN tool_daily USING (tool, run_date))"""


def features(source: str, partition: str = "") -> str:
    part = f"PARTITION BY {partition}" if partition else ""
    return f"""features AS (
  SELECT *, coalesce(lag(defect_runs, 1) OVER w, 0) AS defect_runs_lag1,
         coalesce(lag(defect_runs, 7) OVER w, 0) AS defect_runs_lag7,
         round(avg(defect_runs) OVER f, 6) AS defect_runs_roll7_mean,
         round(coalesce(stddev_samp(defect_runs) OVER f, 0), 6) AS defect_runs_roll7_std,
         CAST(isodow(run_date) - 1 AS INT) AS day_of_week
  FROM {source}
  WINDOW w AS ({part} ORDER BY run_date), f AS ({part} ORDER BY run_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


# Fixed weights for attribution checks: sensor j weighs ((j mod 7) - 3) / 10.
SHAP = f"""{readings(masked=False)}, means AS (
  SELECT sensor_id, avg(value) AS mean FROM readings GROUP BY sensor_id), shap AS (
  SELECT production_id, sensor_id, (value - mean) * (CAST(sensor_id % 7 - 3 AS DOUBLE) / 10) AS shap
  FROM readings JOIN means USING (sensor_id))"""

LINEAR_P = """(
  SELECT vec_id AS production_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y,
         1 / (1 + exp(-(sum(CAST(embedding[i + 1] AS DOUBLE) * CAST((i + 1) % 7 - 3 AS DOUBLE) / 10) - 2.2))) AS p
  FROM (SELECT *, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY vec_id, label)"""
