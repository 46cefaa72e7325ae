"""Scalars, star schema, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens import constants as K
from fablens.functions import calendar as C
from fablens.functions import numbers as N
from fablens.operators import kpi, profiling, star
from fablens.plans import checks as Q
from fablens.plans.registry import query
from fablens.sources import bindings as B
from fablens.sources import sinks, telemetry
from fablens.sources.shared import materialize, new_name, new_path


def units(spark, folder):
    return B.units(B.table(spark, folder, "events"))


def outcomes(spark, folder, *keep):
    return star.outcomes(units(spark, folder), K.SCRAP_COST, *keep)


def masked(spark, folder):
    return B.vectors(B.table(spark, folder, "embeddings"), masked=True)


def masked_stats(spark, folder, exact_unique=False):
    return profiling.sensor_stats(telemetry.to_readings(masked(spark, folder)), exact_unique=exact_unique)


@query(
    "parse_ts_mixed",
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END
       AS parsed FROM events""",
)
def parse_ts_mixed(spark, folder):
    ts = F.col("ts")
    text = (
        F.when(F.col("event_id") % 3 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_id") % 3 == 1, F.date_format(ts, "dd/MM/yyyy HH:mm:ss"))
        .otherwise(F.date_format(ts, "dd/MM/yyyy HH:mm"))
    )
    return B.table(spark, folder, "events").select("event_id", C.parse_ts_mixed(text).alias("parsed"))


@query("assign_shift", f"WITH {Q.UNITS}, {Q.PRODUCTION} SELECT production_id, run_hour, shift_code FROM production")
def assign_shift(spark, folder):
    ts = F.col("event_ts")
    return units(spark, folder).select(
        "production_id", C.run_hour(ts).alias("run_hour"), C.assign_shift(ts).alias("shift_code")
    )


@query(
    "day_of_week",
    """SELECT CAST(o_orderdate AS DATE) AS run_date, count(*) AS orders,
              CAST(isodow(o_orderdate) - 1 AS INT) AS day_of_week, CAST(isoyear(o_orderdate) AS INT) AS iso_year,
              CAST(week(o_orderdate) AS INT) AS week_of_year FROM orders GROUP BY ALL""",
)
def day_of_week(spark, folder):
    day = F.col("run_date")
    days = B.table(spark, folder, "orders").groupBy(C.run_date(F.col("o_orderdate")).alias("run_date"))
    return days.agg(F.count("*").alias("orders")).select(
        "*",
        C.day_of_week(day).alias("day_of_week"),
        C.iso_year(day).cast("int").alias("iso_year"),
        C.week_of_year(day).alias("week_of_year"),
    )


@query(
    "format_code",
    """SELECT event_id, printf('LOT_%04d', event_id) AS lot_id, printf('sensor_%03d', user_id) AS sensor_alias
       FROM events""",
)
def format_code(spark, folder):
    return B.table(spark, folder, "events").select(
        "event_id",
        N.lot_code(F.col("event_id")).alias("lot_id"),
        N.sensor_alias(F.col("user_id")).alias("sensor_alias"),
    )


@query(
    "safe_divide",
    """SELECT l_suppkey, coalesce(count(*) FILTER (WHERE l_tax > 0.07) / nullif(count(*) FILTER (WHERE l_discount > 0.09), 0), 0)
       AS ratio FROM lineitem GROUP BY l_suppkey""",
)
def safe_divide(spark, folder):
    sums = B.table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        N.count_where(F.col("l_tax") > 0.07).alias("a"), N.count_where(F.col("l_discount") > 0.09).alias("b")
    )
    return sums.select("l_suppkey", N.safe_divide(F.col("a"), F.col("b")).alias("ratio"))


@query("dim_production_entity", f"WITH {Q.UNITS}, {Q.PRODUCTION} SELECT * FROM production")
def dim_production_entity(spark, folder):
    return star.dim_production_entity(units(spark, folder))


@query("fact_quality_outcome", f"WITH {Q.UNITS}, {Q.QUALITY} SELECT * FROM quality")
def fact_quality_outcome(spark, folder):
    return star.fact_quality_outcome(units(spark, folder))


@query("star_join", f"WITH {Q.STAR} SELECT * FROM star")
def star_join(spark, folder):
    u = units(spark, folder)
    return star.star_join(star.dim_production_entity(u), star.fact_quality_outcome(u))


@query("star_join_bucketed", f"WITH {Q.STAR} SELECT * FROM star")
def star_join_bucketed(spark, folder):
    """Both tables bucketed by their key once; the join then moves no row."""
    u = units(spark, folder)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sides = [
        sinks.write_bucketed(
            table, new_name(spark, name), "production_id", buckets, new_path(spark, f"bucketed-{name}")
        )
        for name, table in (("production", star.dim_production_entity(u)), ("quality", star.fact_quality_outcome(u)))
    ]
    return star.star_join(*sides)


@query("star_outcomes", f"WITH {Q.STAR} SELECT * FROM star")
def star_outcomes(spark, folder):
    return outcomes(spark, folder)


@query("dim_sensor", f"WITH {Q.SENSOR} SELECT * FROM sensor")
def dim_sensor(spark, folder):
    return star.dim_sensor(masked_stats(spark, folder))


@query(
    "staging_payload",
    f"""WITH {Q.readings()} SELECT production_id, CASE WHEN y = 1 THEN 1 ELSE -1 END AS quality_label,
        'Attribute ' || sensor_id AS sensor_code, value FROM readings WHERE value IS NOT NULL""",
)
def staging_payload(spark, folder):
    """Every key and value of the payloads."""
    staged = telemetry.staging_payload(masked(spark, folder))
    return telemetry.read_payload(staged, "sensor_data", "production_id", "quality_label")


@query(
    "staging_raw",
    f"""WITH {Q.readings()} SELECT production_id, CASE WHEN y = 1 THEN 1 ELSE -1 END AS quality_label,
        TIMESTAMP '2008-07-19 11:55:00' + production_id * INTERVAL 1 HOUR AS event_timestamp,
        'line_gateway' AS data_source, TRUE AS stamped, 'Attribute ' || sensor_id AS sensor_code, value
        FROM readings WHERE value IS NOT NULL""",
)
def staging_raw(spark, folder):
    raw = star.staging_raw(telemetry.staging_payload(masked(spark, folder)), "line_gateway")
    stamped = raw.withColumn("stamped", F.col("ingested_at").isNotNull())
    keep = ("production_id", "quality_label", "event_timestamp", "data_source", "stamped")
    return telemetry.read_payload(stamped, "sensor_data", *keep)


@query(
    "read_payload",
    """SELECT event_id AS production_id, 'k' AS sensor_code, CAST(json_extract(props, '$.k') AS DOUBLE) AS value
       FROM events""",
)
def read_payload(spark, folder):
    events = B.table(spark, folder, "events").withColumnRenamed("event_id", "production_id")
    return telemetry.read_payload(events, "props", "production_id")


@query("candidate_sensors", f"WITH {Q.SENSOR} SELECT sensor_id, sensor_code FROM sensor WHERE NOT is_quarantined")
def candidate_sensors(spark, folder):
    return star.candidate_sensors(star.dim_sensor(masked_stats(spark, folder)))


@query(
    "candidate_set_difference",
    f"""WITH {Q.STATS} SELECT sensor_code FROM stats EXCEPT
        (SELECT sensor_code FROM stats WHERE missing_rate > 50 UNION SELECT sensor_code FROM stats WHERE is_constant)""",
)
def candidate_set_difference(spark, folder):
    stats = materialize(masked_stats(spark, folder), "sensor-stats")
    high = profiling.profile_high_missing(stats).select(F.col("column").alias("sensor_code"))
    constant = profiling.profile_constant(stats).select(F.col("column").alias("sensor_code"))
    return star.set_difference(stats.select("sensor_code"), constant, high)


@query(
    "integrity_checks",
    f"""WITH {Q.UNITS}, {Q.PRODUCTION}, {Q.QUALITY}, {Q.SENSOR}
        SELECT 'production_pk' AS "check", (SELECT count(*) FROM (SELECT 1 FROM production GROUP BY production_id HAVING count(*) > 1)) AS violations
        UNION ALL SELECT 'quality_pk', (SELECT count(*) FROM (SELECT 1 FROM quality GROUP BY production_id HAVING count(*) > 1))
        UNION ALL SELECT 'sensor_code_unique', (SELECT count(*) FROM (SELECT 1 FROM sensor GROUP BY sensor_code HAVING count(*) > 1))
        UNION ALL SELECT 'quality_production_fk', (SELECT count(*) FROM quality ANTI JOIN production USING (production_id))
        UNION ALL SELECT 'production_not_null_production_id', (SELECT count(*) FROM production WHERE production_id IS NULL)
        UNION ALL SELECT 'production_not_null_run_timestamp', (SELECT count(*) FROM production WHERE run_timestamp IS NULL)
        UNION ALL SELECT 'quality_not_null_raw_label', (SELECT count(*) FROM quality WHERE raw_label IS NULL)
        UNION ALL SELECT 'quality_not_null_is_defect', (SELECT count(*) FROM quality WHERE is_defect IS NULL)
        UNION ALL SELECT 'sensor_not_null_sensor_code', (SELECT count(*) FROM sensor WHERE sensor_code IS NULL)
        UNION ALL SELECT 'sensor_not_null_missing_rate_pct', (SELECT count(*) FROM sensor WHERE missing_rate_pct IS NULL)""",
)
def integrity_checks(spark, folder):
    u = units(spark, folder)
    sensors = star.dim_sensor(masked_stats(spark, folder))
    return star.integrity_checks(star.dim_production_entity(u), star.fact_quality_outcome(u), sensors)


@query(
    "repeated_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def repeated_keys(spark, folder):
    return star.repeated_keys(B.table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "orphans",
    """SELECT l_orderkey AS key, count(*) AS rows FROM lineitem
       ANTI JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') o ON l_orderkey = o_orderkey GROUP BY l_orderkey""",
)
def orphans(spark, folder):
    open_orders = B.table(spark, folder, "orders").where("o_orderstatus <> 'F'")
    return star.orphans(B.table(spark, folder, "lineitem"), "l_orderkey", open_orders, "o_orderkey")


def _write_wide(spark, folder):
    """Masked sensor arrays as a wide CSV pair in id order: telemetry without ids, and labels."""
    vectors = masked(spark, folder).repartitionByRange("production_id").sortWithinPartitions("production_id")
    width = telemetry.vector_width(vectors)
    ts = F.when(F.col("production_id") % 2 == 0, F.date_format("event_ts", "dd/MM/yyyy HH:mm:ss")).otherwise(
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss")
    )
    wide = vectors.select(
        ts.alias("timestamp"), *[F.get("values", F.lit(i)).alias(f"Attribute {i + 1}") for i in range(width)]
    )
    features, labels = new_path(spark, "features"), new_path(spark, "labels")
    sinks.write_report(wide, features)
    sinks.write_report(vectors.select(F.col("raw_label").alias("class")), labels)
    return features, labels


@query(
    "read_telemetry",
    f"""WITH {Q.readings()} SELECT row_number() OVER (ORDER BY production_id) AS production_id,
        CASE WHEN max(y) = 1 THEN 1 ELSE -1 END AS raw_label,
        TIMESTAMP '2008-07-19 11:55:00' + production_id * INTERVAL 1 HOUR AS event_ts,
        count(value) AS readings, round(sum(value), 6) AS total FROM readings GROUP BY readings.production_id""",
)
def read_telemetry(spark, folder):
    features_path, labels_path = _write_wide(spark, folder)
    features = telemetry.read_telemetry(spark, features_path)
    labels = telemetry.read_telemetry(spark, labels_path, ts=None)
    sensors = telemetry.sensor_columns(features)
    wide = telemetry.attach_labels(features, labels).withColumn("event_ts", C.parse_ts_mixed(F.col("timestamp")))
    vectors = telemetry.to_vectors(wide, sensors, ["production_id", "raw_label", "event_ts"])
    present = F.filter("values", lambda v: v.isNotNull())
    return vectors.select(
        "production_id",
        "raw_label",
        "event_ts",
        F.size(present).cast("bigint").alias("readings"),
        F.round(F.aggregate(present, F.lit(0.0), lambda t, v: t + v), 6).alias("total"),
    )


@query(
    "split_target",
    """SELECT 'label' AS part, label AS value, count(*) AS rows, 'label' AS columns FROM embeddings GROUP BY label
       UNION ALL SELECT 'vec_id', vec_id, count(*), 'vec_id,embedding' FROM embeddings GROUP BY vec_id""",
)
def split_target(spark, folder):
    """Rows of both parts, and their columns."""
    features, target = telemetry.split_target(B.table(spark, folder, "embeddings"), "label")

    def counted(part, key):
        rows = part.groupBy(F.col(key).cast("bigint").alias("value")).agg(F.count("*").alias("rows"))
        return rows.select(F.lit(key).alias("part"), "value", "rows", F.lit(",".join(part.columns)).alias("columns"))

    return counted(target, "label").union(counted(features, "vec_id"))


@query(
    "write_table",
    f"""WITH {Q.STAR} SELECT run_date, {Q.TOTAL} AS units, {Q.DEFECTS} AS defects,
        sum(estimated_scrap_cost) AS scrap_cost FROM star GROUP BY run_date""",
)
def write_table(spark, folder):
    """A daily cell table, one partition per day; the second write replaces one day only."""
    cells = kpi.outcome_cells(outcomes(spark, folder), "run_date")
    path = new_path(spark, "daily-cells")
    written = sinks.write_table(cells, path, partition_by=["run_date"])
    first_day = written.agg(F.min("run_date")).scalar()
    return sinks.write_table(cells.where(F.col("run_date") == first_day), path, partition_by=["run_date"])


SHIFT_CHECK = f"""WITH {Q.STAR} SELECT shift_code, {Q.TOTAL} AS total_runs, {Q.DEFECTS} AS defective_units,
    {Q.DEFECT_PCT} AS defect_rate_pct, {Q.YIELD_PCT} AS yield_rate_pct,
    sum(estimated_scrap_cost) AS total_scrap_cost_gbp FROM star GROUP BY shift_code"""


@query("write_report", SHIFT_CHECK)
def write_report(spark, folder):
    report = kpi.shift_defect_comparison(kpi.outcome_cells(outcomes(spark, folder), "shift_code"))
    return sinks.write_report(report, new_path(spark, "shift-report"))


@query("scan_sql", SHIFT_CHECK)
def scan_sql(spark, folder):
    """The shift report as SQL text over the two star tables."""
    u = units(spark, folder)
    text = """
        WITH shifts AS (
          SELECT shift_code, count(*) AS total_runs, count_if(is_defect) AS defective_units,
                 sum(estimated_scrap_cost) AS total_scrap_cost_gbp
          FROM {production} JOIN {quality} USING (production_id)
          GROUP BY shift_code)
        SELECT shift_code, total_runs, defective_units, total_scrap_cost_gbp,
               round(double(defective_units) / total_runs * 100, 2) AS defect_rate_pct,
               round(double(total_runs - defective_units) / total_runs * 100, 2) AS yield_rate_pct
        FROM shifts ORDER BY defect_rate_pct DESC, shift_code"""
    return sinks.scan_sql(
        spark, text, production=star.dim_production_entity(u), quality=star.fact_quality_outcome(u)
    )


def quality_summary_frame(spark, folder):
    vectors = masked(spark, folder)
    return profiling.quality_summary(
        masked_stats(spark, folder),
        vectors.select("event_ts", "raw_label"),
        profiling.profile_duplicates(vectors.select("event_ts", "values")),
        "SENSOR_ARRAYS",
    )


SUMMARY = f"""{Q.STATS}, figures AS (
  SELECT 'SENSOR_ARRAYS' AS dataset, (SELECT count(*) FROM embeddings) AS n_rows,
         (SELECT count(*) FROM stats) + 1 AS features,
         (SELECT count(*) - count(DISTINCT (vec_id, embedding)) FROM embeddings) AS duplicate_rows,
         (SELECT round(CAST(sum(missing_count) AS DOUBLE) / CAST(sum(n_rows) AS DOUBLE) * 100, 2) FROM stats) AS missing_value_rate_pct,
         (SELECT count(*) FROM stats WHERE missing_rate > 50) AS columns_gt_50_pct_missing,
         (SELECT count(*) FROM stats WHERE is_constant) AS constant_columns,
         (SELECT count(*) FROM embeddings WHERE label <> 0) AS pass_observations,
         (SELECT count(*) FROM embeddings WHERE label = 0) AS fail_observations,
         (SELECT round(CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) / count(*) * 100, 2) FROM embeddings) AS failure_rate_pct,
         (SELECT TIMESTAMP '2008-07-19 11:55:00' + min(vec_id) * INTERVAL 1 HOUR FROM embeddings) AS timestamp_start,
         (SELECT TIMESTAMP '2008-07-19 11:55:00' + max(vec_id) * INTERVAL 1 HOUR FROM embeddings) AS timestamp_end), summary AS (
  SELECT *, CASE WHEN columns_gt_50_pct_missing > 0 OR constant_columns > 0 OR failure_rate_pct < 10
            THEN 'WARNING' ELSE 'PASS' END AS quality_status FROM figures)"""


@query("quality_summary", f'WITH {SUMMARY} SELECT * RENAME (n_rows AS "rows") FROM summary')
def quality_summary(spark, folder):
    return quality_summary_frame(spark, folder)


@query("summary_json", f'WITH {SUMMARY} SELECT * RENAME (n_rows AS "rows") FROM summary')
def summary_json(spark, folder):
    summary = quality_summary_frame(spark, folder)
    path = new_path(spark, "summary")
    sinks.write_summary(summary, path)
    return sinks.read_summary(spark, path, summary.schema)


@query(
    "audit_append",
    f"""WITH {SUMMARY} SELECT b || ':' || dataset AS log_id, b AS batch_run_id, dataset AS dataset_name,
        n_rows AS total_records, features AS total_features, duplicate_rows, missing_value_rate_pct AS overall_missing_pct,
        columns_gt_50_pct_missing AS high_missing_cols_count, constant_columns AS constant_cols_count,
        pass_observations AS pass_count, fail_observations AS fail_count, quality_status
        FROM summary, (VALUES ('BATCH_001'), ('BATCH_002')) v(b)""",
)
def audit_append(spark, folder):
    summary = materialize(quality_summary_frame(spark, folder), "summary")
    path = new_path(spark, "audit")
    sinks.audit_append(summary, "BATCH_001", path)
    return sinks.audit_append(summary, "BATCH_002", path).drop("check_timestamp", "notes")
