"""Data-quality profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens.operators import profiling, star
from fablens.plans import checks as Q
from fablens.plans.registry import query
from fablens.plans.risk import GAPPY
from fablens.plans.warehouse import masked, masked_stats, units
from fablens.sources import bindings as B
from fablens.sources import telemetry


@query("profile_shape", "SELECT count(*) AS rows, 6 AS columns FROM events")
def profile_shape(spark, folder):
    return profiling.profile_shape(B.table(spark, folder, "events"))


@query(
    "profile_duplicates",
    """SELECT (SELECT count(*) FROM events) - (SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS duplicate_rows""",
)
def profile_duplicates(spark, folder):
    return profiling.profile_duplicates(B.table(spark, folder, "events"))


@query(
    "profile_duplicates_by_key",
    """SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem""",
)
def profile_duplicates_by_key(spark, folder):
    return profiling.profile_duplicates(B.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "profile_duplicates_wide",
    "SELECT 2 * count(*) - count(DISTINCT embedding) AS duplicate_rows FROM embeddings",
)
def profile_duplicates_wide(spark, folder):
    """One column per sensor, every row delivered twice."""
    once = B.table(spark, folder, "embeddings")
    width = telemetry.vector_width(once, "embedding")
    wide = once.union(once).select(*[F.get("embedding", F.lit(i)).alias(f"s{i}") for i in range(width)])
    return profiling.profile_duplicates(wide)


FINE = """SELECT (SELECT count(*) FROM events WHERE event_id % 2 = 1) AS duplicate_rows"""


def fine_differences(spark, folder, extra):
    """Every event twice: with the sign of a zero changed, and for even ids a microsecond later."""
    events = B.table(spark, folder, "events").select("event_id", "ts", *[F.col("value").alias(f"v{i}") for i in range(extra)])
    later = F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.expr("interval 1 microsecond")).otherwise(F.col("ts"))
    again = events.withColumn("ts", later).withColumn("zero", F.lit(-0.0))
    return events.withColumn("zero", F.lit(0.0)).unionByName(again)


@query("profile_duplicates_fine", FINE)
def profile_duplicates_fine(spark, folder):
    return profiling.profile_duplicates(fine_differences(spark, folder, 1))


@query("profile_duplicates_fine_wide", FINE)
def profile_duplicates_fine_wide(spark, folder):
    """The same in 43 columns: one rule at any width."""
    return profiling.profile_duplicates(fine_differences(spark, folder, 40))


@query(
    "profile_missing_total",
    f"""WITH {Q.STATS} SELECT CAST(sum(missing_count) AS BIGINT) AS missing_cells, CAST(sum(n_rows) AS BIGINT) AS total_cells,
        round(CAST(sum(missing_count) AS DOUBLE) / CAST(sum(n_rows) AS DOUBLE) * 100, 2) AS missing_rate_pct FROM stats""",
)
def profile_missing_total(spark, folder):
    return profiling.profile_missing_total(masked_stats(spark, folder))


MISSING = f"""WITH {Q.STATS} SELECT sensor_code AS "column", missing_count, round(missing_rate, 2) AS missing_pct
    FROM stats"""


@query("profile_missing_by_sensor", MISSING)
def profile_missing_by_sensor(spark, folder):
    return profiling.profile_missing_by_sensor(masked_stats(spark, folder))


@query("profile_high_missing", f"{MISSING} WHERE missing_rate > 50")
def profile_high_missing(spark, folder):
    return profiling.profile_high_missing(masked_stats(spark, folder))


@query(
    "profile_constant",
    f'WITH {Q.STATS} SELECT sensor_code AS "column", unique_count AS unique_values FROM stats WHERE is_constant',
)
def profile_constant(spark, folder):
    return profiling.profile_constant(masked_stats(spark, folder))


@query(
    "profile_columns",
    f"""WITH {Q.STATS} SELECT sensor_code AS "column", 'double' AS dtype, missing_count,
        round(missing_rate, 2) AS missing_pct, unique_count, is_constant, round(mean, 4) AS mean,
        round(std, 4) AS std, round(lo, 4) AS min, round(hi, 4) AS max FROM stats""",
)
def profile_columns(spark, folder):
    stats = masked_stats(spark, folder, exact_unique=True)
    arrays = masked(spark, folder)
    kind = arrays.schema["values"].dataType.elementType.simpleString()
    # Sensors are elements of one array column here, so all have its element type.
    return profiling.profile_columns(stats, stats.select("sensor_code").withColumn("dtype", F.lit(kind)))


@query(
    "profile_columns_table",
    """WITH r AS (SELECT 'l_linenumber' AS c, 'int' AS t, CAST(l_linenumber AS DOUBLE) AS v FROM lineitem
         UNION ALL SELECT 'l_quantity', 'double', l_quantity FROM lineitem
         UNION ALL SELECT 'l_orderkey', 'bigint', CAST(l_orderkey AS DOUBLE) FROM lineitem)
       SELECT c AS "column", t AS dtype, count(*) - count(v) AS missing_count, CAST(0 AS DOUBLE) AS missing_pct,
              count(DISTINCT v) AS unique_count, count(DISTINCT v) <= 1 AS is_constant, round(avg(v), 4) AS mean,
              round(stddev_samp(v), 4) AS std, round(min(v), 4) AS min, round(max(v), 4) AS max FROM r GROUP BY ALL""",
)
def profile_columns_table(spark, folder):
    """Columns of one table with their own data types."""
    lines = B.table(spark, folder, "lineitem")
    names = ["l_linenumber", "l_quantity", "l_orderkey"]
    catalog = telemetry.sensor_catalog(spark, names)
    cells = F.array(*[F.struct(F.lit(c).alias("sensor_code"), F.col(c).cast("double").alias("value")) for c in names])
    readings = lines.select(F.inline(cells))
    stats = profiling.sensor_stats(readings, catalog, lines, exact_unique=True)
    return profiling.profile_columns(stats, profiling.column_types(lines, names))


@query(
    "top_missing_k",
    f"""WITH {Q.STATS} SELECT sensor_code AS "column", missing_count FROM stats
        ORDER BY missing_count DESC, "column" LIMIT 20""",
)
def top_missing_k(spark, folder):
    return profiling.top_missing_k(masked_stats(spark, folder))


# Sensor names of the event payload, and one that never reports.
PAYLOAD_SENSORS = ["click", "error", "purchase", "signup", "view", "idle"]


@query(
    "profile_payload",
    """WITH catalog AS (SELECT CAST(row_number() OVER () AS INT) AS sensor_id, c AS sensor_code
         FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('idle')) v(c))
       SELECT c.sensor_code AS "column", (SELECT count(*) FROM events) - count(value) AS missing_count,
              round(CAST((SELECT count(*) FROM events) - count(value) AS DOUBLE) / (SELECT count(*) FROM events) * 100, 2) AS missing_pct
       FROM catalog c LEFT JOIN events ON event_type = sensor_code GROUP BY c.sensor_code""",
)
def profile_payload(spark, folder):
    """Null-dropping readings: the catalog brings back sensors that never reported."""
    events = B.table(spark, folder, "events")
    catalog = telemetry.sensor_catalog(spark, PAYLOAD_SENSORS)
    stats = profiling.sensor_stats(B.event_payload(events), catalog, events)
    return profiling.profile_missing_by_sensor(stats)


@query("profile_labels", f"WITH {Q.UNITS} SELECT raw_label, count(*) AS units FROM units GROUP BY raw_label")
def profile_labels(spark, folder):
    return profiling.profile_labels(units(spark, folder))


@query(
    "label_summary",
    f"""WITH {Q.UNITS} SELECT count(*) FILTER (WHERE raw_label = -1) AS pass_observations,
        count(*) FILTER (WHERE raw_label = 1) AS fail_observations, count(*) AS rows,
        round(CAST(count(*) FILTER (WHERE raw_label = 1) AS DOUBLE) / count(*) * 100, 2) AS failure_rate_pct FROM units""",
)
def label_summary(spark, folder):
    return profiling.label_summary(units(spark, folder))


@query(
    "quality_status",
    """SELECT l_linestatus, CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') / count(*) < 0.1
              THEN 'WARNING' ELSE 'PASS' END AS quality_status FROM lineitem GROUP BY l_linestatus""",
)
def quality_status(spark, folder):
    counts = B.table(spark, folder, "lineitem").groupBy("l_linestatus").agg(
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("fails"), F.count("*").alias("rows")
    )
    none = F.lit(0)
    status = profiling.quality_status(none, none, F.col("fails"), F.col("rows"))
    return counts.select("l_linestatus", status.alias("quality_status"))


@query(
    "time_span",
    f"""WITH {Q.UNITS} SELECT min(event_ts) AS timestamp_start, max(event_ts) AS timestamp_end,
        CAST(date_diff('day', min(event_ts), max(event_ts)) AS INT) AS span_days FROM units""",
)
def time_span(spark, folder):
    return profiling.time_span(units(spark, folder))


@query(
    "dtype_histogram",
    """SELECT CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS dtype, count(*) AS columns
       FROM (DESCRIBE lineitem) GROUP BY ALL""",
)
def dtype_histogram(spark, folder):
    return profiling.dtype_histogram(B.table(spark, folder, "lineitem"))


# Over 30 % of all candidate sensors missing: the unit is held.
GATE_CHECK = f"""WITH {GAPPY} SELECT production_id, round(share * 100, 2) AS missing_pct,
    CASE WHEN share > 0.3 THEN 'TIER_1_CRITICAL' END AS gate_tier FROM gate"""


def gappy(spark, folder):
    return B.vectors(B.table(spark, folder, "embeddings"), masked=True, gappy=True)


def gate_candidates(spark, folder):
    return star.candidate_ids(star.dim_sensor(profiling.sensor_stats(telemetry.to_readings(gappy(spark, folder)))))


@query("missing_row_gate", GATE_CHECK)
def missing_row_gate(spark, folder):
    return profiling.missing_row_gate(gappy(spark, folder), gate_candidates(spark, folder))
