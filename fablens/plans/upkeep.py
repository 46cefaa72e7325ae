"""Stored tables kept up: late corrections, key checks of a batch, variant payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens.functions import calendar as C
from fablens.operators import integrity, kpi, star
from fablens.plans import checks as Q
from fablens.plans.registry import query
from fablens.plans.warehouse import masked
from fablens.sources import bindings as B
from fablens.sources import corrections, sinks, variants
from fablens.sources.shared import materialize, new_path

RUNS = "production_id bigint, raw_label int, run_date date"


def runs(spark, folder):
    units = B.units(B.table(spark, folder, "events"))
    return units.select("production_id", "raw_label", C.run_date(F.col("event_ts")).alias("run_date"))


def daily_cells(rows):
    return kpi.outcome_cells(star.outcomes(rows.withColumn("event_ts", F.col("run_date").cast("timestamp_ntz"))), "run_date").select(
        "units", "defects", "scrap_cost", "run_date"
    )


def late_changes(spark, folder):
    """Of the first ten days: a label turned, a run moved a day on, a run removed, a run added."""
    every = runs(spark, folder)
    early = every.where(F.col("run_date") < F.date_add(every.agg(F.min("run_date")).scalar(), 10))
    by = F.col("production_id") % 50
    changed = early.where(by.isin(7, 11, 13, 17))
    return changed.select(
        F.when(by == 17, F.col("production_id") + 100_000_000).otherwise(F.col("production_id")).alias("production_id"),
        F.when(by == 7, -F.col("raw_label")).otherwise(F.col("raw_label")).alias("raw_label"),
        F.when(by == 11, F.date_add("run_date", 1)).otherwise(F.col("run_date")).alias("run_date"),
        (by == 13).alias("_deleted"),
    )


CORRECTED = f"""{Q.UNITS}, plain AS (SELECT production_id, raw_label, CAST(event_ts AS DATE) AS run_date FROM units), marked AS (
  SELECT *, CASE WHEN run_date < (SELECT min(run_date) FROM plain) + 10 THEN production_id % 50 ELSE -1 END AS how FROM plain), corrected AS (
  SELECT production_id, CASE WHEN how = 7 THEN -raw_label ELSE raw_label END AS raw_label,
         CAST(CASE WHEN how = 11 THEN run_date + 1 ELSE run_date END AS DATE) AS run_date FROM marked WHERE how <> 13
  UNION ALL SELECT production_id + 100000000, raw_label, run_date FROM marked WHERE how = 17)"""


def corrected_runs(spark, folder):
    """Runs by day, and their daily cells, after late changes; returns both folders and the days that were rewritten."""
    path, cells = new_path(spark, "runs"), new_path(spark, "daily-cells")
    stored = sinks.write_table(runs(spark, folder).repartition("run_date"), path, partition_by=["run_date"])
    sinks.write_table(daily_cells(stored), cells, partition_by=["run_date"])
    days = corrections.merge_corrections(spark, path, RUNS, late_changes(spark, folder))
    now = spark.read.schema(RUNS).parquet(path)
    corrections.refresh_days(spark, now, days, cells, daily_cells)
    return path, cells, days


@query("merge_corrections", f"WITH {CORRECTED} SELECT production_id, raw_label, run_date FROM corrected")
def merge_corrections(spark, folder):
    path, _, _ = corrected_runs(spark, folder)
    return spark.read.schema(RUNS).parquet(path)


@query(
    "corrected_daily_cells",
    f"""WITH {CORRECTED} SELECT run_date, count(*) AS units, count(*) FILTER (WHERE raw_label = 1) AS defects,
        CAST(count(*) FILTER (WHERE raw_label = 1) * 450 AS DOUBLE) AS scrap_cost FROM corrected GROUP BY run_date""",
)
def corrected_daily_cells(spark, folder):
    """Only the cells of rewritten days are redone."""
    _, cells, _ = corrected_runs(spark, folder)
    return spark.read.schema("units bigint, defects bigint, scrap_cost double, run_date date").parquet(cells)


KEYS = "production_id bigint"


def stored_keys(spark, folder):
    """History of nine units of ten with its summary, and the batch: the tenth, some of them twice, and some old ones again."""
    ids = B.table(spark, folder, "events").select(F.col("event_id").alias("production_id"))
    old, new = ids.where("production_id % 10 <> 3"), ids.where("production_id % 10 = 3")
    path = new_path(spark, "key-history")
    pieces = integrity.pieces_for(2 * ids.count())
    integrity.store_history(old, "production_id", path, pieces)
    summary = materialize(integrity.summarise(old, "production_id", pieces), "key-summary")
    batch = new.unionByName(new.where("production_id % 100 = 13")).unionByName(old.where("production_id % 50 = 7"))
    return batch, summary, path, pieces


@query(
    "incremental_unique_keys",
    """SELECT event_id AS key, CAST(2 AS BIGINT) AS copies FROM events WHERE event_id % 100 = 13 OR event_id % 50 = 7""",
)
def incremental_unique_keys(spark, folder):
    """Keys of a batch that are in it twice or in history already."""
    batch, summary, path, pieces = stored_keys(spark, folder)
    return integrity.repeated_in_batch(spark, batch, "production_id", summary, path, KEYS, pieces)


@query(
    "incremental_orphans",
    """SELECT event_id + 1000000000 AS key, CAST(1 AS BIGINT) AS rows FROM events WHERE event_id % 40 = 3""",
)
def incremental_orphans(spark, folder):
    """Outcomes whose unit is neither in the batch nor in history; late ones of old units are fine."""
    batch, summary, path, pieces = stored_keys(spark, folder)
    ids = B.table(spark, folder, "events").select(F.col("event_id").alias("production_id"))
    strangers = ids.where("production_id % 40 = 3").select((F.col("production_id") + 1_000_000_000).alias("production_id"))
    outcomes = batch.unionByName(ids.where("production_id % 20 = 5")).unionByName(strangers)
    return integrity.orphans_in_batch(spark, outcomes, "production_id", batch, "production_id", summary, path, KEYS, pieces)


@query(
    "incremental_summary",
    "SELECT event_id AS key FROM events",
)
def incremental_summary(spark, folder):
    """History's and batch's summaries merged miss none of their keys."""
    batch, summary, _, pieces = stored_keys(spark, folder)
    both = materialize(integrity.merge_summaries(summary, integrity.summarise(batch, "production_id", pieces)), "key-summary")
    ids = B.table(spark, folder, "events").select(F.col("event_id").alias("production_id"))
    return integrity.suspects(ids, "production_id", both, pieces).select("key")


def stored_variants(spark, folder):
    """The masked payloads as variants, written and read again."""
    return materialize(variants.staging_variant(masked(spark, folder)), "variant-payloads")


@query(
    "variant_payload",
    f"""WITH {Q.readings()} SELECT production_id, CASE WHEN y = 1 THEN 1 ELSE -1 END AS quality_label,
        'Attribute ' || sensor_id AS sensor_code, value FROM readings WHERE value IS NOT NULL""",
)
def variant_payload(spark, folder):
    """Every key and value of the stored payloads."""
    return variants.read_variant_payload(stored_variants(spark, folder), "sensor_data", "production_id", "quality_label")


@query(
    "variant_values",
    f"""WITH {Q.readings()} SELECT production_id, max(value) FILTER (WHERE sensor_id = 2) AS second, max(value) FILTER (WHERE sensor_id = 4) AS fourth,
        CAST(NULL AS DOUBLE) AS absent FROM readings GROUP BY production_id""",
)
def variant_values(spark, folder):
    """Three keys of the payload, one of them absent; the scan reads these alone."""
    value = lambda key: variants.value_at("sensor_data", key)
    return stored_variants(spark, folder).select(
        "production_id", value("Attribute 2").alias("second"), value("Attribute 4").alias("fourth"), value("Attribute 999").alias("absent")
    )


MIXED = """'{"unit": {"id": ' || event_id || ', "type": "' || event_type || '"}, "props": ' || props || ', "flags": [' || (event_id % 2 = 0) || ', null, "x", 1.5], "ok": '
    || (event_id % 3 = 0) || ', "note": ' || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE '"n' || event_id || '"' END || '}'"""


@query(
    "variant_nested",
    f"""WITH p AS (SELECT event_id, CAST({MIXED} AS JSON) AS j FROM events), k AS (
          SELECT event_id, unnest(json_keys(j)) AS key, j FROM p)
        SELECT event_id, key, CASE json_type(j, '$.' || key) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string'
               WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind,
               CASE WHEN key = 'unit' THEN CAST(json_extract(j, '$.unit.id') AS BIGINT) END AS unit_id,
               CASE WHEN key = 'flags' THEN CAST(json_extract(j, '$.flags[3]') AS DOUBLE) END AS fourth_flag FROM k""",
)
def variant_nested(spark, folder):
    """Objects, arrays, texts, booleans and nulls of a mixed payload, exploded with their types."""
    text = B.table(spark, folder, "events").select("event_id", F.expr(MIXED).alias("text"))
    stored = materialize(text.select("event_id", variants.from_json_text(F.col("text")).alias("payload")), "mixed-payloads")
    cells = variants.explode_payload(stored, "payload", "event_id")
    return cells.select(
        "event_id",
        "key",
        variants.kind_of("value").alias("kind"),
        F.when(F.col("key") == "unit", F.try_variant_get("value", "$.id", "bigint")).alias("unit_id"),
        F.when(F.col("key") == "flags", F.try_variant_get("value", "$[3]", "double")).alias("fourth_flag"),
    )
