"""Checked intake: files with bad cells and short rows, read in one go and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens.plans import checks as Q
from fablens.plans.registry import query
from fablens.plans.risk import width
from fablens.sources import bindings as B
from fablens.sources import rejects
from fablens.sources.shared import new_path
from fablens.streaming import ledger, live

# Cell number vec_id * 64 + i decides what a cell holds, vec_id what becomes of the row.
CELL = "vec_id * 64 + i"
TEXT = f"""CASE WHEN ({CELL}) % 97 = 5 THEN 'abc' WHEN ({CELL}) % 89 = 3 THEN '' WHEN ({CELL}) % 83 = 7 THEN 'NaN'
          WHEN ({CELL}) % 79 = 11 THEN '1.2.3' WHEN i = 9 AND vec_id % 3 <> 1 THEN 'null' WHEN i = 12 THEN 'off' ELSE {{0}} END"""
STAMP = """CASE WHEN vec_id % 31 = 17 THEN '32/13/2008 00:00' WHEN vec_id % 37 = 19 THEN ''
           ELSE {0} END"""
SHORT, LONG = "vec_id % 23 = 11", "vec_id % 29 = 13"


def telemetry_files(spark, folder):
    """The sensor arrays as headless text files, thousandths as whole numbers, with damage by rule; returns (path, names)."""
    n = width(spark, folder)
    cells = f"transform(embedding, (v, i) -> {TEXT.format('string(bigint(round(double(v) * 1000)))')})"
    stamp = STAMP.format("date_format(timestamp_ntz '2008-07-19 11:55:00' + make_dt_interval(0, int(vec_id)), 'dd/MM/yyyy HH:mm:ss')")
    fields = f"CASE WHEN {SHORT} THEN slice(cells, 1, size(cells) - 4) WHEN {LONG} THEN concat(cells, array('7')) ELSE cells END"
    rows = B.table(spark, folder, "embeddings").selectExpr("vec_id", f"{cells} AS cells", f"{stamp} AS stamp")
    path = new_path(spark, "raw-telemetry")
    rows.selectExpr(f"concat_ws(',', stamp, {fields}) AS value").write.text(path)
    return path, ["timestamp", *[f"Attribute {i}" for i in range(1, n + 1)]]


RAW = f"""cells AS (
  SELECT vec_id, CAST(i AS INT) AS i, {TEXT.format("CAST(CAST(round(CAST(embedding[i + 1] AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR)")} AS text
  FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM embeddings)), lines AS (
  SELECT vec_id, {STAMP.format("strftime(TIMESTAMP '2008-07-19 11:55:00' + vec_id * INTERVAL 1 HOUR, '%d/%m/%Y %H:%M:%S')")} AS stamp,
         string_agg(text, ',' ORDER BY i) FILTER (WHERE NOT ({SHORT}) OR i < 60) AS body FROM cells GROUP BY vec_id), judged AS (
  SELECT vec_id, stamp, stamp || ',' || body || CASE WHEN {LONG} AND NOT ({SHORT}) THEN ',7' ELSE '' END AS record,
         CASE WHEN {SHORT} OR {LONG} THEN 'FIELD_COUNT' WHEN stamp = '' THEN 'NO_TIMESTAMP'
              WHEN stamp LIKE '32/13%' THEN 'BAD_TIMESTAMP' END AS reason FROM lines), states AS (
  SELECT vec_id, i, text, text IN ('', 'NaN', 'null') AS missing, text IN ('abc', '1.2.3', 'off') AS malformed
  FROM cells JOIN judged USING (vec_id) WHERE reason IS NULL)"""

QUALITY_CHECK = f"""WITH {RAW} SELECT CAST(i + 1 AS INT) AS sensor_id, 'Attribute ' || (i + 1) AS sensor_code, count(*) AS rows,
    count(*) FILTER (WHERE missing) AS missing, count(*) FILTER (WHERE malformed) AS malformed,
    CASE WHEN count(*) FILTER (WHERE malformed) > 0 THEN 'string' ELSE 'double' END AS dtype,
    CAST(count(*) FILTER (WHERE missing) AS DOUBLE) / count(*) * 100 AS missing_rate,
    CAST(count(*) FILTER (WHERE malformed) AS DOUBLE) / count(*) * 100 AS malformed_rate,
    count(*) FILTER (WHERE missing) * 2 > count(*) AS is_high_missing FROM states GROUP BY i"""


@query("telemetry_cell_quality", QUALITY_CHECK)
def telemetry_cell_quality(spark, folder):
    """Missing and malformed cells apart: a sensor that reports words is not a sensor that is silent."""
    path, names = telemetry_files(spark, folder)
    return rejects.read_checked(spark, path, names=names).sensor_quality()


@query("telemetry_rejected_rows", f"WITH {RAW} SELECT reason, record FROM judged WHERE reason IS NOT NULL")
def telemetry_rejected_rows(spark, folder):
    path, names = telemetry_files(spark, folder)
    return rejects.read_checked(spark, path, names=names).rejected().select("reason", "record")


@query(
    "telemetry_malformed_cells",
    f"""WITH {RAW} SELECT TIMESTAMP '2008-07-19 11:55:00' + vec_id * INTERVAL 1 HOUR AS event_ts, CAST(i + 1 AS INT) AS sensor_id,
        'Attribute ' || (i + 1) AS sensor_code, text FROM states WHERE malformed""",
)
def telemetry_malformed_cells(spark, folder):
    path, names = telemetry_files(spark, folder)
    return rejects.read_checked(spark, path, names=names).malformed_cells().drop("_file")


@query(
    "telemetry_accepted_readings",
    f"""WITH {RAW} SELECT TIMESTAMP '2008-07-19 11:55:00' + vec_id * INTERVAL 1 HOUR AS event_ts, CAST(i + 1 AS INT) AS sensor_id,
        CASE WHEN NOT missing AND NOT malformed THEN CAST(text AS DOUBLE) END AS value FROM states""",
)
def telemetry_accepted_readings(spark, folder):
    path, names = telemetry_files(spark, folder)
    accepted = rejects.read_checked(spark, path, names=names).accepted()
    return accepted.select("event_ts", F.posexplode("values").alias("_pos", "value")).select("event_ts", (F.col("_pos") + 1).alias("sensor_id"), "value")


CHECKED = "event_ts timestamp_ntz, values array<double>, malformed array<struct<sensor_id:int,text:string>>, _file string"
REJECTED = "reason string, record string, _file string"


def intake_tables(batch, batch_id):
    """A batch's kept rows and its rejects."""
    return {
        "accepted": batch.where("reason is null").select("event_ts", "values", "malformed", "_file"),
        "rejected": batch.where("reason is not null").select("reason", "record", "_file"),
    }


@query("stream_telemetry_quality", QUALITY_CHECK)
def stream_telemetry_quality(spark, folder):
    """The same files as a stream, one file a batch, into accepted and rejected tables; the counts come from the committed ones."""
    path, names = telemetry_files(spark, folder)
    session = live.streaming_session(spark)
    out = new_path(spark, "stream-intake")
    ledger.start(rejects.stream_checked(session, path, names, maxFilesPerTrigger=1), out, intake_tables).awaitTermination()
    accepted = ledger.read_committed(spark, out, "accepted", CHECKED).withColumn("reason", F.lit(None).cast("string"))
    return rejects.CheckedTelemetry(accepted, names[1:]).sensor_quality()


@query(
    "stream_telemetry_rejects",
    f"WITH {RAW} SELECT reason, count(*) AS rows FROM judged WHERE reason IS NOT NULL GROUP BY reason",
)
def stream_telemetry_rejects(spark, folder):
    path, names = telemetry_files(spark, folder)
    session = live.streaming_session(spark)
    out = new_path(spark, "stream-intake")
    ledger.start(rejects.stream_checked(session, path, names, maxFilesPerTrigger=1), out, intake_tables).awaitTermination()
    return ledger.read_committed(spark, out, "rejected", REJECTED).groupBy("reason").agg(F.count("*").alias("rows"))
