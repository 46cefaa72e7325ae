"""Streaming queries: replayed to the end of the files, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from fablens import constants as K
from fablens.plans import checks as Q
from fablens.plans.profiles import GATE_CHECK, gate_candidates
from fablens.plans.registry import query
from fablens.plans.risk import GAPPY_ALERTS, fixed_weights, gappy_rules, width
from fablens.schema import ALERTS
from fablens.sources import bindings as B
from fablens.sources.shared import new_path
from fablens.streaming import ledger, live, outcomes


def _replay(spark, stream, label):
    """Run to the end in the streaming session, and scan the output in the caller's."""
    path = new_path(spark, label)
    out = live.run_available(stream, path)
    return spark.read.schema(out.schema).parquet(f"{path}/out")


def table_stream(session, folder, name):
    """A shared table as a stream; the pattern fits one file as well as a folder of files."""
    schema = B.table(session, folder, name).schema
    return live.open_stream(session, f"{folder}/{name}.parque[t]", schema=schema)


def event_stream(session, folder):
    return live.with_event_time(B.units(table_stream(session, folder, "events")))


def vector_stream(session, folder, masked=False, gappy=False):
    return B.vectors(table_stream(session, folder, "embeddings"), masked, gappy)


@query(
    "stream_route_lots",
    f"""SELECT production_id, printf('LOT_%04d', production_id) AS lot_id, round(p * 100, 2) AS failure_risk_pct,
        CASE WHEN p >= 0.14 THEN 'TIER_1_CRITICAL' WHEN p >= 0.08 THEN 'TIER_2_ELEVATED' ELSE 'TIER_3_NOMINAL' END AS risk_tier,
        CASE WHEN p >= 0.14 THEN '{K.TIER_1_ACTION}' WHEN p >= 0.08 THEN '{K.TIER_2_ACTION}'
             ELSE '{K.TIER_3_ACTION}' END AS operational_action,
        CASE WHEN p >= 0.14 THEN 'URGENT' WHEN p >= 0.08 THEN 'MEDIUM' ELSE 'LOW' END AS alert_urgency,
        CASE WHEN y = 1 THEN 'DEFECT' ELSE 'CONFORMING' END AS actual_quality FROM {Q.LINEAR_P} s""",
)
def stream_route_lots(spark, folder):
    session = live.streaming_session(spark)
    alerts = live.stream_route_lots(vector_stream(session, folder), fixed_weights(width(session, folder)), -2.2, 0.14)
    return _replay(spark, alerts, "stream-alerts")


CLOSED = "run_date + INTERVAL 1 DAY <= (SELECT max(event_ts) FROM units) - INTERVAL 1 HOUR"


@query(
    "stream_yield_windows",
    f"""WITH {Q.STAR} SELECT run_date, {Q.TOTAL} AS total_units, {Q.DEFECTS} AS defective_units,
        {Q.YIELD_PCT} AS yield_rate_pct FROM star WHERE {CLOSED} GROUP BY run_date""",
)
def stream_yield_windows(spark, folder):
    """Days that the watermark has closed."""
    session = live.streaming_session(spark)
    return _replay(spark, live.stream_yield_windows(event_stream(session, folder)), "stream-yield")


@query(
    "stream_shift_yield_windows",
    f"""WITH {Q.STAR} SELECT run_date, shift_code, {Q.TOTAL} AS total_units, {Q.DEFECTS} AS defective_units,
        {Q.YIELD_PCT} AS yield_rate_pct FROM star WHERE {CLOSED} GROUP BY run_date, shift_code""",
)
def stream_shift_yield_windows(spark, folder):
    session = live.streaming_session(spark)
    windows = live.stream_yield_windows(event_stream(session, folder), by_shift=True)
    return _replay(spark, windows, "stream-shift-yield")


@query("stream_dedup_units", f"WITH {Q.UNITS} SELECT production_id, raw_label, tool FROM units")
def stream_dedup_units(spark, folder):
    """Every third unit is delivered again; each comes out once."""
    events = B.table(spark, folder, "events")
    path = new_path(spark, "redelivered")
    events.union(events.where("event_id % 3 = 0")).write.parquet(path)
    session = live.streaming_session(spark)
    stream = live.with_event_time(B.units(live.open_stream(session, path, schema=events.schema)))
    return _replay(spark, live.stream_dedup_units(stream), "stream-units").select("production_id", "raw_label", "tool")


@query("stream_missing_gate", GATE_CHECK)
def stream_missing_gate(spark, folder):
    session = live.streaming_session(spark)
    stream = vector_stream(session, folder, masked=True, gappy=True)
    return _replay(spark, live.stream_missing_gate(stream, gate_candidates(session, folder)), "stream-gate")


@query("stream_route_gappy_units", GAPPY_ALERTS)
def stream_route_gappy_units(spark, folder):
    """Units with missing readings on arrival: gated, imputed, scored and routed; what has no score is held."""
    session = live.streaming_session(spark)
    stream = vector_stream(session, folder, masked=True, gappy=True)
    return _replay(spark, live.stream_route_lots(stream, *gappy_rules(session, folder)), "stream-gappy-alerts")


def outcome_stream(session, folder):
    """Four units of five get their outcome, up to 71 hours later."""
    events = table_stream(session, folder, "events").where("event_id % 5 <> 0")
    units = B.units(events)
    late = (F.col("event_ts") + F.make_dt_interval(hours=(F.col("production_id") % 72).cast("int"))).cast("timestamp")
    return units.select("production_id", late.alias("outcome_ts"), "raw_label")


@query(
    "stream_attach_outcomes",
    f"""WITH {Q.UNITS}, outcomes AS (
          SELECT production_id, event_ts + (production_id % 72) * INTERVAL 1 HOUR AS outcome_ts, raw_label FROM units WHERE production_id % 5 <> 0),
        joined AS (
          SELECT u.production_id, u.event_ts, u.tool, o.raw_label FROM units u LEFT JOIN outcomes o
          ON o.production_id = u.production_id AND o.outcome_ts BETWEEN u.event_ts AND u.event_ts + INTERVAL 48 HOUR)
        SELECT production_id, tool, raw_label FROM joined
        WHERE raw_label IS NOT NULL OR event_ts < (SELECT max(event_ts) FROM units) - INTERVAL 49 HOUR""",
)
def stream_attach_outcomes(spark, folder):
    """Units meet outcomes that arrive later; those without one come out once their 48 hours have passed."""
    session = outcomes.join_session(spark)
    units = event_stream(session, folder).drop("raw_label")
    joined = outcomes.stream_attach_outcomes(units, outcome_stream(session, folder))
    return _replay(spark, joined.select("production_id", "tool", "raw_label"), "stream-outcomes")


def alerts_once(spark, folder):
    """Scored units as a stream of four files, each batch delivered twice; returns the folder of the tables."""
    events = B.table(spark, folder, "events")
    path, out = new_path(spark, "event-files"), new_path(spark, "alerts-once")
    events.repartition(4).write.parquet(path)
    session = live.streaming_session(spark)
    scored = B.scored_units(live.open_stream(session, path, schema=events.schema, maxFilesPerTrigger=1))
    tables = outcomes.alert_tables(0.14)

    def twice(batch, batch_id):
        ledger.write_batch(batch, batch_id, out, tables)
        ledger.write_batch(batch, batch_id, out, tables)

    writer = scored.writeStream.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
    writer.foreachBatch(twice).start().awaitTermination()
    return out


@query("stream_alerts_exactly_once", f"WITH {Q.ALERTS} SELECT * FROM alerts")
def stream_alerts_exactly_once(spark, folder):
    """Batches that are delivered again leave every alert once."""
    return ledger.read_committed(spark, alerts_once(spark, folder), "alerts", ALERTS).drop("batch")


@query(
    "stream_alert_audit",
    f"""WITH {Q.ROUTED} SELECT risk_tier, CAST(count(*) AS BIGINT) AS lots, CAST(count(*) FILTER (WHERE y = 1) AS BIGINT) AS defects,
        round(max(p) * 100, 2) AS highest_risk_pct, TRUE AS entered FROM routed GROUP BY risk_tier""",
)
def stream_alert_audit(spark, folder):
    """The audit lines of all batches add up to the lots, and the ledger holds as many rows as were written."""
    out = alerts_once(spark, folder)
    audit = ledger.read_committed(spark, out, "audit", outcomes.AUDIT)
    entered = ledger.ledger(spark, out).where("`table` = 'alerts'").agg(F.sum("rows")).scalar()
    total = audit.agg(F.sum("lots")).scalar()
    sums = audit.groupBy("risk_tier").agg(F.sum("lots").alias("lots"), F.sum("defects").alias("defects"), F.max("highest_risk_pct").alias("highest_risk_pct"))
    return sums.withColumn("entered", entered == total)
