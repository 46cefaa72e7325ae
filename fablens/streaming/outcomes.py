"""Outcomes that arrive after their units, and alerts that are written once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fablens import constants as K
from fablens.operators.dispatch import operational_alerts, route_lots
from fablens.streaming.ledger import Outputs
from fablens.streaming.live import streaming_session

AUDIT = "batch_run_id bigint, risk_tier string, lots bigint, defects bigint, highest_risk_pct double"


def join_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A streaming session for the join: both sides' state of a partition in one store, of which a batch saves the changes only."""
    session = streaming_session(spark, state_partitions)
    session.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return session


def stream_attach_outcomes(
    units: DataFrame, outcomes: DataFrame, bound: str = "48 hours", unit_lateness: str = "1 hour", outcome_lateness: str = "1 hour"
) -> DataFrame:
    """Each unit with its outcome, or without one when ``bound`` has passed since its own time.

    ``units`` has ``production_id`` and ``event_ts``, ``outcomes`` has ``production_id``, ``outcome_ts`` and ``raw_label``. An outcome
    counts from the unit's time until ``bound`` later, bounds included. A unit with an outcome is emitted as both have arrived,
    one without as soon as the watermark has passed its bound; state older than that is dropped, so its size is that of
    ``bound`` plus lateness, however long the stream runs. Several outcomes of a unit give several rows: deduplicate first. On static
    frames the same call is the batch join. Run it in ``join_session``: its state lives in RocksDB.
    """
    left = units.withWatermark("event_ts", unit_lateness)
    right = outcomes.select(F.col("production_id").alias("_unit"), "outcome_ts", "raw_label").withWatermark("outcome_ts", outcome_lateness)
    inside = (F.col("outcome_ts") >= F.col("event_ts")) & (F.col("outcome_ts") <= F.col("event_ts") + F.expr(f"interval {bound}"))
    return left.join(right, (F.col("production_id") == F.col("_unit")) & inside, "leftOuter").drop("_unit")


def alert_tables(t1: float | Column, t2: float | Column = K.ELEVATED_RISK) -> Outputs:
    """What a batch of scored units (``production_id``, ``p``, ``y``) writes: its alerts and its lines of the audit trail."""

    def outputs(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        routed = route_lots(batch, t1, t2)
        audit = routed.groupBy("risk_tier").agg(
            F.count("*").alias("lots"), F.count_if(F.col("y") == 1).alias("defects"), F.round(F.max("p") * 100, 2).alias("highest_risk_pct")
        )
        return {
            "alerts": operational_alerts(routed),
            "audit": audit.select(F.lit(batch_id).cast("bigint").alias("batch_run_id"), "risk_tier", "lots", "defects", "highest_risk_pct"),
        }

    return outputs
