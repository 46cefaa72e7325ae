"""Arriving units: scored, routed, counted and gated as they come.

Each function takes a streaming frame and returns one; they also run on a
static frame, which is how replay is checked against batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fablens import constants as K
from fablens.functions import calendar as C
from fablens.functions import numbers as N
from fablens.operators.dispatch import operational_alerts, route_lots
from fablens.operators.models import linear_score
from fablens.operators.profiling import missing_row_gate, missing_share

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful queries.

    The partition count of streaming state is fixed when a query first starts
    and is not adapted later, so it is set here (default: one per core). State
    lives in RocksDB, outside the heap.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set(
        "spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism)
    )
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # Spares a lookup per write that only feeds a row-count metric.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    return session


def open_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """File stream; the schema is the one given, or that of the files already there."""
    schema = schema or spark.read.format(fmt).load(path).schema
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def with_event_time(stream: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Watermarks need a zoned timestamp: cast once, at the source."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_route_lots(
    vectors: DataFrame,
    weights: Column,
    intercept: float,
    t1: float,
    t2: float = K.ELEVATED_RISK,
    fill: Column | None = None,
    candidates: list[int] | None = None,
    max_missing: float = K.MAX_MISSING_FEATURES,
) -> DataFrame:
    """Gate, impute, score and route each unit on arrival. Stateless.

    ``fill`` is an array of fitted medians for missing readings. With ``candidates`` a unit that misses too many of
    them gets no score; units without a score, for either reason, are held.
    """
    passed = vectors
    if candidates is not None:
        share = missing_share(F.col("values"), candidates)
        passed = passed.withColumn("_gated", share > max_missing)
    if fill is not None:
        passed = passed.withColumn("_fill", fill).withColumn(
            "values", F.zip_with("values", "_fill", lambda v, m: F.coalesce(v, m))
        )
    scored = linear_score(passed, weights, intercept)
    if candidates is not None:
        scored = scored.withColumn("p", F.when(~F.col("_gated"), F.col("p")))
    return operational_alerts(route_lots(scored, t1, t2))


def stream_yield_windows(units: DataFrame, lateness: str = "1 hour", by_shift: bool = False) -> DataFrame:
    """Yield per day (and shift), emitted once the watermark has passed the day.

    Units arriving later than ``lateness`` behind the newest are dropped. Counts
    are folded in each task before they reach the state.
    """
    keys = [F.window("event_ts", "1 day").alias("day")]
    if by_shift:
        keys.append(C.assign_shift(F.col("event_ts")).alias("shift_code"))
    counted = (
        units.withWatermark("event_ts", lateness)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("total_units"),
            N.count_where(F.col("raw_label") == K.FAIL_LABEL).alias("defective_units"),
        )
    )
    return counted.select(
        F.to_date("day.start").alias("run_date"),
        *(["shift_code"] if by_shift else []),
        "total_units",
        "defective_units",
        N.pct(F.col("total_units") - F.col("defective_units"), F.col("total_units")).alias("yield_rate_pct"),
    )


def stream_dedup_units(
    units: DataFrame, key: str = "production_id", lateness: str = "1 hour", spread: int = 1
) -> DataFrame:
    """Drop re-delivered units that arrive within ``lateness`` of the first.

    A unit delivered over and over sends all its copies to one task. Where that happens,
    ``spread`` > 1 drops copies first within that many slots per key (taken from the input
    partition), which leaves at most ``spread`` rows of it per batch for the
    second, exact pass, at the price of a second state.
    """
    marked = units.withWatermark("event_ts", lateness)
    if spread > 1:
        slot = F.pmod(F.spark_partition_id(), F.lit(spread))
        marked = marked.withColumn("_slot", slot).dropDuplicatesWithinWatermark([key, "_slot"]).drop("_slot")
    return marked.dropDuplicatesWithinWatermark([key])


def stream_missing_gate(
    vectors: DataFrame, candidates: list[int] | None = None, max_missing: float = K.MAX_MISSING_FEATURES
) -> DataFrame:
    """Hold units that arrive with too many missing readings. Stateless."""
    return missing_row_gate(vectors, candidates, max_missing)


def run_available(stream: DataFrame, path: str) -> DataFrame:
    """Process what is there, append it to files under ``path``, and return them.

    Offsets and state are kept next to the output, so a restart continues.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")
