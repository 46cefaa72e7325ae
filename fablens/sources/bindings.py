"""How the shared parquet tables play the parts of the production data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fablens import constants as K
from fablens.functions import numbers as N


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _label(is_defect):
    return F.when(is_defect, K.FAIL_LABEL).otherwise(K.PASS_LABEL)


def units(events: DataFrame) -> DataFrame:
    """Production runs: one per event, an error event is a failed run."""
    return events.select(
        F.col("event_id").alias("production_id"),
        F.col("ts").alias("event_ts"),
        _label(F.col("event_type") == "error").alias("raw_label"),
        F.col("user_id").alias("tool"),
    )


def vectors(embeddings: DataFrame, masked: bool = False, gappy: bool = False) -> DataFrame:
    """Sensor arrays: one sensor per dimension, label 0 is the failed class.

    The row id doubles as the clock (hours). ``masked`` blanks every 16th
    sensor for 60 % of the units and freezes another 16th at 1.0. ``gappy`` blanks two sensors of five
    in every 20th unit, and one of five in another 20th.
    """
    values = F.col("embedding").cast("array<double>")
    if masked:
        values = F.transform(
            values,
            lambda v, i: F.when((i % 16 == 3) & (F.col("vec_id") % 10 < 6), F.lit(None).cast("double"))
            .when(i % 16 == 5, F.lit(1.0))
            .otherwise(v),
        )
    if gappy:
        turn = F.col("vec_id") % 20
        values = F.transform(
            values, lambda v, i: F.when(~(((turn == 7) & (i % 5 < 2)) | ((turn == 8) & (i % 5 == 1))), v)
        )
    start = F.lit("2008-07-19 11:55:00").cast("timestamp_ntz")
    return embeddings.select(
        F.col("vec_id").alias("production_id"),
        (start + F.make_dt_interval(hours=F.col("vec_id").cast("int"))).alias("event_ts"),
        _label(F.col("label") == 0).alias("raw_label"),
        F.when(F.col("label") == 0, 1).otherwise(0).alias("y"),
        values.alias("values"),
    )


def event_payload(events: DataFrame) -> DataFrame:
    """Each run reports one named sensor: the event type, with the event value."""
    return events.select(
        F.col("event_id").alias("production_id"),
        F.col("event_type").alias("sensor_code"),
        N.nan_to_null(F.col("value")).alias("value"),
    )


def scored_lines(lineitem: DataFrame) -> DataFrame:
    """Order lines as scored lots: quantity is the risk, a return is the defect."""
    return lineitem.select(
        (F.col("l_quantity") / 50).alias("p"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
    )


def scored_models(lineitem: DataFrame) -> DataFrame:
    """Four competing scores for every order line, in long form."""
    y = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    scores = F.array(
        F.struct(F.lit("quantity").alias("model"), (F.col("l_quantity") / 50).alias("p")),
        F.struct(F.lit("discount").alias("model"), (F.col("l_discount") * 5).alias("p")),
        F.struct(F.lit("tax").alias("model"), (F.col("l_tax") * 8).alias("p")),
        F.struct(F.lit("none").alias("model"), F.lit(0.0).alias("p")),
    )
    return lineitem.select(y.alias("y"), F.explode(scores).alias("s")).select("s.model", "s.p", "y")


def scored_units(events: DataFrame) -> DataFrame:
    """Runs with a closed-form risk: value / (value + 300)."""
    return events.select(
        F.col("event_id").alias("production_id"),
        F.col("ts").alias("event_ts"),
        (F.col("value") / (F.col("value") + 300)).alias("p"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("y"),
    )
