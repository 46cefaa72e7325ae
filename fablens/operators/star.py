"""Dimensions, facts, and the checks that stand in for declared constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens import constants as K
from fablens.functions import calendar as C
from fablens.functions import numbers as N


def _calendar_columns(ts):
    day = C.run_date(ts)
    return [
        day.alias("run_date"),
        C.run_hour(ts).alias("run_hour"),
        C.assign_shift(ts).alias("shift_code"),
        C.day_name(day).alias("day_name"),
        C.week_of_year(day).alias("week_of_year"),
        C.month_name(day).alias("month_name"),
    ]


def _outcome_columns(scrap_cost: float):
    defect = F.col("raw_label") == K.FAIL_LABEL
    return [
        F.col("raw_label"),
        defect.alias("is_defect"),
        F.when(defect, "NON_CONFORMING").otherwise("CONFORMING").alias("defect_classification"),
        F.when(defect, scrap_cost).otherwise(0.0).alias("estimated_scrap_cost"),
        defect.alias("reinspection_flag"),
    ]


def dim_production_entity(units: DataFrame) -> DataFrame:
    ts = F.col("event_ts")
    return units.select("production_id", ts.alias("run_timestamp"), *_calendar_columns(ts))


def fact_quality_outcome(units: DataFrame, scrap_cost: float = K.SCRAP_COST) -> DataFrame:
    return units.select("production_id", *_outcome_columns(scrap_cost))


def outcomes(units: DataFrame, scrap_cost: float = K.SCRAP_COST, *keep: str) -> DataFrame:
    """Dimension and fact columns side by side, for units that carry their own label.

    Both tables are then projections of one row, so there is nothing to join.
    """
    ts = F.col("event_ts")
    return units.select(
        "production_id", *keep, ts.alias("run_timestamp"), *_calendar_columns(ts), *_outcome_columns(scrap_cost)
    )


def star_join(production: DataFrame, quality: DataFrame) -> DataFrame:
    """The same frame from two stored tables. Bucket both on ``production_id`` to join in place."""
    return production.join(quality, "production_id")


def dim_sensor(stats: DataFrame, max_missing: float = K.MAX_MISSING_PCT) -> DataFrame:
    """Sensor register with quarantine flags; the missing test uses the unrounded rate."""
    high = F.col("missing_rate") > max_missing
    constant = F.col("is_constant")
    return stats.select(
        "sensor_id",
        "sensor_code",
        N.sensor_alias(F.col("sensor_id")).alias("sensor_alias"),
        F.lit(K.SENSOR_CATEGORY).alias("category"),
        "is_constant",
        F.round("missing_rate", 2).alias("missing_rate_pct"),
        (high | constant).alias("is_quarantined"),
        F.when(high, K.REASON_MISSING)
        .when(constant, K.REASON_CONSTANT)
        .otherwise(K.REASON_NONE)
        .alias("quarantine_reason"),
        F.round("mean", 4).alias("mean_val"),
        F.round("std", 4).alias("std_val"),
        F.round("min", 4).alias("min_val"),
        F.round("max", 4).alias("max_val"),
    )


def staging_raw(payload: DataFrame, data_source: str) -> DataFrame:
    """Staged payload with its lineage columns."""
    return payload.select(
        "production_id",
        "event_timestamp",
        "quality_label",
        "sensor_data",
        F.current_timestamp().alias("ingested_at"),
        F.lit(data_source).alias("data_source"),
    )


def candidate_sensors(sensors: DataFrame) -> DataFrame:
    """Sensors that may feed a model: everything not quarantined."""
    return sensors.where(~F.col("is_quarantined")).select("sensor_id", "sensor_code")


def candidate_ids(sensors: DataFrame) -> list[int]:
    """The candidate sensors' ids in order; there are as many as the table has sensor columns at most."""
    return [r["sensor_id"] for r in candidate_sensors(sensors).orderBy("sensor_id").collect()]


def set_difference(all_sensors: DataFrame, *registers: DataFrame) -> DataFrame:
    """The same set from separate registers: all minus their union."""
    taken = reduce(DataFrame.union, [r.select("sensor_code") for r in registers]).distinct()
    return all_sensors.join(taken, "sensor_code", "left_anti")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once. Copies are counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent, with the number of rows behind each.

    The child is reduced to one row per key first, so a hot key costs one row.
    """
    keys = child.groupBy(F.col(child_key).alias("key")).agg(F.count("*").alias("rows"))
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def _per_key(df: DataFrame, key: str, columns: tuple[str, ...], side: str) -> DataFrame:
    """One row per key: its rows on this side, and the NULLs in each column."""
    nulls = [N.count_where(F.col(c).isNull()).alias(f"{side}_null_{c}") for c in columns]
    return df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias(f"{side}_rows"), *nulls)


def integrity_checks(production: DataFrame, quality: DataFrame, sensors: DataFrame) -> DataFrame:
    """Violations per declared constraint: keys unique, parents present, nothing NULL. Each table is read once.

    A table is folded to one row per key, which serves its key, foreign-key and NULL checks alike.
    """
    parents = _per_key(production, "production_id", ("production_id", "run_timestamp"), "production")
    children = _per_key(quality, "production_id", ("raw_label", "is_defect"), "quality")
    codes = _per_key(sensors, "sensor_code", ("sensor_code", "missing_rate_pct"), "sensor")
    children = children.withColumnRenamed("key", "child_key")
    facts = parents.join(children, F.col("key") == F.col("child_key"), "full")
    orphaned = F.col("quality_rows").isNotNull() & F.col("production_rows").isNull()
    checks = {
        "production_pk": N.count_where(F.col("production_rows") > 1),
        "quality_pk": N.count_where(F.col("quality_rows") > 1),
        "quality_production_fk": N.count_where(orphaned),
        "production_not_null_production_id": F.sum("production_null_production_id"),
        "production_not_null_run_timestamp": F.sum("production_null_run_timestamp"),
        "quality_not_null_raw_label": F.sum("quality_null_raw_label"),
        "quality_not_null_is_defect": F.sum("quality_null_is_defect"),
    }
    of_sensors = {
        "sensor_code_unique": N.count_where(F.col("sensor_rows") > 1),
        "sensor_not_null_sensor_code": F.sum("sensor_null_sensor_code"),
        "sensor_not_null_missing_rate_pct": F.sum("sensor_null_missing_rate_pct"),
    }
    return _as_rows(facts, checks).union(_as_rows(codes, of_sensors))


def _as_rows(df: DataFrame, checks: dict) -> DataFrame:
    counts = df.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(name) for name, c in checks.items()])
    return counts.unpivot([], list(checks), "check", "violations")


def not_null(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """NULL counts of all ``columns`` in one pass, one row per column."""
    counts = df.agg(*[N.count_where(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "violations").select(
        F.concat(F.lit(f"{name}_not_null_"), F.col("column")).alias("check"), "violations"
    )
