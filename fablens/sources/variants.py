"""Staged payloads as VARIANT: nested and mixed values keep their types, and a read touches only the keys it asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fablens.functions import numbers as N
from fablens.sources.telemetry import payload_map


def from_json_text(text: Column) -> Column:
    """The text as a variant; NULL where it is no JSON. Numbers, texts, booleans, nulls, objects and arrays stay what they are."""
    return F.try_parse_json(text)


def staging_variant(vectors: DataFrame) -> DataFrame:
    """Per unit: the readings that are present as one variant object, beside unit, time and label."""
    codes = F.transform(F.sequence(F.lit(1), F.size("values")), lambda i: N.sensor_code(i))
    return vectors.select(
        "production_id",
        F.col("event_ts").alias("event_timestamp"),
        F.col("raw_label").alias("quality_label"),
        F.to_variant_object(payload_map(codes, F.col("values"))).alias("sensor_data"),
    )


def value_at(payload: str | Column, key: str, kind: str = "double") -> Column:
    """A top-level value by its key, NULL where it is absent or of another kind. Stored payloads read this key alone."""
    mark = "'" if '"' in key else '"'
    if mark in key:
        raise ValueError("a path can't name a key that holds both kinds of quotes; explode the payload")
    return F.try_variant_get(payload, f"$[{mark}{key}{mark}]", kind)


def explode_payload(staged: DataFrame, column: str = "sensor_data", *keep: str) -> DataFrame:
    """One row per key of the object (or place of the array): ``keep``, ``pos``, ``key`` and ``value``, a variant. NULL and empty ones give none."""
    exploded = staged.lateralJoin(staged.sparkSession.tvf.variant_explode(F.col(column).outer()))
    return exploded.select(*keep, "pos", "key", "value")


def kind_of(value: str | Column) -> Column:
    """Name of a variant's type: number, string, boolean, object, array or null."""
    schema = F.schema_of_variant(value)
    head = F.regexp_extract(schema, "^[A-Z]+", 0)
    return (
        F.when(F.is_variant_null(value), "null")
        .when(head.isin("OBJECT", "ARRAY", "STRING", "BOOLEAN"), F.lower(head))
        .when(head.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "number")
        .otherwise(F.lower(schema))
    )


def read_variant_payload(staged: DataFrame, column: str = "sensor_data", *keep: str) -> DataFrame:
    """Variant payloads back to typed long readings: ``sensor_code`` and ``value``, numbers only."""
    cells = explode_payload(staged, column, *keep)
    return cells.select(*keep, F.col("key").alias("sensor_code"), F.try_variant_get("value", "$", "double").alias("value"))
