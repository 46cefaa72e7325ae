"""Late corrections of stored runs: an upsert by key that rewrites only the days it changes.

The table lies in folders by day. A correction may change a run, move it to another day, remove it or add one. The days of the old and
of the new rows are found from the key and day columns alone; those days are rebuilt beside the table and then
put in place of the old ones. What is to be put in place is noted first, so a merge that is stopped half way is finished by the next.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fablens.sources.shared import discard, materialize, new_path
from fablens.sources.sinks import write_table

DELETED = "_deleted"


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    place, fs = _fs(spark, path)
    return fs.exists(place)


def latest_changes(changes: DataFrame, key: str, order: str) -> DataFrame:
    """One change per key: the greatest by ``order`` (dropped afterwards). Rows without a key are left out."""
    rest = [c for c in changes.columns if c not in (key, order)]
    newest = F.max(F.struct(order, *rest)).alias("_row")
    return changes.where(F.col(key).isNotNull()).groupBy(key).agg(newest).select(key, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def _put(spark: SparkSession, path: str, note: dict) -> None:
    """Put the noted days in place; a day that lost its last run goes."""
    staged = spark.read.schema(note["schema"]).parquet(note["staged"])
    write_table(staged, path, partition_by=[note["day"]])
    for gone in note["emptied"]:
        place, fs = _fs(spark, f"{path}/{note['day']}={gone}")
        fs.delete(place, True)
    place, fs = _fs(spark, f"{path}/_merging")
    fs.delete(place, True)


def finish(spark: SparkSession, path: str) -> bool:
    """Finish a merge that was stopped while its days were put in place; whether there was one."""
    if not _exists(spark, f"{path}/_merging/_SUCCESS"):
        return False
    _put(spark, path, json.loads(spark.read.text(f"{path}/_merging").first()[0]))
    return True


def merge_corrections(spark: SparkSession, path: str, schema: str, changes: DataFrame, key: str = "production_id", day: str = "run_date") -> list[str]:
    """Merge ``changes`` (one row per key; ``_deleted`` marks a removal) into the table; returns the days rewritten, in order.

    ``schema`` is the table's, with ``day`` last. A run is found by its key wherever it lies. Merging the same changes again changes nothing.
    """
    finish(spark, path)
    table = spark.read.schema(schema).parquet(path)
    if DELETED not in changes.columns:
        changes = changes.withColumn(DELETED, F.lit(False))
    held = materialize(changes.select(*table.columns, F.coalesce(DELETED, F.lit(False)).alias(DELETED)), "changes")
    old = table.select(key, day).join(held.select(key), key, "left_semi").select(day)
    # As many days as the calendar has: a short list, which prunes the folders that are read.
    days = [r[0] for r in old.union(held.where(~F.col(DELETED)).select(day)).distinct().orderBy(day).collect()]
    if not days:
        discard(held)
        return []
    kept = table.where(F.col(day).isin(*days)).join(held.select(key), key, "left_anti")
    staged = new_path(spark, "corrected-days")
    kept.unionByName(held.where(~F.col(DELETED)).drop(DELETED)).write.parquet(staged)
    left = {r[0] for r in spark.read.schema(schema).parquet(staged).select(day).distinct().collect()}
    note = {"staged": staged, "schema": schema, "day": day, "emptied": [str(d) for d in days if d not in left]}
    spark.range(1).select(F.lit(json.dumps(note)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/_merging")
    _put(spark, path, note)
    discard(held)
    return [str(d) for d in days]


def refresh_days(spark: SparkSession, source: DataFrame, days: list[str], path: str, summarise, day: str = "run_date") -> DataFrame:
    """Redo a summary table for the given days only: ``summarise(rows of those days)`` replaces them. Returns the table."""
    wanted = [F.lit(d).cast("date") for d in days]
    fresh = materialize(summarise(source.where(F.col(day).isin(*wanted))), "refreshed-days")
    schema = fresh.schema
    if days:
        write_table(fresh, path, partition_by=[day])
        left = {str(r[0]) for r in fresh.select(day).distinct().collect()}
        for gone in set(days) - left:
            place, fs = _fs(spark, f"{path}/{day}={gone}")
            fs.delete(place, True)
    return spark.read.schema(schema).parquet(path)
