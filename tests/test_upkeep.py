"""Late corrections, batch key checks and variant payloads."""

import glob
import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fablens.operators import integrity
from fablens.plans.upkeep import RUNS, daily_cells
from fablens.sources import corrections, sinks, variants

CHANGES = RUNS + ", _deleted boolean"


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = [(i, 1 if i % 5 == 0 else -1, day(i // 10)) for i in range(100)]
    rows.append((500, 1, day(20)))
    sinks.write_table(spark.createDataFrame(rows, RUNS).repartition("run_date"), path, partition_by=["run_date"])
    return path, dict((r[0], r[1:]) for r in rows)


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/run_date=*/*.parquet")}


def rows_of(spark, path):
    return {r[0]: (r[1], r[2]) for r in spark.read.schema(RUNS).parquet(path).collect()}


CHANGED = [(3, 1, day(0), False), (25, -1, day(4), False), (31, -1, day(3), True), (500, 1, day(5), False), (900, 1, day(12), None), (777, 1, day(8), True)]


def corrected(want):
    want = {**want, 3: (1, day(0)), 25: (-1, day(4)), 500: (1, day(5)), 900: (1, day(12))}
    del want[31]
    return want


def test_only_changed_days_are_rewritten(spark, table):
    path, before = table
    old = files(path)
    days = corrections.merge_corrections(spark, path, RUNS, spark.createDataFrame(CHANGED, CHANGES))
    # Old and new days of changed runs; removing a run that is not there touches nothing.
    assert days == [str(day(n)) for n in (0, 2, 3, 4, 5, 12, 20)]
    assert rows_of(spark, path) == corrected(before)
    new = files(path)
    kept = {f for f in old if new.get(f) == old[f]}
    assert {f.split("run_date=")[1][:10] for f in kept} == {str(day(n)) for n in (1, 6, 7, 8, 9)}
    assert not os.path.exists(f"{path}/run_date={day(20)}"), "a day without runs is gone"
    assert corrections.merge_corrections(spark, path, RUNS, spark.createDataFrame(CHANGED, CHANGES)) == [str(day(n)) for n in (0, 4, 5, 12)]
    assert rows_of(spark, path) == corrected(before)


def test_cells_follow_their_days(spark, table, tmp_path):
    path, _ = table
    cells = str(tmp_path / "cells")
    sinks.write_table(daily_cells(spark.read.schema(RUNS).parquet(path)), cells, partition_by=["run_date"])
    old = files(cells)
    days = corrections.merge_corrections(spark, path, RUNS, spark.createDataFrame(CHANGED, CHANGES))
    now = spark.read.schema(RUNS).parquet(path)
    found = corrections.refresh_days(spark, now, days, cells, daily_cells)
    spark.catalog.refreshByPath(cells)
    again = spark.read.schema(found.schema).parquet(cells)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, daily_cells(now).collect()))
    assert sum(files(cells).get(f) == t for f, t in old.items()) == 5


def test_a_merge_that_is_stopped_is_finished_by_the_next(spark, table, monkeypatch):
    path, before = table
    real = corrections.write_table

    def stopped(*_, **__):
        raise RuntimeError("stopped")

    monkeypatch.setattr(corrections, "write_table", stopped)
    with pytest.raises(RuntimeError):
        corrections.merge_corrections(spark, path, RUNS, spark.createDataFrame(CHANGED, CHANGES))
    monkeypatch.setattr(corrections, "write_table", real)
    # As if the swap had been interrupted after a day's old files were removed.
    for f in glob.glob(f"{path}/run_date={day(3)}/*"):
        os.remove(f)
    nothing = spark.createDataFrame([], CHANGES)
    assert corrections.merge_corrections(spark, path, RUNS, nothing) == []
    assert rows_of(spark, path) == corrected(before)
    assert not corrections.finish(spark, path)


def test_latest_change_of_a_key(spark):
    changes = spark.createDataFrame([(1, 5, 1), (1, 7, -1), (2, 1, None), (None, 9, 1)], "production_id bigint, at int, raw_label int")
    assert sorted(map(tuple, corrections.latest_changes(changes, "production_id", "at").collect())) == [(1, -1), (2, None)]


KEYS = "production_id bigint"


def ids(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], KEYS)


@pytest.fixture()
def history(spark, tmp_path):
    path, pieces = str(tmp_path / "keys"), integrity.pieces_for(60_000)
    old = spark.range(0, 40_000, 2).select(F.col("id").alias("production_id"))
    integrity.store_history(old, "production_id", path, pieces)
    return path, pieces, integrity.summarise(old, "production_id", pieces).cache()


def test_a_batch_meets_only_its_suspects(spark, history):
    path, pieces, summary = history
    batch = ids(spark, [1, 3, 3, 5, 4, 4, 39_998, None, None, 41_001])
    found = integrity.repeated_in_batch(spark, batch, "production_id", summary, path, KEYS, pieces)
    assert sorted(map(tuple, found.collect())) == [(3, 2), (4, 3), (39_998, 2)]
    fresh = spark.range(1, 40_000, 2).select(F.col("id").alias("production_id"))
    suspected = integrity.suspects(fresh, "production_id", summary, pieces)
    assert 0 < suspected.count() < 0.02 * 20_000
    # No key of history is ever cleared.
    assert integrity.suspects(spark.range(0, 40_000, 2).toDF("production_id"), "production_id", summary, pieces).count() == 20_000
    one = integrity.suspects(ids(spark, [4]), "production_id", summary, pieces)
    hit = integrity.found_in_history(spark, one, "production_id", path, KEYS, pieces)
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan or "PartitionFilters: [folder" in plan
    assert [tuple(r) for r in hit.collect()] == [(4, 1)]


def test_orphans(spark, history):
    path, pieces, summary = history
    parents = ids(spark, [1, 3])
    child = ids(spark, [1, 1, 3, 4, 7, 7, 99_999, None])
    found = integrity.orphans_in_batch(spark, child, "production_id", parents, "production_id", summary, path, KEYS, pieces)
    assert sorted(map(tuple, found.collect())) == [(7, 2), (99_999, 1)]


def test_a_history_that_grows_equals_the_full_check(spark, history):
    path, pieces, summary = history
    first, second = ids(spark, range(1, 200, 2)), ids(spark, [*range(100, 300), 700_001])
    integrity.store_history(first, "production_id", path, pieces)
    summary = integrity.merge_summaries(summary, integrity.summarise(first, "production_id", pieces))
    found = integrity.repeated_in_batch(spark, second, "production_id", summary, path, KEYS, pieces)
    want = [n for n in range(100, 300) if n % 2 == 0 or n < 200]
    assert sorted(r["key"] for r in found.collect()) == want


def test_empty_sides(spark, history):
    path, pieces, summary = history
    none = ids(spark, [])
    assert integrity.repeated_in_batch(spark, none, "production_id", summary, path, KEYS, pieces).count() == 0
    assert integrity.orphans_in_batch(spark, none, "production_id", none, "production_id", summary, path, KEYS, pieces).count() == 0
    assert integrity.summarise(none, "production_id", pieces).count() == 0


TEXTS = [
    (1, '{"a b": 1, "q\\"x": 2.5, "n": null, "t": "x", "o": {"p": [1, {"z": true}]}, "l": [], "e": {}}'),
    (2, "[1, \"two\", null]"),
    (3, "no json"),
    (4, None),
    (5, "{}"),
    (6, "7"),
]


def test_nested_payloads_keep_their_types(spark, tmp_path):
    path = str(tmp_path / "payloads")
    frame = spark.createDataFrame(TEXTS, "id int, text string")
    frame.select("id", variants.from_json_text(F.col("text")).alias("v")).write.parquet(path)
    stored = spark.read.parquet(path)
    cells = variants.explode_payload(stored, "v", "id").select("id", "key", variants.kind_of("value").alias("kind"), F.to_json("value").alias("text"))
    found = {(r["id"], r["key"]): (r["kind"], r["text"]) for r in cells.collect()}
    assert found[1, "a b"] == ("number", "1") and found[1, 'q"x'] == ("number", "2.5") and found[1, "n"] == ("null", "null")
    assert found[1, "o"] == ("object", '{"p":[1,{"z":true}]}') and found[1, "l"] == ("array", "[]") and found[1, "e"] == ("object", "{}")
    assert {k[0] for k in found} == {1, 2}
    read = stored.select("id", variants.value_at("v", "a b").alias("a"), variants.value_at("v", 'q"x').alias("q"), variants.value_at("v", "t").alias("t"))
    assert [tuple(r) for r in read.orderBy("id").collect()] == [(1, 1.0, 2.5, None), *[(i, None, None, None) for i in range(2, 7)]]


def test_a_read_asks_for_its_keys_alone(spark, tmp_path):
    path = str(tmp_path / "payloads")
    vectors = spark.createDataFrame([(i, [float(i), None, 2.0]) for i in range(50)], "production_id bigint, values array<double>")
    vectors = vectors.withColumns({"event_ts": F.lit("2024-01-01").cast("timestamp_ntz"), "raw_label": F.lit(1)})
    variants.staging_variant(vectors).write.parquet(path)
    frame = spark.read.parquet(path).select("production_id", variants.value_at("sensor_data", "Attribute 3").alias("x"))
    assert "ReadSchema: struct<production_id:bigint,sensor_data:struct<0:double>>" in frame._jdf.queryExecution().executedPlan().toString()
    assert {r["x"] for r in frame.collect()} == {2.0}
    again = variants.read_variant_payload(spark.read.parquet(path), "sensor_data", "production_id")
    assert again.count() == 100
