import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from fablens import schema
from fablens.functions import calendar as C
from fablens.operators import profiling, star
from fablens.sources import bindings, shared, sinks, telemetry


def write_csv(path, lines):
    path.write_text("\n".join(lines) + "\n")


def test_labels_attach_by_position_over_many_files(spark, tmp_path):
    """Files of unequal size: position follows file name and line, not task order."""
    features, labels = tmp_path / "f", tmp_path / "l"
    features.mkdir(), labels.mkdir()
    sizes, row = [3, 500, 1, 40], 0
    for i, size in enumerate(sizes):
        write_csv(features / f"part-{i}.csv", ["timestamp,a"] + [f"2024-01-01 00:00,{row + j}.5" for j in range(size)])
        row += size
    write_csv(labels / "part-0.csv", ["class"] + [str(1 if j % 5 == 0 else -1) for j in range(100)])
    write_csv(labels / "part-1.csv", ["class"] + [str(1 if j % 5 == 0 else -1) for j in range(100, row)])
    wide = telemetry.attach_labels(
        telemetry.read_telemetry(spark, str(features)), telemetry.read_telemetry(spark, str(labels), ts=None)
    )
    rows = wide.orderBy("production_id").collect()
    assert [r["production_id"] for r in rows] == list(range(1, row + 1))
    assert [r["a"] for r in rows] == [j + 0.5 for j in range(row)]
    assert [r["raw_label"] for r in rows] == [1 if j % 5 == 0 else -1 for j in range(row)]


def test_one_large_file_is_numbered_across_splits(spark, tmp_path):
    write_csv(tmp_path / "f.csv", ["a"] + [str(i) for i in range(20_000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = telemetry.read_telemetry(spark, str(tmp_path / "f.csv"), ts=None)
        assert df.rdd.getNumPartitions() > 3
        numbered, rows = telemetry.with_position(df)
        assert rows == 20_000
        assert numbered.where(F.col("_position") != F.col("a") + 1).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_positions_survive_other_splits_later(spark, tmp_path):
    """The split size may change between the steps; rows are numbered from what was written once."""
    write_csv(tmp_path / "f.csv", ["a"] + [str(i) for i in range(20_000)])
    write_csv(tmp_path / "l.csv", ["class"] + [str(i % 2) for i in range(20_000)])
    features = telemetry.read_telemetry(spark, str(tmp_path / "f.csv"), ts=None)
    labels = telemetry.read_telemetry(spark, str(tmp_path / "l.csv"), ts=None)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
        joined = telemetry.attach_labels(features, labels)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
        assert joined.count() == 20_000
        assert joined.where((F.col("production_id") != F.col("a") + 1) | (F.col("raw_label") != F.col("a") % 2)).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_unequal_files_raise(spark, tmp_path):
    write_csv(tmp_path / "f.csv", ["a", "1", "2", "3"])
    write_csv(tmp_path / "l.csv", ["class", "1", "-1"])
    features, labels = (telemetry.read_telemetry(spark, str(tmp_path / n), ts=None) for n in ("f.csv", "l.csv"))
    with pytest.raises(ValueError):
        telemetry.attach_labels(features, labels)


def test_uneven_arrays_raise(spark):
    df = spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "values array<double>")
    with pytest.raises(ValueError):
        telemetry.vector_width(df)


def test_shared_folder(spark, tmp_path):
    """Only the files of tables that were not discarded remain, and cleanup removes them."""
    import os

    base = shared.shared_folder(spark)
    before = set(os.listdir(f"{base}/fablens")) if os.path.isdir(f"{base}/fablens") else set()
    one, two = shared.materialize(spark.range(3), "one"), shared.materialize(spark.range(4), "two")
    shared.discard(one)
    left = set(os.listdir(f"{base}/fablens")) - before
    assert len(left) == 1 and next(iter(left)).startswith("two-")
    assert two.count() == 4
    mine = shared._written.pop(spark.sparkContext.applicationId)
    shared._written[spark.sparkContext.applicationId] = [two.written_to]
    assert shared.cleanup(spark) == 1
    assert set(os.listdir(f"{base}/fablens")) == before
    shared._written[spark.sparkContext.applicationId] = [p for p in mine if p != two.written_to]


def test_nan_and_empty_cells_are_null(spark, tmp_path):
    write_csv(tmp_path / "f.csv", ["timestamp,a,b", "2024-01-01 00:00,NaN,1", "2024-01-01 00:00,,2"])
    df = telemetry.read_telemetry(spark, str(tmp_path / "f.csv"))
    assert telemetry.sensor_columns(df) == ["a", "b"]
    assert df.where("a is null").count() == 2


def test_labels_attach_by_key(spark):
    features = spark.createDataFrame([(2, 1.0), (1, 2.0)], "production_id bigint, a double")
    labels = spark.createDataFrame([(1, -1), (2, 1)], "production_id bigint, raw_label int")
    got = {r["production_id"]: r["raw_label"] for r in telemetry.attach_labels(features, labels, "production_id").collect()}
    assert got == {1: -1, 2: 1}
    assert telemetry.attach_labels(features, labels.limit(0), "production_id").count() == 2


def test_payload_drops_nulls_and_reads_back(spark):
    rows = [(1, [1.5, None, -2.0]), (2, [None, None, None])]
    vectors = spark.createDataFrame(rows, "production_id bigint, values array<double>").withColumns(
        {"event_ts": F.lit("2024-01-01").cast("timestamp_ntz"), "raw_label": F.lit(1)}
    )
    staged = telemetry.staging_payload(vectors)
    text = {r["production_id"]: r["sensor_data"] for r in staged.collect()}
    assert text[2] == "{}"
    back = telemetry.read_payload(staged, "sensor_data", "production_id").collect()
    assert {(r["sensor_code"], r["value"]) for r in back} == {("Attribute 1", 1.5), ("Attribute 3", -2.0)}


def test_partitioned_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("a", 1), ("b", 2)], "day string, n int")
    sinks.write_table(both, path, partition_by=["day"])
    after = sinks.write_table(spark.createDataFrame([("a", 9)], "day string, n int"), path, partition_by=["day"])
    assert {(r["day"], r["n"]) for r in after.collect()} == {("a", 9), ("b", 2)}
    replaced = sinks.write_table(spark.createDataFrame([("c", 3)], "day string, n int"), path + "2")
    assert replaced.count() == 1


def test_bucketed_star_joins_without_exchange(spark, folder):
    units = bindings.units(bindings.table(spark, folder, "events"))
    production = sinks.write_bucketed(star.dim_production_entity(units), "dim_production_bucketed", "production_id", 4)
    quality = sinks.write_bucketed(star.fact_quality_outcome(units), "fact_quality_bucketed", "production_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = star.star_join(production, quality)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == units.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table dim_production_bucketed")
        spark.sql("drop table fact_quality_bucketed")


def test_tables_have_the_declared_schemas(spark, folder):
    from fablens.plans import QUERIES
    from fablens.plans.warehouse import masked, masked_stats

    def shape(df):
        return [(n, t) for n, t in df.dtypes]

    def declared(text):
        return shape(spark.createDataFrame([], text))

    assert shape(QUERIES["dim_production_entity"](spark, folder)) == declared(schema.PRODUCTION)
    assert shape(QUERIES["fact_quality_outcome"](spark, folder)) == declared(schema.QUALITY)
    assert shape(star.dim_sensor(masked_stats(spark, folder))) == declared(schema.SENSOR)
    assert shape(star.staging_raw(telemetry.staging_payload(masked(spark, folder)), "x")) == declared(schema.STAGING)
    assert shape(QUERIES["operational_alerts"](spark, folder)) == declared(schema.ALERTS)


def test_shared_folder_is_the_sessions(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared.shared_folder(spark) == named
    assert shared.new_path(spark, "x").startswith(named)


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError):
        shared.shared_folder(Session())


class Clustered:
    """The session, or a part of it, as one outside local mode sees it."""

    def __init__(self, real, **changed):
        self.real, self.changed = real, changed

    def __getattr__(self, name):
        return self.changed[name] if name in self.changed else getattr(self.real, name)


def clustered(spark, folder, **changed):
    class Conf:
        def get(self, *_):
            return folder

    return Clustered(spark, sparkContext=Clustered(spark.sparkContext, master="spark://host:7077"), conf=Conf(), **changed)


def test_a_cluster_takes_a_bare_path_that_is_shared(spark, tmp_path):
    session = clustered(spark, f"{tmp_path}/")
    assert shared.shared_folder(session) == str(tmp_path)
    assert not any((tmp_path / "fablens").iterdir())
    assert shared.new_path(session, "x").startswith(f"{tmp_path}/fablens/x-")


def test_a_cluster_refuses_a_bare_path_that_loses_rows(spark, tmp_path):
    """Some tasks' files are not where the driver looks for them."""
    session = clustered(spark, str(tmp_path), range=lambda *_: spark.range(3))
    with pytest.raises(RuntimeError, match="all share"):
        shared.shared_folder(session)


def test_executors_that_join_later_are_probed(spark, tmp_path, monkeypatch):
    there, probes = {"driver:1"}, []
    monkeypatch.setattr(shared, "_executors", lambda _: set(there))
    monkeypatch.setattr(shared, "_sees_all_files", lambda _, folder, executors: executors < 3 and not probes.append(executors))
    session = clustered(spark, str(tmp_path))
    for joins in ("a:1", "b:1"):
        shared.shared_folder(session)
        shared.shared_folder(session)
        there.add(joins)
    assert probes == [1, 2]
    with pytest.raises(RuntimeError, match="all share"):
        shared.shared_folder(session)


ON_A_CLUSTER = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from fablens.operators import selection
conf = {"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "700m", "spark.checkpoint.dir": sys.argv[2] + "/kept",
        "spark.local.dir": sys.argv[2] + "/local", "spark.sql.warehouse.dir": sys.argv[2] + "/warehouse", "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "2", "spark.driver.host": "127.0.0.1"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
rows = spark.range(0, 1001, 1, 4).select((F.col("id") % 2).alias("tool"), F.col("id").cast("double").alias("value"))
print("MEDIANS", sorted((r["tool"], r["median"]) for r in selection.fit_medians(rows, by="tool").collect()))
"""


def test_tables_are_kept_on_a_cluster(tmp_path):
    """Two executors of their own and a bare path, as in spark-defaults.conf."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ended = subprocess.run(
        [sys.executable, "-c", ON_A_CLUSTER, root, str(tmp_path)], capture_output=True, text=True, timeout=180
    )
    assert "MEDIANS [(0, 500.0), (1, 500.0)]" in ended.stdout, ended.stderr[-2000:]


def test_materialized_size_is_known(spark):
    small = shared.materialize(spark.range(10), "ten")
    size = small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(size)) < 1_000_000


def test_published_summary_of_a_590_sensor_file(spark, tmp_path):
    """A wide file with the published counts: 116 frozen sensors, 28 mostly missing, 104 fails."""
    width, rows = 590, 1567
    sensors = []
    for s in range(width):
        reading = F.col("id") * (s + 1) % 997 / F.lit(8.0)
        if s < 116:
            reading = F.lit(4.0)
        elif s < 144:
            reading = F.when(F.col("id") % 10 < 2, reading)
        sensors.append(reading.alias(f"Attribute {s + 1}"))
    ts = F.timestamp_add("MINUTE", F.col("id").cast("int") * 83, F.lit("2008-07-19 11:55:00").cast("timestamp_ntz"))
    base = spark.range(0, rows, 1, 4)
    wide = base.select(F.date_format(ts, "dd/MM/yyyy HH:mm:ss").alias("timestamp"), *sensors)
    sinks.write_report(wide, str(tmp_path / "f"))
    sinks.write_report(base.select(F.when(F.col("id") < 104, 1).otherwise(-1).alias("class")), str(tmp_path / "l"))

    features = telemetry.read_telemetry(spark, str(tmp_path / "f"))
    names = telemetry.sensor_columns(features)
    assert len(names) == width
    joined = telemetry.attach_labels(features, telemetry.read_telemetry(spark, str(tmp_path / "l"), ts=None))
    joined = joined.withColumn("event_ts", C.parse_ts_mixed(F.col("timestamp")))
    vectors = telemetry.to_vectors(joined, names, ["production_id", "event_ts", "raw_label"])
    vectors = shared.materialize(vectors, "line-vectors")
    stats = profiling.sensor_stats(telemetry.to_readings(vectors))
    summary = profiling.quality_summary(
        stats, vectors, profiling.profile_duplicates(vectors.select("event_ts", "values")), "LINE"
    ).first()
    assert summary["rows"] == 1567 and summary["features"] == 591
    assert summary["duplicate_rows"] == 0
    assert summary["constant_columns"] == 116 and summary["columns_gt_50_pct_missing"] == 28
    assert (summary["pass_observations"], summary["fail_observations"]) == (1463, 104)
    assert summary["failure_rate_pct"] == 6.64
    assert str(summary["timestamp_start"]) == "2008-07-19 11:55:00"
    assert summary["quality_status"] == "WARNING"
    assert star.candidate_sensors(star.dim_sensor(stats)).count() == 446


def test_cleanup_drops_catalog_tables(spark, folder):
    from fablens.plans import QUERIES

    QUERIES["star_join_bucketed"](spark, folder).count()
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("fablens_")]
    shared.cleanup(spark)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("fablens_")]
