import pytest
from pyspark.sql import functions as F

from fablens.operators import profiling, star
from fablens.sources import telemetry


def vectors(spark, columns):
    """Units from a list of sensor columns."""
    rows = [(i + 1, [c[i] for c in columns]) for i in range(len(columns[0]))]
    return spark.createDataFrame(rows, "production_id bigint, values array<double>")


def stats_of(spark, *columns, **options):
    frame = profiling.sensor_stats(telemetry.to_readings(vectors(spark, columns)), **options)
    return {r["sensor_id"]: r for r in frame.collect()}, frame


def test_all_null_sensor_is_missing_and_constant(spark):
    rows, frame = stats_of(spark, [None, None], [1.0, 2.0])
    assert rows[1]["missing_rate"] == 100.0 and rows[1]["is_constant"]
    assert not rows[2]["is_constant"]
    constant = profiling.profile_constant(frame).collect()
    assert [(r["column"], r["unique_values"]) for r in constant] == [("Attribute 1", 0)]


def test_missing_threshold_uses_the_unrounded_rate(spark):
    n = 25_000
    # 12,500 of 25,000 is exactly 50 %; 12,501 is 50.004 %, which rounds to 50.0.
    half = [None] * 12_500 + [float(i) for i in range(n - 12_500)]
    over = [None] * 12_501 + [float(i) for i in range(n - 12_501)]
    _, frame = stats_of(spark, half, over)
    high = profiling.profile_high_missing(frame).collect()
    assert [(r["column"], r["missing_pct"]) for r in high] == [("Attribute 2", 50.0)]
    flagged = star.dim_sensor(frame).where("is_quarantined").collect()
    assert [r["sensor_id"] for r in flagged] == [2]


def test_quarantine_reason_precedence(spark):
    _, frame = stats_of(spark, [None, None, 1.0], [2.0, 2.0, 2.0], [1.0, 2.0, 3.0])
    reasons = {r["sensor_id"]: r["quarantine_reason"] for r in star.dim_sensor(frame).collect()}
    assert reasons == {1: "HIGH_MISSING_RATE_GT_50_PCT", 2: "ZERO_VARIANCE_CONSTANT_FEATURE", 3: "NONE"}


def test_catalog_brings_back_silent_sensors(spark):
    units = spark.range(4)
    readings = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], "production_id bigint, sensor_code string, value double")
    catalog = telemetry.sensor_catalog(spark, ["a", "b"])
    rows = {r["sensor_code"]: r for r in profiling.sensor_stats(readings, catalog, units).collect()}
    assert rows["a"]["missing_count"] == 2
    assert rows["b"]["missing_count"] == 4 and rows["b"]["is_constant"]


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (None, 1)], "a int, b int")
    assert profiling.profile_duplicates(df).first()[0] == 1


@pytest.mark.parametrize("width", [3, 40])
def test_duplicates_wide_and_narrow_agree(spark, width):
    hot = spark.range(0, 300).select(F.lit(0).alias("k"))
    rest = spark.range(1, 601).select((F.col("id") % 500).cast("int").alias("k"))
    # A NULL moves along the row, which must not look like the same row.
    wide = hot.union(rest).select(
        *[F.when(F.col("k") % width != i, F.lit(1.0) + F.floor(F.col("k") / width)).alias(f"s{i}") for i in range(width)]
    )
    distinct = wide.distinct().count()
    assert profiling.profile_duplicates(wide).first()[0] == 900 - distinct


def test_quality_status(spark):
    def status(high, constant, fails, rows):
        column = profiling.quality_status(F.lit(high), F.lit(constant), F.lit(fails), F.lit(rows))
        return spark.range(1).select(column).first()[0]

    assert status(0, 0, 10, 100) == "PASS"
    assert status(1, 0, 10, 100) == "WARNING"
    assert status(0, 1, 10, 100) == "WARNING"
    assert status(0, 0, 9, 100) == "WARNING"


def test_missing_row_gate(spark):
    rows = vectors(spark, [[1.0, None], [1.0, None], [1.0, 1.0], [None, None]])
    gated = {r["production_id"]: r for r in profiling.missing_row_gate(rows).collect()}
    assert gated[1]["gate_tier"] is None and gated[1]["missing_pct"] == 25.0
    assert gated[2]["gate_tier"] == "TIER_1_CRITICAL" and gated[2]["missing_pct"] == 75.0


def test_integrity_violations_are_counted(spark):
    production = spark.sql("select * from values (1, timestamp_ntz'2024-01-01'), (1, null) t(production_id, run_timestamp)")
    quality = spark.sql("select * from values (1, 1, true), (9, -1, false), (9, 1, null) t(production_id, raw_label, is_defect)")
    sensors = spark.sql("select * from values ('a', 1.0d) t(sensor_code, missing_rate_pct)")
    found = {r["check"]: r["violations"] for r in star.integrity_checks(production, quality, sensors).collect()}
    assert found["production_pk"] == 1
    assert found["quality_pk"] == 1
    assert found["quality_production_fk"] == 1
    assert found["production_not_null_run_timestamp"] == 1
    assert found["quality_not_null_is_defect"] == 1
    assert found["sensor_code_unique"] == 0
