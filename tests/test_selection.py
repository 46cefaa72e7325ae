import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from fablens.operators import selection
from fablens.sources import telemetry


def readings(spark, groups):
    rows = [(k, v) for k, values in groups.items() for v in values]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "sensor_id int, value double").repartition(7)


def medians(spark, groups):
    return {r["sensor_id"]: r["median"] for r in selection.fit_medians(readings(spark, groups)).collect()}


def test_medians_of_small_groups(spark):
    groups = {1: [3.0], 2: [1.0, 2.0], 3: [5.0, 1.0, 9.0], 4: [4.0, 1.0, 3.0, 2.0], 5: [None, None], 6: [None, 7.0]}
    got = medians(spark, groups)
    assert got == {1: 3.0, 2: 1.5, 3: 5.0, 4: 2.5, 5: None, 6: 7.0}


def test_medians_with_a_dominant_value_and_a_dominant_sensor(spark):
    r = random.Random(3)
    groups = {
        1: [r.gauss(0, 1) for _ in range(60_000)],
        2: [1.0] * 20_000 + [r.random() for _ in range(19_999)],
        3: [r.paretovariate(0.3) for _ in range(5_001)],
        4: [0.0] * 500 + [1.0] * 500,
    }
    got = medians(spark, groups)
    for key, values in groups.items():
        assert got[key] == statistics.median(values), key


def test_medians_merge_many_partitions(spark):
    """Sorted input makes each partition's sketch cover another value range."""
    df = spark.range(0, 200_001, 1, 64).select(F.lit(1).alias("sensor_id"), F.col("id").cast("double").alias("value"))
    assert selection.fit_medians(df).first()["median"] == 100_000.0


def test_impute_long_and_array_agree(spark):
    rows = [(i, [float(i), None if i % 3 else 1.0 * i, None]) for i in range(1, 10)]
    vectors = spark.createDataFrame(rows, "production_id bigint, values array<double>")
    long = telemetry.to_readings(vectors)
    fitted = selection.fit_medians(long)
    a = selection.impute(long, fitted).select("production_id", "sensor_id", "value").collect()
    b = telemetry.to_readings(selection.impute_vectors(vectors, fitted, 3)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) or {tuple(x) for x in a} == {tuple(x) for x in b}


def mutual(pairs, bins=10):
    """Plain formula over binned values."""
    low, high = min(v for v, _ in pairs), max(v for v, _ in pairs)
    cells = {}
    for v, y in pairs:
        b = 0 if high == low else min(int((v - low) / (high - low) * bins), bins - 1)
        cells[b, y] = cells.get((b, y), 0) + 1
    n = len(pairs)
    total = 0.0
    for (b, y), c in cells.items():
        nb = sum(k for (b2, _), k in cells.items() if b2 == b)
        ny = sum(k for (_, y2), k in cells.items() if y2 == y)
        total += c / n * math.log(c * n / (nb * ny))
    return total


def test_mutual_information(spark):
    r = random.Random(5)
    data = {1: [(r.random(), r.randrange(2)) for _ in range(500)], 2: [(y + r.random() / 2, y) for y in [0, 1] * 200], 3: [(4.0, i % 2) for i in range(50)]}
    rows = [(k, v, y) for k, pairs in data.items() for v, y in pairs]
    df = spark.createDataFrame(rows, "sensor_id int, value double, y int")
    got = {x["sensor_id"]: x["mutual_info"] for x in selection.mutual_information(df).collect()}
    for key, pairs in data.items():
        assert got[key] == pytest.approx(mutual(pairs), abs=1e-12)


def test_composite_score_of_published_rows(spark):
    """Rows with the largest importance (60) and the largest information (289) fix the scale."""
    rows = [
        (60, 0.03378971979627762, 0.018277293583225385, 0.8443792257436483),
        (478, 0.009326658614932534, 0.03025573357373945, 0.4322158522123324),
        (66, 0.008197993832585907, 0.028400537724148522, 0.39417913551499),
        (289, 0.004293689380382631, 0.03797768028416537, 0.38894961498316255),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "sensor_id int, rf_importance double, mutual_info double")
    got = {r["sensor_id"]: r["composite_score"] for r in selection.composite_rank(df).collect()}
    assert got == {r[0]: pytest.approx(r[3], abs=1e-12) for r in rows}


def test_no_information_leaves_the_importance(spark):
    df = spark.createDataFrame([(1, 0.4, 0.0), (2, 0.2, 0.0)], "sensor_id int, rf_importance double, mutual_info double")
    got = {r["sensor_id"]: r["composite_score"] for r in selection.composite_rank(df).collect()}
    assert got == {1: pytest.approx(0.7), 2: pytest.approx(0.35)}


def test_top_k_ties_go_to_the_lower_id(spark):
    df = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, 0.9)], "sensor_id int, composite_score double")
    assert [r["sensor_id"] for r in selection.select_top_k(df, 2).collect()] == [2, 1]


def test_matrix_from_arrays_and_from_readings_agree(spark):
    rows = [(i, [float(i), float(i * 2), float(i * 3)]) for i in range(5)]
    vectors = spark.createDataFrame(rows, "production_id bigint, values array<double>")
    a = selection.feature_matrix(vectors, [3, 1]).orderBy("production_id").collect()
    b = selection.pivot_readings(telemetry.to_readings(vectors), [3, 1]).orderBy("production_id").collect()
    assert [tuple(x) for x in a] == [tuple(x) for x in b]


def test_null_group_and_missed_bracket(spark, monkeypatch):
    """A NULL group has a median of its own; a bracket that misses is widened."""
    monkeypatch.setattr(selection, "REACH", 1e-4)
    monkeypatch.setattr(selection, "SKETCH", 2)
    rows = [(g, float(v)) for g in (None, 1, 2) for v in range(1, 1001 + (g or 0))] + [(3, None)]
    df = spark.createDataFrame(rows, "sensor_id int, value double")
    got = {r["sensor_id"]: r["median"] for r in selection.fit_medians(df).collect()}
    assert got == {None: 500.5, 1: 501.0, 2: 501.5, 3: None}


def test_medians_move_no_raw_readings_by_group(spark, monkeypatch):
    """With broadcasts off, readings meet their bracket by group and slot."""
    plans = []
    real = selection.materialize
    monkeypatch.setattr(
        selection, "materialize", lambda df, label: (plans.append((label, df._jdf.queryExecution().executedPlan().toString())), real(df, label))[1]
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(5000).selectExpr("cast(id % 3 as int) AS tool", "cast(id AS double) AS value")
        selection.fit_medians(df, by="tool")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    counted = next(p for label, p in plans if label == "median-counts")
    assert "_at" in counted.split("SortMergeJoin")[1]
