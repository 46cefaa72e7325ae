"""Profiles from daily states, and neighbour information against a plain version."""

import math
import random
import shutil
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fablens.operators import neighbours, profile_states, profiling

READINGS = "run_date date, sensor_id int, value double"
COLUMNS = ["sensor_id", "rows", "missing_count", "is_constant", "mean", "std", "min", "max"]


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


def readings(days, seed=0):
    r = random.Random(seed)
    rows = []
    for d in days:
        for _ in range(60):
            rows.append((day(d), 1, 1e6 + r.gauss(0, 1e-3)))  # a large mean, a small spread
            rows.append((day(d), 2, None if r.random() < 0.5 or d == 1 else r.random()))
            rows.append((day(d), 3, None))
            rows.append((day(d), 4, 5.0))
            rows.append((day(d), 5, r.choice([0.0, -0.0])))
    return rows


def alike(left, right):
    for a, b in zip(sorted(left), sorted(right), strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or (isinstance(x, float) and x == pytest.approx(y, rel=1e-7, abs=1e-15)), (a, b)


def test_states_merge_to_the_direct_profile(spark, tmp_path):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "states")
    rows = readings(range(5))
    spark.createDataFrame(rows, READINGS).write.partitionBy("run_date").parquet(raw)
    all_raw = spark.read.schema(READINGS).parquet(raw)
    profile_states.store_states(profile_states.profile_states(all_raw.where("run_date < date'2024-01-05'")), path)
    # Adding a day reads that day alone: the others are not even there any more.
    for n in range(4):
        shutil.rmtree(f"{raw}/run_date={day(n)}")
    left = spark.read.schema(READINGS).parquet(raw)
    states = profile_states.store_states(profile_states.profile_states(left.where("run_date = date'2024-01-05'")), path)
    found = profile_states.states_profile(profile_states.merge_states(states))
    direct = profiling.sensor_stats(spark.createDataFrame(rows, READINGS), exact_unique=True)
    alike(map(tuple, found.select(COLUMNS).collect()), map(tuple, direct.select(COLUMNS).collect()))
    unique = {r["sensor_id"]: r["unique_count"] for r in found.collect()}
    assert unique[3] == 0 and unique[4] == 1 and unique[5] == 1 and abs(unique[1] - 300) <= 15
    assert {r["sensor_id"]: r["median_estimate"] for r in found.collect()}[4] == 5.0


def test_a_corrected_day_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "states")
    first, again = readings([0, 1]), readings([1], seed=9)
    profile_states.store_states(profile_states.profile_states(spark.createDataFrame(first, READINGS)), path)
    states = profile_states.store_states(profile_states.profile_states(spark.createDataFrame(again, READINGS)), path)
    want = [r for r in first if r[0] == day(0)] + again
    found = profile_states.states_profile(profile_states.merge_states(states))
    alike(map(tuple, found.select(COLUMNS).collect()), map(tuple, profiling.sensor_stats(spark.createDataFrame(want, READINGS)).select(COLUMNS).collect()))
    one = profile_states.states_profile(profile_states.merge_states(states.where(F.col("run_date") == F.lit(day(1)))))
    alike(map(tuple, one.select(COLUMNS).collect()), map(tuple, profiling.sensor_stats(spark.createDataFrame(again, READINGS)).select(COLUMNS).collect()))


def test_merged_states_merge_again(spark):
    rows = readings(range(4))
    states = profile_states.profile_states(spark.createDataFrame(rows, READINGS))
    halves = [profile_states.merge_states(states.where(c)) for c in ("run_date < date'2024-01-03'", "run_date >= date'2024-01-03'")]
    both = profile_states.merge_states(halves[0].unionByName(halves[1]))
    alike(*[map(tuple, profile_states.states_profile(m).select(COLUMNS).collect()) for m in (both, profile_states.merge_states(states))])


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def brute(rows, k=3):
    out = {}
    for sensor in {s for s, _, _ in rows}:
        own = [(v, y) for s, y, v in rows if s == sensor and v is not None and y is not None]
        sizes = {y: sum(z == y for _, z in own) for _, y in own}
        own = [(v, y) for v, y in own if sizes[y] > 1]
        if not own:
            continue
        total = psi(len(own))
        for i, (v, y) in enumerate(own):
            near = min(k, sizes[y] - 1)
            radius = sorted(abs(v - w) for j, (w, z) in enumerate(own) if j != i and z == y)[near - 1] * (1 - 1e-9)
            m = sum(v - radius <= w <= v + radius for w, _ in own)
            total += (psi(near) - psi(sizes[y]) - psi(m)) / len(own)
        out[sensor] = max(total, 0.0)
    return out


@pytest.mark.parametrize("slices", ["2", "40"])
def test_neighbour_information_equals_the_plain_version(spark, slices):
    r = np.random.default_rng(1)
    rows = [(1, int(i % 3 == 0), float(r.normal() + (i % 3 == 0))) for i in range(300)]
    rows += [(2, int(i % 4 == 0), float(r.integers(0, 6))) for i in range(200)]  # ties
    rows += [(3, int(i < 2), 1.0 if i % 3 else float(i)) for i in range(90)]  # a hot value, a label of two
    rows += [(4, int(i == 0), float(i)) for i in range(20)]  # a label of one
    rows += [(5, i % 2, 7.0) for i in range(30)]  # constant
    rows += [(6, 0, 1.0), (7, 0, None), (7, 1, None), (8, 0, 1.0), (8, 0, 2.0), (8, None, 1.0), (9, 0, -0.0), (9, 0, 0.0), (9, 1, 0.0), (9, 1, 3.0)]
    df = spark.createDataFrame(rows, "sensor_id int, y int, value double")
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r["sensor_id"]: r["mutual_info"] for r in neighbours.neighbour_information(df).collect()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    want = brute(rows)
    assert set(found) == set(want)
    for s, v in want.items():
        assert found[s] == pytest.approx(v, abs=1e-9), s


def test_digamma(spark):
    numbers = [1, 2, 3, 10, 1000, 10**7]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    got = [r[0] for r in df.select(neighbours.digamma(F.col("n"))).collect()]
    want = [psi(n) if n < 10**4 else math.log(n) - 1 / (2 * n) - 1 / (12 * n * n) for n in numbers]
    assert got == pytest.approx(want, abs=1e-12)
