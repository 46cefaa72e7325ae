import random
from datetime import datetime, timedelta

import pytest

from fablens.operators import split

START = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "event_ts timestamp_ntz, production_id bigint")


def expected(rows, ratio):
    ordered = sorted(rows)
    return {r[1] for r in ordered[: int(len(ordered) * ratio)]}


CASES = {
    "spread": lambda r, i: START + timedelta(seconds=r.randrange(86_400 * 40)),
    "one instant holds a third": lambda r, i: START + timedelta(days=20) if i % 3 == 0 else START + timedelta(seconds=r.randrange(86_400 * 40)),
    "all at once": lambda r, i: START,
    "microseconds apart": lambda r, i: START + timedelta(microseconds=r.randrange(50)),
    "one second": lambda r, i: START + timedelta(microseconds=r.randrange(1_000_000)),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("ratio", [0.8, 0.31])
def test_cut_equals_a_sort(spark, case, ratio):
    """The cut is found by counting alone, down to the id."""
    r = random.Random(case)
    ids = r.sample(range(-5_000_000, 10**12), 700)
    rows = [(CASES[case](r, i), key) for i, key in enumerate(ids)]
    df = frame(spark, rows)
    train, test = split.chronological_split(df, ratio=ratio)
    got = {x["production_id"] for x in train.collect()}
    assert got == expected(rows, ratio)
    assert {x["production_id"] for x in test.collect()} == set(ids) - got


def test_empty_and_tiny(spark):
    assert split.chronological_cut(frame(spark, [])).train_rows == 0
    train, test = split.chronological_split(frame(spark, [(START, 1)]))
    assert (train.count(), test.count()) == (0, 1)


def test_whole_table_as_training(spark):
    rows = [(START + timedelta(days=i), i) for i in range(10)]
    train, test = split.chronological_split(frame(spark, rows), ratio=1.0)
    assert (train.count(), test.count()) == (10, 0)


def test_published_size(spark):
    """80 % of 1,567 rows is 1,253, the rest 314."""
    rows = [(START + timedelta(minutes=5 * (i // 2)), i) for i in range(1567)]
    train, test = split.chronological_split(frame(spark, rows))
    assert (train.count(), test.count()) == (1253, 314)


def test_rows_without_time_are_test_rows(spark):
    rows = [(START + timedelta(days=i), i) for i in range(9)] + [(None, 99)]
    train, test = split.chronological_split(frame(spark, rows))
    assert train.count() == 8
    assert 99 in {r["production_id"] for r in test.collect()}
    with pytest.raises(ValueError):
        split.chronological_cut(frame(spark, rows), ratio=1.0)


def test_rows_without_id_come_last_within_an_instant(spark):
    rows = [(START, i) for i in range(9)] + [(START, None)]
    df = frame(spark, rows)
    cut = split.chronological_cut(df)
    assert (cut.id, cut.train_rows) == (7, 8)
    train, test = split.chronological_split(df)
    assert {r["production_id"] for r in train.collect()} == set(range(8))
    assert {r["production_id"] for r in test.collect()} == {8, None}
    with pytest.raises(ValueError):
        split.chronological_cut(df, ratio=1.0)


def test_split_reaches_the_scan(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    train, _ = split.chronological_split(events, "ts", "event_id")
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts" in plan and "Exchange" not in plan and "Window" not in plan


@pytest.mark.parametrize("ranges", [4, 65_536])
def test_counted_steps_and_ordered_bucket_agree(spark, monkeypatch, ranges):
    """With few ranges the cut is counted down to the id; with many the boundary bucket is put in order."""
    monkeypatch.setattr(split, "ID_RANGES", ranges)
    start = datetime(2024, 1, 1)
    stamps = [start + timedelta(days=i % 7, seconds=i % 3, microseconds=i % 2) for i in range(60)] + [start + timedelta(days=3)] * 40
    rows = [((i * 37) % 100, t) for i, t in enumerate(stamps)]
    df = spark.createDataFrame(rows, "production_id bigint, event_ts timestamp_ntz")
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    for ratio in (0.01, 0.3, 0.5, 0.55, 0.8, 0.99):
        cut = split.chronological_cut(df, ratio=ratio)
        last = ordered[int(100 * ratio) - 1]
        assert (cut.id, cut.ts, cut.train_rows) == (*last, int(100 * ratio))
