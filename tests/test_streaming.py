from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fablens.streaming import live

START = datetime(2024, 1, 1)
SCHEMA = "production_id bigint, event_ts timestamp_ntz, raw_label int"


class Feed:
    """A folder to which files are added, and a stream over it."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path, self.out = spark, str(tmp_path / "in"), str(tmp_path / "out")
        self.session = live.streaming_session(spark, 4)
        self.add([])

    def add(self, rows, partitions=1):
        df = self.spark.createDataFrame(rows, SCHEMA).repartition(partitions)
        df.write.mode("append").parquet(self.path)

    def stream(self):
        return live.with_event_time(live.open_stream(self.session, self.path))

    def run(self, build):
        return live.run_available(build(self.stream()), self.out)


def at(hours):
    return START + timedelta(hours=hours)


def test_late_unit_is_dropped_by_the_stream_only(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(i, at(i), -1) for i in range(30)])
    feed.run(live.stream_yield_windows)
    feed.add([(100, at(2), 1), (101, at(60), -1), (102, at(90), -1)])
    rows = {r["run_date"].day: r for r in feed.run(live.stream_yield_windows).collect()}
    assert rows[1]["total_units"] == 24 and rows[1]["defective_units"] == 0
    batch = spark.read.parquet(feed.path).where("event_ts < timestamp_ntz'2024-01-02'")
    assert batch.count() == 25


def test_unit_within_lateness_is_kept(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(1, at(23.5), -1), (2, at(24.2), -1)])
    feed.run(live.stream_yield_windows)
    feed.add([(3, at(23.8), 1)])
    feed.run(live.stream_yield_windows)
    feed.add([(4, at(80), -1)])
    rows = {r["run_date"].day: r for r in feed.run(live.stream_yield_windows).collect()}
    assert (rows[1]["total_units"], rows[1]["defective_units"]) == (2, 1)


@pytest.mark.parametrize("spread", [1, 16])
def test_redelivery_in_one_and_in_later_batches(spark, tmp_path, spread):
    """One unit is delivered hundreds of times, over many tasks and over restarts."""
    feed = Feed(spark, tmp_path)

    def build(stream):
        return live.stream_dedup_units(stream, spread=spread)

    hot = [(7, at(1), 1)] * 300
    feed.add(hot + [(i, at(1), -1) for i in range(100, 200)], partitions=9)
    feed.run(build)
    feed.add(hot + [(i, at(1.2), -1) for i in range(150, 250)], partitions=3)
    rows = [r["production_id"] for r in feed.run(build).collect()]
    assert sorted(rows) == [7] + list(range(100, 250))


def test_routing_of_a_stream_equals_batch(spark, folder, tmp_path):
    from fablens.plans.live import vector_stream
    from fablens.plans.risk import fixed_weights, plain_vectors, width

    session = live.streaming_session(spark, 4)
    streamed = live.run_available(
        live.stream_route_lots(vector_stream(session, folder), fixed_weights(width(spark, folder)), -2.2, 0.14), str(tmp_path / "o")
    )
    batch = live.stream_route_lots(plain_vectors(spark, folder), fixed_weights(width(spark, folder)), -2.2, 0.14)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_state_lives_in_rocksdb(spark):
    session = live.streaming_session(spark)
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != live.ROCKSDB
    assert spark.range(3).select(F.max("id")).first()[0] == 2
