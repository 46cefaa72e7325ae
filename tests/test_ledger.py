"""Batches that are stopped, repeated or half written leave every row once."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fablens.streaming import ledger, live, outcomes

SCORED = "production_id bigint, p double, y int"


class Stopped(Exception):
    pass


def feed(spark, path, numbers):
    spark.createDataFrame([(i, i % 100 / 100, i % 2) for i in numbers], SCORED).coalesce(1).write.mode("append").parquet(path)


def run(session, path, out, outputs=None):
    stream = live.open_stream(session, path, schema=SCORED, maxFilesPerTrigger=1)
    ledger.start(stream, out, outputs or outcomes.alert_tables(0.14)).awaitTermination()


def ids(spark, out):
    rows = ledger.read_committed(spark, out, "alerts", "production_id bigint, risk_tier string")
    return sorted(r["production_id"] for r in rows.collect())


def test_a_stop_between_write_and_commit(spark, tmp_path, monkeypatch):
    session, path, out = live.streaming_session(spark, 2), str(tmp_path / "in"), str(tmp_path / "out")
    for start in (0, 10, 20):
        feed(spark, path, range(start, start + 10))
    real, calls = ledger.commit, []

    def stop_once(spark, path, batch_id, written):
        calls.append(batch_id)
        if calls == [0, 1]:
            raise Stopped
        return real(spark, path, batch_id, written)

    monkeypatch.setattr(ledger, "commit", stop_once)
    with pytest.raises(StreamingQueryException):
        run(session, path, out)
    # The rows of batch 1 lie there, but nobody reads them.
    assert spark.read.parquet(f"{out}/alerts").count() == 20
    assert len(ids(spark, out)) == 10
    run(session, path, out)
    assert calls == [0, 1, 1, 2]
    assert ids(spark, out) == list(range(30))
    audit = ledger.read_committed(spark, out, "audit", outcomes.AUDIT)
    assert audit.agg(F.sum("lots")).first()[0] == 30
    entries = ledger.ledger(spark, out).where("`table` = 'alerts'").select("batch_id", "rows").collect()
    assert sorted(map(tuple, entries)) == [(0, 10), (1, 10), (2, 10)]


def test_a_stop_after_the_commit(spark, tmp_path, monkeypatch):
    """The ledger has the batch, the stream has not recorded it: the repeat writes nothing."""
    session, path, out = live.streaming_session(spark, 2), str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, path, range(10))
    real, wrote = ledger.commit, []

    def stop_behind(spark, path, batch_id, written):
        real(spark, path, batch_id, written)
        raise Stopped

    monkeypatch.setattr(ledger, "commit", stop_behind)
    with pytest.raises(StreamingQueryException):
        run(session, path, out)
    monkeypatch.setattr(ledger, "commit", real)

    def outputs(batch, batch_id):
        wrote.append(batch_id)
        return outcomes.alert_tables(0.14)(batch, batch_id)

    feed(spark, path, range(10, 15))
    run(session, path, out, outputs)
    assert wrote == [1]
    assert ids(spark, out) == list(range(15))


def test_nothing_committed(spark, tmp_path):
    out = str(tmp_path / "out")
    assert ledger.ledger(spark, out).count() == 0
    assert ids(spark, out) == []


UNITS, OUTCOMES = "production_id bigint, event_ts timestamp, tool int", "production_id bigint, outcome_ts timestamp, raw_label int"
START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


def test_outcomes_by_replay_equal_the_batch_join(spark, tmp_path):
    session = outcomes.join_session(spark, 2)
    left, right, out = (str(tmp_path / n) for n in ("units", "outcomes", "out"))
    units = [(i, at(i), i % 3) for i in range(400)]
    late = [(i, at(i + i % 60), 1 if i % 7 == 0 else -1) for i in range(400) if i % 4]
    held = []
    for day in range(0, 1000, 100):
        spark.createDataFrame([u for u in units if day <= u[0] < day + 100], UNITS).coalesce(1).write.mode("append").parquet(left)
        arrived = [(i, at(i + i % 60), r) for i, _, r in late if day <= i + i % 60 < day + 100]
        # Later days only move the watermark, by units of their own.
        arrived += [(9000 + day, at(day + 99), 0)]
        spark.createDataFrame([(9000 + day, at(day + 99), 0)], UNITS).coalesce(1).write.mode("append").parquet(left)
        spark.createDataFrame(arrived, OUTCOMES).coalesce(1).write.mode("append").parquet(right)
        streams = [live.open_stream(session, p, schema=s) for p, s in ((left, UNITS), (right, OUTCOMES))]
        joined = outcomes.stream_attach_outcomes(*streams)
        query = (
            joined.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        held.append(sum(s["numRowsTotal"] for p in query.recentProgress[-1:] for s in p["stateOperators"]))
    found = spark.read.parquet(f"{out}/rows").select("production_id", "raw_label").collect()
    batch = outcomes.stream_attach_outcomes(spark.createDataFrame(units, UNITS), spark.createDataFrame(late, OUTCOMES))
    want = batch.select("production_id", "raw_label").collect()
    by = lambda rows: sorted((r[0], r[1] or 0) for r in rows if r[0] < 9000)
    assert by(found) == by(want)
    assert len([r for r in want if r[1] is None]) > 100
    # 49 hours of units and outcomes are held at most, whatever has passed.
    assert max(held) < 250
