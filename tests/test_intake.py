import pytest
from pyspark.sql import functions as F

from fablens.plans.intake import intake_tables
from fablens.sources import rejects
from fablens.streaming import ledger, live

GOOD = "19/07/2008 11:55:00"
FILES = {
    "a.csv": [
        "timestamp,x,y z",
        f"{GOOD},1.5,2",
        f"{GOOD}, -3e2 ,NaN",
        f"{GOOD},abc,",
        f"{GOOD},1",
        f"{GOOD},1,2,3",
        "never,1,2",
        ",1,2",
        "2008-07-20 10:00,1f,0x10",
    ],
    "b.csv": ["timestamp,x,y z", f"{GOOD},inf,1e999", f'{GOOD},"7",n/a', f'{GOOD},"1,5",.5', "20/07/2008,5.,-"],
}


@pytest.fixture()
def files(tmp_path):
    for name, lines in FILES.items():
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path / "in")


def cells(found):
    return sorted((r["sensor_code"], r["text"]) for r in found.malformed_cells().collect())


def test_cells_and_rows_are_told_apart(spark, files):
    found = rejects.read_checked(spark, files)
    values = sorted((str(r["values"]) for r in found.accepted().collect()))
    assert values == sorted(["[1.5, 2.0]", "[-300.0, None]", "[None, None]", "[None, None]", "[None, None]", "[7.0, None]", "[None, 0.5]", "[5.0, None]"])
    assert cells(found) == sorted([("x", "abc"), ("x", "1f"), ("y z", "0x10"), ("x", "inf"), ("y z", "1e999"), ("x", "1,5"), ("y z", "-")])
    assert sorted((r["reason"], r["record"]) for r in found.rejected().collect()) == sorted(
        [("FIELD_COUNT", f"{GOOD},1"), ("FIELD_COUNT", f"{GOOD},1,2,3"), ("BAD_TIMESTAMP", "never,1,2"), ("NO_TIMESTAMP", ",1,2")]
    )
    counts = {(r["_file"].rsplit("/", 1)[1], r["sensor_code"]): (r["rows"], r["missing"], r["malformed"], r["dtype"]) for r in found.cell_counts().collect()}
    assert counts == {
        ("a.csv", "x"): (4, 0, 2, "string"),
        ("a.csv", "y z"): (4, 2, 1, "string"),
        ("b.csv", "x"): (4, 0, 2, "string"),
        ("b.csv", "y z"): (4, 1, 2, "string"),
    }
    total = {r["sensor_code"]: r for r in found.sensor_quality().collect()}
    assert (total["x"]["missing_rate"], total["x"]["malformed_rate"], total["x"]["is_high_missing"]) == (0.0, 50.0, False)


def test_the_stream_equals_the_batch(spark, files, tmp_path):
    session, out = live.streaming_session(spark), str(tmp_path / "out")
    names = rejects.header_names(spark, files)
    ledger.start(rejects.stream_checked(session, files, names, header=True, maxFilesPerTrigger=1), out, intake_tables).awaitTermination()
    batch = rejects.read_checked(spark, files)
    kept = ledger.read_committed(spark, out, "accepted", batch.rows.select("event_ts", "values", "malformed", "_file").schema)
    streamed = rejects.CheckedTelemetry(kept.withColumn("reason", F.lit(None).cast("string")), batch.sensors)
    assert cells(streamed) == cells(batch)
    assert sorted(map(tuple, streamed.cell_counts().collect())) == sorted(map(tuple, batch.cell_counts().collect()))
    bad = ledger.read_committed(spark, out, "rejected", batch.rejected().schema)
    assert sorted(map(tuple, bad.drop("batch").collect())) == sorted(map(tuple, batch.rejected().collect()))


def test_no_files_worth_reading(spark, tmp_path):
    (tmp_path / "only.csv").write_text("timestamp,x\n")
    found = rejects.read_checked(spark, str(tmp_path / "only.csv"))
    assert found.accepted().count() == found.rejected().count() == found.sensor_quality().count() == 0


def test_a_short_row_is_seen_when_few_columns_are_read(spark, files):
    """Only the sensors are asked for, yet the parser counts all fields."""
    rows = rejects.classify(rejects.scan_text(spark.read, files, ["timestamp", "x", "y z"]), ["timestamp", "x", "y z"])
    assert rows.where("reason = 'FIELD_COUNT'").select("record").count() == 2
