"""Telemetry files with a reject channel: nothing malformed disappears as a missing reading.

Files are scanned as text and every cell gets a typed cast of its own. A cell is present, missing (empty or a
missing-value marker) or malformed (anything else that is no finite number); malformed cells are kept with their text. Rows
with another number of fields than the header, or without a readable timestamp, go to the rejects with
their record. All of it is row-local, so files and streams share one function.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fablens import constants as K
from fablens.functions import calendar as C
from fablens.functions import numbers as N
from fablens.sources.shared import materialize

RECORD = "_record"
FIELD_COUNT, NO_TIMESTAMP, BAD_TIMESTAMP = "FIELD_COUNT", "NO_TIMESTAMP", "BAD_TIMESTAMP"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Column names of the files, from their header line alone."""
    return spark.read.option("header", True).csv(path).columns


def scan_text(reader, path: str, names: list[str], header: bool = True) -> DataFrame:
    """Every field as text; ``reader`` is ``spark.read`` or ``spark.readStream``. A record with too few or too many fields keeps its line.

    Column pruning stays off in the parser: it would count only the fields that are asked for.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, RECORD]])
    options = {"header": header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD, "columnPruning": False}
    return reader.options(**options).schema(schema).csv(path).withColumn("_file", F.col("_metadata.file_path"))


def is_missing(text: Column) -> Column:
    return text.isNull() | F.trim(text).isin(*K.MISSING_TEXTS)


def number(text: Column) -> Column:
    """The finite number that the text spells, else NULL."""
    plain = F.trim(text)
    value = F.when(plain.rlike(NUMBER), plain.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def classify(scanned: DataFrame, names: list[str], ts: str = "timestamp") -> DataFrame:
    """``event_ts``, ``values``, ``malformed`` (sensor and text of each such cell), ``reason`` and ``record`` of a rejected row, ``_file``.

    A kept row has no reason; a rejected one has no values. Position i of ``values`` is sensor i+1 in the order of ``names``
    without ``ts``; malformed cells are NULL there.
    """
    sensors = [n for n in names if n != ts]
    texts = F.array(*[F.col(_quoted(n)) for n in sensors])
    bad = F.transform("_texts", lambda t, i: F.when(~is_missing(t) & number(t).isNull(), F.struct((i + 1).alias("sensor_id"), t.alias("text"))))
    stamp = F.col(_quoted(ts))
    parsed = C.parse_ts_mixed(F.trim(stamp))
    reason = (
        F.when(F.col(RECORD).isNotNull(), FIELD_COUNT).when(is_missing(stamp), NO_TIMESTAMP).when(parsed.isNull(), BAD_TIMESTAMP)
    )
    line = F.coalesce(F.col(RECORD), F.concat_ws(",", *[F.coalesce(F.col(_quoted(n)), F.lit("")) for n in names]))
    kept = F.col("reason").isNull()
    marked = scanned.select(parsed.alias("event_ts"), texts.alias("_texts"), reason.alias("reason"), line.alias("_line"), "_file")
    return marked.select(
        "event_ts",
        F.when(kept, F.transform("_texts", number)).alias("values"),
        F.when(kept, F.array_compact(bad)).alias("malformed"),
        "reason",
        F.when(~kept, F.col("_line")).alias("record"),
        "_file",
    )


@dataclass
class CheckedTelemetry:
    """Classified rows, written once; every view below reads only its own columns of them."""

    rows: DataFrame
    sensors: list[str]

    def accepted(self) -> DataFrame:
        """``event_ts``, ``values`` and ``_file`` of the rows that are kept."""
        return self.rows.where("reason is null").select("event_ts", "values", "_file")

    def rejected(self) -> DataFrame:
        return self.rows.where("reason is not null").select("reason", "record", "_file")

    def malformed_cells(self) -> DataFrame:
        """One row per malformed cell of a kept row."""
        cells = self.rows.where(F.size("malformed") > 0).select("event_ts", "_file", F.explode("malformed").alias("c"))
        return cells.select("event_ts", "c.sensor_id", self._code(F.col("c.sensor_id")), "c.text", "_file")

    def _code(self, sensor_id: Column) -> Column:
        codes = F.array(*[F.lit(s) for s in self.sensors])
        return F.get(codes, sensor_id - 1).alias("sensor_code")

    def cell_counts(self, by_file: bool = True) -> DataFrame:
        """Per sensor (and file): ``rows``, ``missing``, ``malformed`` and the type that the column's cells leave it, ``double`` or ``string``.

        Two counts folded in each task before they are shuffled; one row per file and sensor is joined.
        """
        keys = ["_file", "sensor_id"] if by_file else ["sensor_id"]
        cells = self.rows.where("reason is null").select("_file", F.posexplode("values").alias("_pos", "value"))
        counted = cells.groupBy(*[(F.col("_pos") + 1).alias(k) if k == "sensor_id" else F.col(k) for k in keys]).agg(
            F.count("*").alias("rows"), F.count("value").alias("present")
        )
        bad = self.malformed_cells().groupBy(*keys).agg(F.count("*").alias("malformed"))
        malformed = F.coalesce("malformed", F.lit(0).cast("bigint"))
        return counted.join(bad, keys, "left").select(
            *keys,
            self._code(F.col("sensor_id")),
            "rows",
            (F.col("rows") - F.col("present") - malformed).alias("missing"),
            malformed.alias("malformed"),
            F.when(malformed > 0, "string").otherwise("double").alias("dtype"),
        )

    def sensor_quality(self, max_missing: float = K.MAX_MISSING_PCT) -> DataFrame:
        """Per sensor over all files: counts, unrounded shares, and whether missing cells alone exceed the limit."""
        counts = self.cell_counts(by_file=False)
        share = lambda c: N.safe_divide(F.col(c), F.col("rows")) * 100
        return counts.withColumns(
            {"missing_rate": share("missing"), "malformed_rate": share("malformed"), "is_high_missing": share("missing") > max_missing}
        )


def read_checked(spark: SparkSession, path: str, ts: str = "timestamp", names: list[str] | None = None) -> CheckedTelemetry:
    """Scan, classify and write once. Without ``names`` the files have a header line; with them they have none."""
    header = names is None
    names = names or header_names(spark, path)
    rows = materialize(classify(scan_text(spark.read, path, names, header), names, ts), "checked-telemetry")
    return CheckedTelemetry(rows, [n for n in names if n != ts])


def stream_checked(spark: SparkSession, path: str, names: list[str], ts: str = "timestamp", header: bool = False, **options) -> DataFrame:
    """The classified rows of files as they arrive; see ``streaming.ledger`` for a sink that keeps every batch once."""
    return classify(scan_text(spark.readStream.options(**options), path, names, header), names, ts)
