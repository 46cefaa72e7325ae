"""Raw telemetry: wide files in, unit vectors and long readings out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fablens.functions import numbers as N
from fablens.sources.shared import literal_table, materialize


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_telemetry(spark: SparkSession, path: str, ts: str | None = "timestamp", fmt: str = "csv") -> DataFrame:
    """Scan a wide file: ``ts`` as text, every other column as double, NaN as NULL.

    Only the CSV header is looked at to name the columns; types are declared,
    so there is no inference pass over the data.
    """
    if fmt != "csv":
        frame = spark.read.format(fmt).load(path)
    else:
        names = spark.read.option("header", True).csv(path).columns
        schema = T.StructType(
            [T.StructField(n, T.StringType() if n == ts else T.DoubleType()) for n in names]
        )
        frame = spark.read.option("header", True).schema(schema).csv(path)
    # Expression text: hundreds of columns cost one call instead of several per column.
    doubles = {f.name for f in frame.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cleaned = [f"nanvl({_quoted(n)}, NULL) AS {_quoted(n)}" if n in doubles else _quoted(n) for n in frame.columns]
    return frame.selectExpr(
        *cleaned, "_metadata.file_path AS _file", "_metadata.file_block_start AS _block"
    )


FILE_COLUMNS = ("_file", "_block")


def sensor_columns(frame: DataFrame, ts: str | None = "timestamp") -> list[str]:
    skip = {ts, "_position", "production_id", *FILE_COLUMNS}
    return [c for c in frame.columns if c not in skip]


def split_target(original: DataFrame, target: str = "class") -> tuple[DataFrame, DataFrame]:
    """A table that still carries its label: (features, label)."""
    files = [c for c in FILE_COLUMNS if c in original.columns]
    return original.drop(target), original.select(target, *files)


# The block table is sent to all tasks up to this many blocks (about 60 MB of paths and offsets, or 128 TB of files).
BROADCAST_BLOCKS = 1_000_000


def with_position(frame: DataFrame) -> tuple[DataFrame, int]:
    """1-based row number ``_position`` in file order, and the number of rows; no row goes into one task.

    The rows are marked in one scan and written once; block totals and positions both come from the written
    files, so they agree however the scan was split. Blocks are ordered by path and offset and
    only the block totals (one row per block) go through the ordered window.
    """
    block = list(FILE_COLUMNS)
    marked = materialize(frame.withColumn("_mark", F.monotonically_increasing_id()), "marked-rows")
    blocks = marked.groupBy(*block).agg(F.count("*").alias("_rows"), F.min("_mark").alias("_first"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialize(blocks.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0))), "file-blocks")
    count, rows = blocks.agg(F.count("*"), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    blocks = blocks.drop("_rows")
    if count <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    numbered = (
        marked.join(blocks, block)
        .withColumn("_position", F.col("_mark") - F.col("_first") + F.col("_offset") + 1)
        .drop("_mark", "_first", "_offset", *block)
    )
    return numbered, rows


def attach_labels(features: DataFrame, labels: DataFrame, key: str | None = None) -> DataFrame:
    """Labels onto features by ``key`` (rows without one keep NULL); without a key, by row position in the files.

    The position becomes ``production_id``, so nothing later depends on row order. Files with different numbers of rows
    can't be aligned by position and raise.
    """
    if key:
        return features.join(labels, key, "left")
    target = [c for c in labels.columns if c not in FILE_COLUMNS][0]
    right, n_labels = with_position(labels)
    left, n_rows = with_position(features)
    if n_rows != n_labels:
        raise ValueError(f"{n_rows} rows of features, but {n_labels} labels")
    right = right.select("_position", F.col(_quoted(target)).cast("int").alias("raw_label"))
    return left.join(right, "_position").withColumnRenamed("_position", "production_id")


def vector_width(vectors: DataFrame, column: str = "values") -> int:
    """The length that all arrays of the column share; uneven ones raise."""
    least, most = vectors.agg(F.min(F.size(column)), F.max(F.size(column))).first()
    if least != most:
        raise ValueError(f"arrays of {least} to {most} sensors")
    return most or 0


def to_vectors(wide: DataFrame, sensors: list[str], keep: list[str]) -> DataFrame:
    """Wide columns to one array per unit: position i holds sensor i+1."""
    cells = ", ".join(f"double({_quoted(c)})" for c in sensors)
    return wide.select(*keep, F.expr(f"array({cells})").alias("values"))


def sensor_catalog(spark: SparkSession, sensors: list[str]) -> DataFrame:
    """One row per sensor column, taken from the schema."""
    return literal_table(spark, ["sensor_id", "sensor_code"], list(enumerate(sensors, start=1)))


def to_readings(vectors: DataFrame, *keep: str) -> DataFrame:
    """Long form: one row per unit and sensor, missing readings kept as NULL.

    The outer form is used because the inner one adds a filter on the array's
    size, which would evaluate the expression behind ``values`` once more per row.
    """
    exploded = vectors.select("production_id", *keep, F.posexplode_outer("values").alias("_pos", "value"))
    return exploded.where("_pos is not null").select(
        "production_id", *keep, (F.col("_pos") + 1).alias("sensor_id"), "value"
    )


def payload_map(codes: Column, values: Column) -> Column:
    """Map of the readings that are present."""
    return F.map_filter(F.map_from_arrays(codes, values), lambda _, v: v.isNotNull())


def staging_payload(vectors: DataFrame) -> DataFrame:
    """Per unit: the readings that are present, as JSON text."""
    codes = F.transform(F.sequence(F.lit(1), F.size("values")), lambda i: N.sensor_code(i))
    return vectors.select(
        "production_id",
        F.col("event_ts").alias("event_timestamp"),
        F.col("raw_label").alias("quality_label"),
        F.to_json(payload_map(codes, F.col("values"))).alias("sensor_data"),
    )


def read_payload(staged: DataFrame, column: str = "sensor_data", *keep: str) -> DataFrame:
    """JSON payload back to typed long readings. Exploded in the outer form, as in ``to_readings``: the text is parsed once per row."""
    parsed = F.from_json(F.col(column), "map<string,double>")
    return staged.select(*keep, F.explode_outer(parsed).alias("sensor_code", "value")).where("sensor_code is not null")
