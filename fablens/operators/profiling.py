"""Data-quality profile of sensor readings, and the gate built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fablens import constants as K
from fablens.functions import numbers as N
from fablens.sources.shared import literal_table, materialize


def sensor_stats(
    readings: DataFrame,
    catalog: DataFrame | None = None,
    units: DataFrame | None = None,
    exact_unique: bool = False,
) -> DataFrame:
    """One row per sensor, unrounded, from a single pass over long readings.

    Every task folds its readings to one partial row per sensor before the
    shuffle, so neither wide tables nor a dominant sensor move raw data.
    Constancy is min = max (no distinct). ``exact_unique`` adds the exact
    distinct count, which does shuffle the distinct (sensor, value) pairs;
    otherwise the count is a sketch.

    Readings from a null-dropping payload need ``catalog`` (the sensors that
    should exist) and ``units`` (the units that should report).
    """
    key = "sensor_code" if catalog is not None else "sensor_id"
    unique = F.count_distinct("value") if exact_unique else F.approx_count_distinct("value")
    stats = readings.groupBy(key).agg(
        F.count("*").alias("rows"),
        F.count("value").alias("present"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        unique.alias("unique_count"),
    )
    if catalog is not None:
        stats = catalog.join(stats, key, "left").withColumn("rows", units.agg(F.count("*")).scalar())
        stats = stats.fillna(0, ["present", "unique_count"])
    else:
        stats = stats.withColumn("sensor_code", N.sensor_code(F.col("sensor_id")))
    return stats.select(
        "sensor_id",
        "sensor_code",
        "rows",
        (F.col("rows") - F.col("present")).alias("missing_count"),
        (F.try_divide((F.col("rows") - F.col("present")).cast("double"), F.col("rows")) * 100).alias("missing_rate"),
        "unique_count",
        ((F.col("present") == 0) | (F.col("min") == F.col("max"))).alias("is_constant"),
        "mean",
        "std",
        "min",
        "max",
    )


def profile_columns(stats: DataFrame, dtypes: DataFrame) -> DataFrame:
    """Report rows; ``dtypes`` has ``sensor_code`` and ``dtype`` (see ``column_types``)."""
    return stats.join(dtypes, "sensor_code", "left").select(
        F.col("sensor_code").alias("column"),
        "dtype",
        "missing_count",
        F.round("missing_rate", 2).alias("missing_pct"),
        "unique_count",
        "is_constant",
        F.round("mean", 4).alias("mean"),
        F.round("std", 4).alias("std"),
        F.round("min", 4).alias("min"),
        F.round("max", 4).alias("max"),
    )


def column_types(df: DataFrame, sensors: list[str]) -> DataFrame:
    """Data type of each sensor column, from the table's schema; an array column counts once per sensor."""
    rows = [(c, df.schema[c].dataType.simpleString()) for c in sensors]
    return literal_table(df.sparkSession, ["sensor_code", "dtype"], rows)


def profile_missing_by_sensor(stats: DataFrame) -> DataFrame:
    return stats.select(
        F.col("sensor_code").alias("column"), "missing_count", F.round("missing_rate", 2).alias("missing_pct")
    ).orderBy(F.desc("missing_count"), "column")


def top_missing_k(stats: DataFrame, k: int = 20) -> DataFrame:
    return (
        stats.select(F.col("sensor_code").alias("column"), "missing_count")
        .orderBy(F.desc("missing_count"), "column")
        .limit(k)
    )


def profile_high_missing(stats: DataFrame, max_missing: float = K.MAX_MISSING_PCT) -> DataFrame:
    return profile_missing_by_sensor(stats.where(F.col("missing_rate") > max_missing))


def profile_constant(stats: DataFrame) -> DataFrame:
    """Sensors with at most one distinct value; an all-NULL sensor has none."""
    return stats.where("is_constant").select(
        F.col("sensor_code").alias("column"),
        F.when(F.col("min").isNull(), 0).otherwise(1).cast("bigint").alias("unique_values"),
    )


def profile_missing_total(stats: DataFrame) -> DataFrame:
    return stats.agg(F.sum("missing_count").alias("missing_cells"), F.sum("rows").alias("total_cells")).withColumn(
        "missing_rate_pct", N.pct(F.col("missing_cells"), F.col("total_cells"))
    )


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def dtype_histogram(df: DataFrame) -> DataFrame:
    """Columns per data type, read from the schema: no job over the data."""
    counts: dict[str, int] = {}
    for _, dtype in df.dtypes:
        counts[dtype] = counts.get(dtype, 0) + 1
    dtypes = literal_table(df.sparkSession, ["dtype", "columns"], sorted(counts.items()))
    return dtypes.select("dtype", F.col("columns").cast("bigint").alias("columns"))


def _comparable(value: Column, kind: T.DataType) -> Column:
    """The value in a form that groups and hashes alike whenever it is equal: one zero, maps as sorted entries."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return value + F.lit(0.0).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _comparable(v, kind.elementType))
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return F.array_sort(F.transform(F.map_entries(value), lambda v: _comparable(v, entry)))
    if isinstance(kind, T.StructType):
        fields = [_comparable(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def profile_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of rows that repeat an earlier row (NULLs are equal, as are NaNs, and 0.0 and -0.0).

    One rule at any width: hashes that occur more than once are found first, an 8-byte column folded before
    its shuffle; only rows with such a hash are compared, by their real columns.
    """
    columns = columns or df.columns
    rows = df.select(*[_comparable(F.col(_quoted(c)), df.schema[c].dataType).alias(f"c{i}") for i, c in enumerate(columns)])
    names = rows.columns
    hashed = rows.withColumn("hash", F.xxhash64(*names))
    repeated = materialize(hashed.groupBy("hash").count().where("count > 1").select("hash"), "repeated-hashes")
    copies = hashed.join(repeated, "hash", "left_semi").groupBy(*names).agg(F.count("*").alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def profile_labels(units: DataFrame) -> DataFrame:
    return units.groupBy("raw_label").agg(F.count("*").alias("units"))


def label_summary(units: DataFrame) -> DataFrame:
    return units.agg(
        N.count_where(F.col("raw_label") == K.PASS_LABEL).alias("pass_observations"),
        N.count_where(F.col("raw_label") == K.FAIL_LABEL).alias("fail_observations"),
        F.count("*").alias("rows"),
    ).withColumn("failure_rate_pct", N.pct(F.col("fail_observations"), F.col("rows")))


def time_span(units: DataFrame) -> DataFrame:
    return units.agg(F.min("event_ts").alias("timestamp_start"), F.max("event_ts").alias("timestamp_end")).withColumn(
        "span_days", F.datediff("timestamp_end", "timestamp_start")
    )


def quality_status(
    high_missing: Column, constant: Column, fails: Column, rows: Column, min_fail_rate: float = K.MIN_FAIL_RATE
) -> Column:
    few_fails = N.safe_divide(fails, rows) < min_fail_rate
    return F.when((high_missing > 0) | (constant > 0) | few_fails, "WARNING").otherwise("PASS")


def quality_summary(
    stats: DataFrame,
    units: DataFrame,
    duplicates: DataFrame,
    dataset: str,
    max_missing: float = K.MAX_MISSING_PCT,
    min_fail_rate: float = K.MIN_FAIL_RATE,
) -> DataFrame:
    """The one-row scorecard. Each part is a one-row aggregate, attached as a scalar subquery."""
    labels = units.agg(
        F.struct(
            F.count("*").alias("rows"),
            N.count_where(F.col("raw_label") == K.PASS_LABEL).alias("passed"),
            N.count_where(F.col("raw_label") == K.FAIL_LABEL).alias("failed"),
            F.min("event_ts").alias("first"),
            F.max("event_ts").alias("last"),
        )
    )
    sensors = stats.agg(
        F.count("*").alias("sensors"),
        F.sum("missing_count").alias("missing"),
        F.sum("rows").alias("cells"),
        N.count_where(F.col("missing_rate") > max_missing).alias("high"),
        N.count_where(F.col("is_constant")).alias("constant"),
    )
    joined = sensors.withColumn("u", labels.scalar()).withColumn("dup", duplicates.scalar())
    return joined.select(
        F.lit(dataset).alias("dataset"),
        F.col("u.rows").alias("rows"),
        (F.col("sensors") + 1).alias("features"),
        F.col("dup").alias("duplicate_rows"),
        N.pct(F.col("missing"), F.col("cells")).alias("missing_value_rate_pct"),
        F.col("high").alias("columns_gt_50_pct_missing"),
        F.col("constant").alias("constant_columns"),
        F.col("u.passed").alias("pass_observations"),
        F.col("u.failed").alias("fail_observations"),
        N.pct(F.col("u.failed"), F.col("u.rows")).alias("failure_rate_pct"),
        F.col("u.first").alias("timestamp_start"),
        F.col("u.last").alias("timestamp_end"),
        quality_status(F.col("high"), F.col("constant"), F.col("u.failed"), F.col("u.rows"), min_fail_rate).alias(
            "quality_status"
        ),
    )


def missing_share(values: Column, candidates: list[int] | None = None) -> Column:
    """Share of missing readings in an array, over all or over the candidate sensors."""
    if candidates is not None:
        values = F.array(*[F.get(values, F.lit(i - 1)) for i in candidates])
    return N.safe_divide(F.size(F.filter(values, lambda v: v.isNull())), F.size(values))


def missing_row_gate(
    vectors: DataFrame, candidates: list[int] | None = None, max_missing: float = K.MAX_MISSING_FEATURES
) -> DataFrame:
    """Units with too many missing readings go straight to hold. Row-local: no shuffle."""
    share = missing_share(F.col("values"), candidates)
    return vectors.select(
        "production_id",
        F.round(share * 100, 2).alias("missing_pct"),
        F.when(share > max_missing, K.TIER_1).alias("gate_tier"),
    )
