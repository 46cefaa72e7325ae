"""Train-only imputation, feature ranking and top-k selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fablens.operators.ranked import running_totals
from fablens.sources.shared import materialize

# Sketch accuracy for bracketing a median, and how far the bracket reaches
# around it (in units of the sketch's own error); a missed bracket is widened by WIDEN.
SKETCH = 10_000
REACH = 5
WIDEN = 20
# Readings of one group meet its bracket in this many tasks.
SPREAD = 64


def fit_medians(train: DataFrame, by: str = "sensor_id", value: str = "value") -> DataFrame:
    """Exact median per group, NULL for a group without readings. A NULL group is one of its own.

    A quantile sketch brackets the median; then readings below the bracket are
    only counted and those inside it are counted per distinct value. Readings meet the brackets by
    group and slot, the slot being that of their task, so that a large group and a hot value are dealt to many tasks, and the
    ranks come from running totals by slices. A rank that the bracket misses is looked for again, in a wider one.
    """
    left = train.select(F.col(by).alias("_g"), F.col(value).alias("_x"))
    done, reach = [], REACH / SKETCH
    while True:
        part = materialize(_bracketed_medians(left, min(reach, 0.5)), "medians")
        missed = part.where("_m is null and _rows > 0").select(F.col("_g").alias("_again"))
        if reach >= 0.5 or not missed.limit(1).count():
            done.append(part)
            break
        done.append(part.where("_m is not null or _rows = 0"))
        left = left.join(missed, F.col("_g").eqNullSafe(F.col("_again")), "left_semi")
        reach *= WIDEN
    return reduce(DataFrame.unionByName, done).select(F.col("_g").alias(by), F.col("_m").alias("median"))


def _bracketed_medians(readings: DataFrame, reach: float) -> DataFrame:
    """``_g``, its present ``_rows`` and median ``_m``; NULL where the sketch's bracket does not hold it."""
    sketch = readings.groupBy("_g").agg(
        F.percentile_approx("_x", [max(0.0, 0.5 - reach), min(1.0, 0.5 + reach)], SKETCH).alias("_b"), F.count("_x").alias("_rows")
    )
    bounds = materialize(sketch.select("_g", F.col("_b")[0].alias("_low"), F.col("_b")[1].alias("_high"), "_rows"), "median-bounds")
    spread = bounds.select(
        F.col("_g").alias("_of"), "_low", "_high", "_rows", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_slot")
    )
    slot = F.pmod(F.spark_partition_id(), F.lit(SPREAD))
    met = readings.where("_x is not null").withColumn("_at", slot).join(
        spread, F.col("_g").eqNullSafe(F.col("_of")) & (F.col("_at") == F.col("_slot"))
    )
    inside = F.when(F.col("_x") >= F.col("_low"), F.col("_x"))
    counted = met.where(F.col("_x") <= F.col("_high")).groupBy("_g", inside.alias("_v")).agg(F.count("*").alias("_n"))
    counted = materialize(counted, "median-counts")
    below = counted.where("_v is null").select(F.col("_g").alias("_gb"), F.col("_n").alias("_below"))
    # Groups by hash from here on: a NULL group then joins like any other.
    ranked = running_totals(
        counted.where("_v is not null").withColumn("_key", F.xxhash64("_g")), ["_key", "_g"], "_v", ["_n"]
    )
    ranked = ranked.join(below, F.col("_g").eqNullSafe(F.col("_gb")), "left").withColumn(
        "_upto", F.col("_n_upto") + F.coalesce("_below", F.lit(0))
    )
    sized = ranked.join(
        bounds.select(F.col("_g").alias("_of"), "_rows"), F.col("_g").eqNullSafe(F.col("_of"))
    )

    def at(rank: Column) -> Column:
        return F.min(F.when((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank), F.col("_v")))

    middle = sized.groupBy("_g").agg(
        at(F.expr("(_rows + 1) div 2")).alias("_lower"), at(F.expr("_rows div 2 + 1")).alias("_upper")
    )
    exact = middle.select(F.col("_g").alias("_gm"), ((F.col("_lower") + F.col("_upper")) / 2).alias("_m"))
    return bounds.select("_g", "_rows").join(exact, F.col("_g").eqNullSafe(F.col("_gm")), "left").select("_g", "_rows", "_m")


def as_vector(stats: DataFrame, column: str, width: int, by: str = "sensor_id") -> Column:
    """A per-sensor column as one array (position i is sensor i+1), as a scalar subquery.

    Its size is the number of sensors. Sensors without a row are NULL.
    """
    packed = stats.agg(F.map_from_entries(F.collect_list(F.struct(by, column))).alias("m"))
    ids = F.sequence(F.lit(1), F.lit(width))
    return packed.select(F.transform(ids, lambda i: F.try_element_at("m", i))).scalar()


def impute(readings: DataFrame, medians: DataFrame, by: str = "sensor_id", value: str = "value") -> DataFrame:
    """Long form: missing readings take the fitted median."""
    joined = readings.join(medians, by, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.col("median"))).drop("median")


def impute_vectors(vectors: DataFrame, medians: DataFrame, width: int) -> DataFrame:
    """Array form: the same, inside each row."""
    fill = as_vector(medians, "median", width)
    return vectors.withColumn("_fill", fill).withColumn(
        "values", F.zip_with("values", "_fill", lambda v, m: F.coalesce(v, m))
    ).drop("_fill")


def mutual_information(readings: DataFrame, y: str = "y", bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each sensor, in equal-width bins, with the label.

    After the bounds, one pass counts (sensor, bin, label); the logarithms run
    over those few counts.
    """
    present = readings.where(F.col("value").isNotNull())
    bounds = materialize(
        present.groupBy("sensor_id").agg(F.min("value").alias("_min"), F.max("value").alias("_max")), "bin-bounds"
    )
    span = F.col("_max") - F.col("_min")
    place = F.floor(F.try_divide(F.col("value") - F.col("_min"), span) * bins).cast("int")
    cells = (
        present.join(bounds, "sensor_id")
        .groupBy("sensor_id", F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).alias("bin"), F.col(y).alias("y"))
        .agg(F.count("*").cast("double").alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("sensor_id"))
    in_bin = F.sum("n").over(Window.partitionBy("sensor_id", "bin"))
    in_class = F.sum("n").over(Window.partitionBy("sensor_id", "y"))
    parts = cells.select("sensor_id", "n", total.alias("t"), in_bin.alias("b"), in_class.alias("c"))
    term = F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("b") * F.col("c")))
    return parts.groupBy("sensor_id").agg(F.greatest(F.sum(term), F.lit(0.0)).alias("mutual_info"))


def separation_score(readings: DataFrame, y: str = "y") -> DataFrame:
    """Distance between the class means in standard deviations: a model-free importance, ``separation``."""
    fail = F.when(F.col(y) == 1, F.col("value"))
    good = F.when(F.col(y) == 0, F.col("value"))
    gap = F.abs(F.avg(fail) - F.avg(good))
    return readings.groupBy("sensor_id").agg(
        F.coalesce(F.try_divide(gap, F.stddev_samp("value")), F.lit(0.0)).alias("separation")
    )


def composite_rank(
    ranking: DataFrame, w_rf: float = 0.7, w_mi: float = 0.3, importance: str = "rf_importance"
) -> DataFrame:
    """Blend of an importance column and mutual information, each divided by its maximum (by 1 where that is 0).

    ``ranking`` has one row per sensor, so the maxima are taken over a small window.
    """

    def scaled(column: str) -> Column:
        top = F.max(column).over(Window.partitionBy())
        return F.col(column) / F.when(top > 0, top).otherwise(1.0)

    blended = scaled(importance) * w_rf + scaled("mutual_info") * w_mi
    return ranking.withColumn("composite_score", blended)


def rank_desc(df: DataFrame, score: str, tie: str) -> DataFrame:
    """1-based rank, highest score first. For one row per sensor, model or lot type."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), tie)))


def select_top_k(ranking: DataFrame, k: int = 50, tie: str = "sensor_id") -> DataFrame:
    return ranking.orderBy(F.desc("composite_score"), tie).limit(k)


def restrict(readings: DataFrame, selected: DataFrame) -> DataFrame:
    """Readings of the selected sensors only."""
    return readings.join(selected.select("sensor_id"), "sensor_id", "left_semi")


def feature_matrix(vectors: DataFrame, sensors: list[int], prefix: str = "sensor_") -> DataFrame:
    """Wide matrix of chosen sensors straight from the arrays: a projection, no shuffle."""
    columns = [F.get("values", F.lit(i - 1)).alias(f"{prefix}{i}") for i in sensors]
    keep = [c for c in vectors.columns if c != "values"]
    return vectors.select(*keep, *columns)


def pivot_readings(readings: DataFrame, sensors: list[int], prefix: str = "sensor_") -> DataFrame:
    """The same from long readings; the explicit list saves a pass to find it."""
    wide = readings.groupBy("production_id").pivot("sensor_id", sensors).agg(F.first("value"))
    return wide.select("production_id", *[F.col(f"`{i}`").alias(f"{prefix}{i}") for i in sensors])
