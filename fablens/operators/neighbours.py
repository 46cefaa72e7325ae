"""Mutual information of a sensor and the label from nearest neighbours, without bins.

For every reading the distance to its k-th nearest neighbour of the same label is found, then how many readings of any label lie
within it; with N readings, N_y of a label and m in reach, information = psi(N) + mean(psi(k) - psi(N_y) - psi(m)). In one dimension neighbours are neighbours
in order: equal readings are folded first, slices of the sorted values look up to k values to each side and take those of
adjacent slices from a halo, and m is a difference of two ranks. No sensor meets in one task, and no pairs are built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fablens.operators.ranked import running_totals
from fablens.sources.shared import materialize

NEIGHBOURS = 3
#: Reach is the k-th distance less one part in 10^9: the neighbour at that very distance is outside, however it is rounded.
INSIDE = 1 - 1e-9


def digamma(n: Column) -> Column:
    """The digamma function of a positive whole number, to about 1e-12."""
    x = n.cast("double") + 10
    square = x * x
    series = F.log(x) - 1 / (2 * x) - (1 / 12 - (1 / 120 - (1 / 252 - 1 / (240 * square)) / square) / square) / square
    for i in range(10):
        series = series - 1 / (n + F.lit(float(i)))
    return series


def folded_readings(readings: DataFrame, y: str = "y") -> DataFrame:
    """``sensor_id``, ``y``, ``x`` and ``n``: distinct readings per label. Labels with a single reading of a sensor are left out."""
    present = readings.where(F.col("value").isNotNull() & F.col(y).isNotNull())
    counts = present.groupBy("sensor_id", F.col(y).alias("y"), (F.col("value") + 0.0).alias("x")).agg(F.count("*").alias("n"))
    counts = materialize(counts, "folded-readings")
    sizes = counts.groupBy("sensor_id", "y").agg(F.sum("n").alias("of_label")).where("of_label > 1")
    return counts.join(sizes, ["sensor_id", "y"])


def _halos(sliced: DataFrame, k: int) -> DataFrame:
    """Per slice of a sensor's label: the k values before it and the k behind it, nearest slices first and as many as it takes."""
    inside = Window.partitionBy("sensor_id", "y", "_slice")
    ranked = sliced.select(
        "sensor_id", "y", "_slice", "x", "m", F.row_number().over(inside.orderBy("x")).alias("_up"), F.count("*").over(inside).alias("_in")
    )
    edge = ranked.where((F.col("_up") <= k) | (F.col("_up") > F.col("_in") - k))
    entry = F.struct("x", "m")
    ends = edge.groupBy("sensor_id", "y", "_slice").agg(
        F.array_sort(F.collect_list(F.when(F.col("_up") <= k, entry))).alias("_first"),
        F.array_sort(F.collect_list(F.when(F.col("_up") > F.col("_in") - k, entry))).alias("_last"),
    )
    along = Window.partitionBy("sensor_id", "y").orderBy("_slice")
    before = F.flatten(F.collect_list("_last").over(along.rowsBetween(-k, -1)))
    behind = F.flatten(F.collect_list("_first").over(along.rowsBetween(1, k)))
    return ends.select(
        F.col("sensor_id").alias("_s"), F.col("y").alias("_y"), F.col("_slice").alias("_of"), before.alias("_before"), behind.alias("_behind")
    )


def neighbour_distances(folded: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``folded`` with ``k`` (fewer for a small label) and ``radius``, the distance to the k-th nearest other reading of the label."""
    sliced = folded.repartitionByRange("sensor_id", "y", "x").withColumns({"_slice": F.spark_partition_id(), "m": F.least("n", F.lit(k)).cast("int")})
    sliced = materialize(sliced, "sorted-readings")
    halos = _halos(sliced, k)
    inside = Window.partitionBy("sensor_id", "y", "_slice").orderBy("x")
    entry = F.struct("x", "m")
    rows = sliced.withColumns(
        {"_left": F.collect_list(entry).over(inside.rowsBetween(-k, -1)), "_right": F.collect_list(entry).over(inside.rowsBetween(1, k))}
    )
    same = (F.col("sensor_id") == F.col("_s")) & (F.col("y") == F.col("_y")) & (F.col("_slice") == F.col("_of"))
    rows = rows.join(halos, same)
    left = F.slice(F.reverse(F.concat("_before", "_left")), 1, k)
    right = F.slice(F.concat("_right", "_behind"), 1, k)

    def far(side: Column, sign: int) -> Column:
        gap = lambda e: (F.col("x") - e["x"]) if sign < 0 else (e["x"] - F.col("x"))
        return F.flatten(F.transform(side, lambda e: F.array_repeat(gap(e), e["m"])))

    own = F.array_repeat(F.lit(0.0), F.least(F.col("n") - 1, F.lit(k)).cast("int"))
    near = F.least(F.col("of_label") - 1, F.lit(k)).cast("int")
    radius = F.element_at(F.array_sort(F.concat(own, far(left, -1), far(right, 1))), near)
    return rows.select("sensor_id", "y", "x", "n", "of_label", near.alias("k"), radius.alias("radius"))


def neighbour_information(readings: DataFrame, y: str = "y", k: int = NEIGHBOURS) -> DataFrame:
    """``sensor_id`` and ``mutual_info`` (nats, at least 0) of long readings (``sensor_id``, ``value`` and a label).

    Missing readings and unlabelled ones take no part. Equal readings are at distance 0; a reading whose k nearest are all equal to it counts
    those that are equal. A sensor without two readings of one label has no row.
    """
    reach = F.col("radius") * INSIDE
    found = neighbour_distances(folded_readings(readings, y), k)
    found = materialize(found.withColumns({"low": F.col("x") - reach + 0.0, "high": F.col("x") + reach + 0.0}), "neighbour-distances")
    weights = found.select("sensor_id", F.col("x").alias("pos"), "n")
    probes = found.select("sensor_id", F.explode(F.array("low", "high")).alias("pos"), F.lit(0).cast("bigint").alias("n"))
    marks = weights.unionByName(probes).groupBy("sensor_id", "pos").agg(F.sum("n").alias("w"))
    ranks = materialize(running_totals(marks, ["sensor_id"], "pos", ["w"]), "ranks")
    at = lambda end, rank: ranks.select(F.col("sensor_id").alias(f"_{end}_s"), F.col("pos").alias(f"_{end}"), rank.alias(f"_{end}_rank"))
    lows, highs = at("low", F.col("w_upto") - F.col("w")), at("high", F.col("w_upto"))
    met = found.join(lows, (F.col("sensor_id") == F.col("_low_s")) & (F.col("low") == F.col("_low")))
    met = met.join(highs, (F.col("sensor_id") == F.col("_high_s")) & (F.col("high") == F.col("_high")))
    inside = F.col("_high_rank") - F.col("_low_rank")
    terms = F.col("n") * (digamma(F.col("k")) - digamma(F.col("of_label")) - digamma(inside))
    sums = met.groupBy("sensor_id").agg(F.sum("n").alias("_n"), F.sum(terms).alias("_t"))
    return sums.select("sensor_id", F.greatest(digamma(F.col("_n")) + F.col("_t") / F.col("_n"), F.lit(0.0)).alias("mutual_info"))
