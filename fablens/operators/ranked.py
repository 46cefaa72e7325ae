"""Running totals over a table too large for one ordered window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fablens.sources.shared import materialize


def running_totals(df: DataFrame, by: list[str], order: str, sums: list[str], descending: bool = False) -> DataFrame:
    """Add ``<sum>_upto``: the total of each column up to and including the row.

    Rows are range-partitioned on (by, order) and written once. Each slice is
    then summed on its own and shifted by the totals of the slices before it,
    so only one row per slice and group passes through an ordered window.
    ``order`` values must be distinct within ``by``.
    """
    key = F.desc(order) if descending else F.asc(order)
    sliced = df.repartitionByRange(*[F.col(c) for c in by], key).withColumn("_slice", F.spark_partition_id())
    sliced = materialize(sliced, "running-totals")

    totals = sliced.groupBy(*by, "_slice").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_slice", *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in sums]
    )

    inside = Window.partitionBy(*by, "_slice").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    # Should the offsets be too many to broadcast, the join's shuffle is also the window's.
    renamed = offsets.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_slice").alias("_of"), *[f"_{c}" for c in sums])
    same = F.col("_slice") == F.col("_of")
    for c in by:  # a NULL group is one of its own
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    joined = sliced.join(renamed, same).drop("_of", *[f"_by_{c}" for c in by])
    return joined.withColumns({f"{c}_upto": F.sum(c).over(inside) + F.col(f"_{c}") for c in sums}).drop(
        "_slice", *[f"_{c}" for c in sums]
    )
