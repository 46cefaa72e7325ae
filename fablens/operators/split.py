"""Chronological split without sorting the table.

The split is a cut point (timestamp, id): rows up to it are training rows. The
cut is found by counting: rows per day, then per minute of the boundary day, per millisecond of
the boundary minute, per microsecond of that, then per id range within one
instant. Each step is a filtered aggregate with a bounded number of groups (at most 65,536 after the days), so
a day, second or instant that holds a third of all rows is counted, never
collected or sorted. As soon as the boundary bucket has at most 65,536 rows these are put in order. The split itself is a filter that reaches the scan. Within an instant rows without an id come last.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Ids within one instant are counted in at most this many ranges per step; as many rows can be put in order at once.
ID_RANGES = 65_536


@dataclass(frozen=True)
class Cut:
    """Last training row in (timestamp, id) order; both None when nothing is trained on."""

    ts: datetime | None
    id: int | None
    rows: int
    train_rows: int


def _at(moment: datetime) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _boundary(df: DataFrame, bucket: Column, rank: Column) -> Row | None:
    """The bucket that holds row number ``rank``: its value ``b``, its rows ``n``, the rank inside it,
    the rank and the number of all rows.

    ``rank`` may refer to ``total``, the number of rows. NULL buckets come last.
    """
    order = F.asc_nulls_last("b")
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = F.sum("n").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    counts = df.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"))
    placed = counts.withColumns({"upto": upto, "total": F.sum("n").over(everything)}).withColumn("rank", rank)
    inside = (F.col("rank") - (F.col("upto") - F.col("n"))).alias("inside")
    return placed.where("upto >= rank").orderBy(order).select("b", "n", inside, "rank", "total").first()


def _nth_id(rows: DataFrame, key: str, rank: int) -> int:
    """The ``rank``-th smallest id, by repeatedly narrowing its range."""
    rows = rows.where(F.col(key).isNotNull())
    low, high, known = rows.agg(F.min(key), F.max(key), F.count("*")).first()
    if rank > known:
        raise ValueError("the training share ends among rows of one instant that have no id")
    while low < high:
        width = (high - low) // ID_RANGES + 1
        found = _boundary(rows, F.expr(f"({key} - {low}L) div {width}L"), F.lit(rank))
        rank = found["inside"]
        low, high = low + found["b"] * width, min(high, low + (found["b"] + 1) * width - 1)
        rows = rows.where(F.col(key).between(low, high))
    return low


def chronological_cut(df: DataFrame, ts: str = "event_ts", key: str = "production_id", ratio: float = 0.8) -> Cut:
    """Cut point that puts the first floor(ratio * n) rows into training."""
    rows = df.select(F.col(ts).cast("timestamp_ntz").alias("ts"), F.col(key).alias("id"))
    found = _boundary(rows, F.date_trunc("day", "ts").cast("timestamp_ntz"), F.floor(F.col("total") * ratio))
    if found is None or found["rank"] == 0:
        return Cut(None, None, found["total"] if found else 0, 0)
    if found["b"] is None:
        raise ValueError("the training share reaches into rows without a timestamp")
    total, train = found["total"], found["rank"]
    for unit in ("day", "minute", "millisecond", "microsecond"):
        if unit != "day":
            found = _boundary(rows, F.date_trunc(unit, "ts").cast("timestamp_ntz"), F.lit(found["inside"]))
        start = _at(found["b"])
        rows = rows.where((F.col("ts") >= start) & (F.col("ts") < start + F.expr(f"interval 1 {unit}")))
        if found["n"] <= ID_RANGES:  # few enough to be put in order: the last one of the training rows among them
            last = rows.orderBy("ts", F.asc_nulls_last("id")).offset(found["inside"] - 1).limit(1).first()
            if last["id"] is None:
                raise ValueError("the training share ends among rows of one instant that have no id")
            return Cut(last["ts"], last["id"], total, train)
    return Cut(found["b"], _nth_id(rows, "id", found["inside"]), total, train)


def in_training(cut: Cut, ts: str = "event_ts", key: str = "production_id") -> Column:
    if cut.ts is None:
        return F.lit(False)
    at = _at(cut.ts)
    return (F.col(ts) < at) | ((F.col(ts) == at) & F.col(key).isNotNull() & (F.col(key) <= cut.id))


def chronological_split(
    df: DataFrame, ts: str = "event_ts", key: str = "production_id", ratio: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """(train, test) as two filters over ``df``."""
    train = in_training(chronological_cut(df, ts, key, ratio), ts, key)
    return df.where(train), df.where(~F.coalesce(train, F.lit(False)))


def split_summary(df: DataFrame, train: Column, y: Column) -> DataFrame:
    """Rows, defects and defect rate per side, in one pass."""
    counts = df.groupBy(F.when(train, "train").otherwise("test").alias("split")).agg(
        F.count("*").alias("rows"), F.sum(y).alias("defects")
    )
    return counts.withColumn("defect_rate", F.round(F.try_divide(F.col("defects").cast("double"), F.col("rows")), 6))
