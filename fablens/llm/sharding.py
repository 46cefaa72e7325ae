"""Shards by jump consistent hashing: keys and the shard count decide, without a ring table.

Appending a shard moves only the rows that the new shard takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fablens.sources.shared import materialize

SHARDS = 40
ROW_BYTES = 16


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; every key jumps on while its next shard exists."""
    keys = keys.astype(np.uint64)
    shard, target = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.float64)
    active = np.arange(len(keys))
    while len(active):
        shard[active] = target[active].astype(np.int64)
        keys[active] = keys[active] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((keys[active] >> np.uint64(33)).astype(np.float64) + 1.0)
        target[active] = (shard[active] + 1) * step
        active = active[target[active] < shards]
    return shard


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """``id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` of every row.

    The key is the 64-bit hash of the id, so equal ids share a shard and null ids share one, too.
    ``grown_shard`` is the shard under one shard more: the same or the new one. A null text
    has size 16 and checksum 0, as an empty one. Slots number each shard's rows without gaps
    in the order in which the tasks read them: each task counts its own rows per shard, and
    the numbered rows are written once, so that slots and offsets come from the same reading. No
    row is moved for it, whatever its key. Repeated rows get slots of their own; an empty
    table gives no rows; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(id_col).alias("key"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(shards, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            keys = batch.column(3).to_numpy().view(np.uint64)
            shard = jump_hash(keys.copy(), shards)
            grown = jump_hash(keys.copy(), shards + 1)
            order = np.argsort(shard, kind="stable")
            begins = np.searchsorted(shard[order], np.arange(shards))
            local = np.empty(len(shard), np.int64)
            local[order] = np.arange(len(shard)) - begins[shard[order]]
            local += counts[shard]
            counts += np.bincount(shard, minlength=shards)
            columns = [pa.array(x) for x in (shard.astype(np.int32), grown.astype(np.int32), local)]
            columns.append(pa.array(np.full(len(shard), task, np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *columns],
                names=[id_col, "size", "text_crc32", "shard", "grown_shard", "local", "task"],
            )

    numbered = materialize(
        keyed.mapInArrow(
            number,
            f"`{id_col}` {kind}, size long, text_crc32 long, shard int, grown_shard int, local long, task int",
        ),
        "shards",
    )
    counted = numbered.groupBy("shard", "task").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("shard", "task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    return numbered.join(offsets, ["shard", "task"]).select(
        id_col,
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.col("local")).alias("slot"),
        "grown_shard",
    )


def write_shards(docs: DataFrame, path: str, key_col: str, shards: int = SHARDS) -> None:
    """Write whole rows as one folder per shard (``shard=0`` ...), each by the tasks that read them.

    Nulls in any column are written as they are; a column named ``shard`` is refused.
    """
    if "shard" in docs.columns:
        raise ValueError("the table has a column named shard already")

    @F.pandas_udf("int")
    def shard_of(keys):
        import pandas as pd

        return pd.Series(jump_hash(keys.to_numpy().view(np.uint64).copy(), shards).astype(np.int32))

    docs.withColumn("shard", shard_of(F.xxhash64(key_col))).write.partitionBy("shard").parquet(path)
