"""A sink that keeps every batch of a stream once, in as many tables as a batch feeds.

Structured Streaming repeats a batch that it has not recorded as done, so what a batch writes may be written twice. Here a
batch's rows go to a folder of its own number, which a repeat replaces, and only then is the number entered in the ledger, together with
the rows written. Readers see the batches in the ledger and no others. A batch that is already there is left alone.
A stop at any point between leaves each row once: before the entry nobody reads the rows, after it nobody writes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LEDGER = "batch_id bigint, table string, rows bigint, committed_at timestamp"
Outputs = Callable[[DataFrame, int], dict[str, DataFrame]]


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    return _exists(spark, f"{path}/ledger/batch={batch_id}/_SUCCESS")


def write_batch(batch: DataFrame, batch_id: int, path: str, outputs: Outputs) -> bool:
    """Write all tables of a batch, then enter it in the ledger; False if it was there already."""
    spark = batch.sparkSession
    if is_committed(spark, path, batch_id):
        return False
    held, written = batch.persist(), []
    try:
        for name, frame in outputs(held, batch_id).items():
            seen = Observation(f"{name}-{batch_id}")
            frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
            written.append((batch_id, name, seen.get["rows"]))
    finally:
        held.unpersist()
    commit(spark, path, batch_id, written)
    return True


def commit(spark: SparkSession, path: str, batch_id: int, written: list[tuple]) -> None:
    """Enter a batch: one small file, and the mark that it is whole."""
    entries = F.array(*[F.struct(F.lit(b).cast("bigint").alias("batch_id"), F.lit(n).alias("table"), F.lit(r).cast("bigint").alias("rows")) for b, n, r in written])
    frame = spark.range(1).select(F.inline(entries)).withColumn("committed_at", F.current_timestamp())
    frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/batch={batch_id}")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """What has been committed: one row per batch and table. Whole entries only."""
    if not _exists(spark, f"{path}/ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(f"{path}/ledger")


def read_committed(spark: SparkSession, path: str, name: str, schema) -> DataFrame:
    """The table's rows of committed batches, with their ``batch`` number; the ledger prunes the folders that are scanned."""
    if not _exists(spark, f"{path}/{name}"):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(0).cast("bigint"))
    fields = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = spark.read.schema(f"{fields}, batch bigint").parquet(f"{path}/{name}")
    done = ledger(spark, path).where(F.col("table") == name).select(F.col("batch_id").alias("batch")).distinct()
    return rows.join(done, "batch", "left_semi")


def start(stream: DataFrame, path: str, outputs: Outputs, **trigger):
    """Run the stream into the tables under ``path``; offsets are kept beside them, so a restart goes on."""
    writer = stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(**(trigger or {"availableNow": True}))
    return writer.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, path, outputs) and None).start()
