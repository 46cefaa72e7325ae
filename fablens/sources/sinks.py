"""Writing tables, reports, summaries and the audit trail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fablens.schema import AUDIT


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Replace (or append to) a table of files and return it as a scan.

    With ``partition_by`` an overwrite replaces only the partitions present in
    ``df``, so a daily load rewrites its own days and no others.
    """
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """A catalog table bucketed and sorted on ``key``, in the warehouse or under ``path``.

    Two tables bucketed alike join on that key without an exchange.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **properties: str) -> None:
    """Replace a database table; each partition opens its own connection."""
    df.write.jdbc(url, table, mode=mode, properties=properties)


def write_report(df: DataFrame, path: str) -> DataFrame:
    """Result as CSV files with a header; returns the scan of what was written."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.option("header", True).schema(df.schema).csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A one-record summary as JSON."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_summary(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def audit_record(summary: DataFrame, batch_id: str, notes: str | None = None) -> DataFrame:
    """One audit row from a quality summary."""
    return summary.select(
        F.concat_ws(":", F.lit(batch_id), F.col("dataset")).alias("log_id"),
        F.lit(batch_id).alias("batch_run_id"),
        F.current_timestamp().alias("check_timestamp"),
        F.col("dataset").alias("dataset_name"),
        F.col("rows").alias("total_records"),
        F.col("features").alias("total_features"),
        F.col("duplicate_rows"),
        F.col("missing_value_rate_pct").alias("overall_missing_pct"),
        F.col("columns_gt_50_pct_missing").alias("high_missing_cols_count"),
        F.col("constant_columns").alias("constant_cols_count"),
        F.col("pass_observations").alias("pass_count"),
        F.col("fail_observations").alias("fail_count"),
        F.col("quality_status"),
        F.lit(notes).cast("string").alias("notes"),
    )


def audit_append(summary: DataFrame, batch_id: str, path: str, notes: str | None = None) -> DataFrame:
    """Append one audit row; earlier batches stay. Returns the whole log."""
    audit_record(summary, batch_id, notes).write.mode("append").parquet(path)
    return summary.sparkSession.read.schema(AUDIT).parquet(path)


def register_views(**frames: DataFrame) -> None:
    """Named views over frames, for reports written in SQL."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def scan_sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Run SQL text over named frames: ``{view}`` in the text stands for a frame."""
    return spark.sql(text, **views)
