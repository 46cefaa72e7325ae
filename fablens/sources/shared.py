"""Intermediate tables that several steps read.

A fitted statistic (medians, bin bounds, score counts) is computed once and
written to the shared folder. That cuts lineage, survives lost executors and
gives the optimizer a real size: it broadcasts the table when the files are
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. No join
in this library carries a broadcast hint.

A query's result reads these tables lazily, so they must outlive the call that
wrote them: ``discard`` removes one that nothing reads any more, ``cleanup``
all that the session has written, once its results are stored.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: dict[str, list[str]] = {}
_named: dict[str, list[str]] = {}
_seen: dict[tuple[str, str], set[str]] = {}


def _executors(spark: SparkSession) -> set[str]:
    """Addresses of the executors that are there now, and of the driver."""
    infos = spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()
    return {f"{x.host()}:{x.port()}" for x in infos}


def _sees_all_files(spark: SparkSession, folder: str, executors: int) -> bool:
    """Whether the driver finds what tasks on all cores have written into the folder."""
    rows = max(executors, spark.sparkContext.defaultParallelism)
    path = f"{folder}/fablens/probe-{uuid.uuid4().hex}"
    try:
        spark.range(0, rows, 1, rows).write.parquet(path)
        return spark.read.schema("id bigint").parquet(path).count() == rows
    finally:
        _remove(spark, path)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode.

    Outside local mode a bare path belongs to the cluster's default file system. Where that is the local one, tasks
    write a few rows there, in each session and again when executors have joined, and the path is refused if the driver
    misses any: tables would lose rows.
    ``file:`` names a mounted folder on purpose and is taken as shared.
    """
    context = spark.sparkContext
    local = context.master.startswith("local") and not context.master.startswith("local-cluster")
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder:
        default = context._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        folder = folder.rstrip("/")
        if not local and "://" not in folder and not folder.startswith("file:") and default.startswith("file:"):
            probed, executors = _seen.setdefault((context.applicationId, folder), set()), _executors(spark)
            if executors - probed:
                if not _sees_all_files(spark, folder, len(executors)):
                    raise RuntimeError(f"executors write to other folders than the driver's {folder}; name one in spark.checkpoint.dir that all share")
                probed |= executors
        return folder
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="fablens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/fablens/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def literal_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A handful of rows known in the program (a lookup, a sensor list), built inside the plan."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return it as a scan of the written files."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.written_to = path
    return found


def new_name(spark: SparkSession, label: str) -> str:
    """A name for a catalog table that ``cleanup`` drops."""
    name = f"fablens_{label}_{uuid.uuid4().hex}"
    _named.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` returned and nothing reads any more."""
    for table in tables:
        spark, path = table.sparkSession, table.written_to
        _remove(spark, path)
        kept = _written.get(spark.sparkContext.applicationId, [])
        if path in kept:
            kept.remove(path)


def cleanup(spark: SparkSession) -> int:
    """Remove everything the session's calls have written and not discarded; returns how many tables."""
    for name in _named.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _remove(spark, path)
    return len(paths)
