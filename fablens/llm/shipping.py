"""Give executors the code and small files that tasks need, through Spark's own file server."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark import SparkFiles
from pyspark.sql import SparkSession

import fablens

_ROOT = os.path.dirname(os.path.abspath(fablens.__file__))


def _served_folder(spark: SparkSession) -> str:
    """A folder of the driver's own, which Spark serves to executors and removes when it stops."""
    return tempfile.mkdtemp(dir=spark.sparkContext._temp_dir)


# Texts can be long: batches between the JVM and Python hold fewer rows than Spark's default of 10,000.
BATCH_KEY, DEFAULT_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def ship_package(spark: SparkSession) -> None:
    """Add this package to the session's Python files, once: tasks then run without an installed copy.

    A session with Spark's default Arrow batch size gets smaller batches; another size that was set stays.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_KEY) == DEFAULT_ROWS:
        spark.conf.set(BATCH_KEY, BATCH_ROWS)
    if getattr(context, "_fablens_shipped", False):
        return
    path = os.path.join(_served_folder(spark), f"fablens-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for here, _, names in os.walk(_ROOT):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(here, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(_ROOT)))
    context.addPyFile(path)
    context._fablens_shipped = True


def ship_bytes(spark: SparkSession, label: str, data: bytes) -> str:
    """Add a small file under a new name; ``local_path`` finds it in tasks."""
    name = f"{label}-{uuid.uuid4().hex}"
    path = os.path.join(_served_folder(spark), name)
    with open(path, "wb") as out:
        out.write(data)
    spark.sparkContext.addFile(path)
    return name


def local_path(name: str) -> str:
    return SparkFiles.get(name)
