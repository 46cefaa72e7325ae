"""Queries that keep intermediate tables, on a cluster whose spark.checkpoint.dir is a bare path (as in spark-defaults.conf)."""

import json
import os
import subprocess
import sys

import pytest

from fablens.plans import ORACLES
from tests import oracle

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

KEPT = [
    "audit_append",
    "average_precision",
    "candidate_set_difference",
    "champion",
    "champion_alerts",
    "champion_drivers",
    "composite_rank",
    "conformal_bounds",
    "conformal_bounds_by_tool",
    "corrected_daily_cells",
    "explain_boosted",
    "explain_logistic",
    "explain_forest",
    "feature_matrix",
    "fit_medians_by_tool",
    "feature_ranking",
    "forecast_bounds",
    "fit_medians",
    "incremental_orphans",
    "incremental_summary",
    "impute_median_train",
    "incremental_profile",
]

RUN = """
import json, sys
root, folder, out, *names = sys.argv[1:]
sys.path.insert(0, root)
from pyspark.sql import SparkSession
from fablens.plans import QUERIES
conf = {"spark.master": "local-cluster[2,2,1024]", "spark.executor.memory": "1024m", "spark.checkpoint.dir": f"{out}/kept",
        "spark.local.dir": f"{out}/local", "spark.sql.warehouse.dir": f"{out}/warehouse", "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.driver.host": "127.0.0.1"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
failed = {}
for name in names:
    try:
        QUERIES[name](spark, folder).write.parquet(f"{out}/{name}")
    except Exception as x:
        failed[name] = f"{type(x).__name__}: {x}"[:500]
print("FAILED", json.dumps(failed))
"""


@pytest.fixture(scope="module")
def ran(folder, tmp_path_factory):
    """Where the results are, and what failed."""
    out = tmp_path_factory.mktemp("cluster")
    ended = subprocess.run([sys.executable, "-c", RUN, ROOT, folder, str(out), *KEPT], capture_output=True, text=True, timeout=900)
    said = [x for x in ended.stdout.splitlines() if x.startswith("FAILED ")]
    assert said, ended.stderr[-2000:]
    return out, json.loads(said[0].removeprefix("FAILED "))


@pytest.mark.parametrize("name", KEPT)
def test_query_runs_on_a_cluster(spark, folder, ran, name):
    out, failed = ran
    assert failed.get(name, "") == ""
    found = spark.read.parquet(f"{out}/{name}")
    assert oracle.differences(found, oracle.connect(folder), ORACLES[name]) == ""
