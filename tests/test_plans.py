"""Plan shapes that must hold at any size."""

from fablens.operators import evaluation, kpi, profiling
from fablens.plans import QUERIES
from fablens.sources import bindings as B
from fablens.sources import telemetry


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_they_need(spark, folder):
    cells = kpi.line_cells(B.table(spark, folder, "orders"), B.table(spark, folder, "lineitem"))
    plan = plan_of(kpi.production_yield_daily(cells))
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_lines_fold_before_they_are_joined(spark, folder):
    plan = plan_of(kpi.line_cells(B.table(spark, folder, "orders"), B.table(spark, folder, "lineitem")))
    join = plan.index("Join")
    assert plan.index("partial_count", join) > join, "the partial count must sit below the join"


def test_profile_is_one_shuffle(spark, folder):
    vectors = B.vectors(B.table(spark, folder, "embeddings"))
    plan = plan_of(profiling.sensor_stats(telemetry.to_readings(vectors)))
    assert plan.count("Exchange") == 1 and "partial_avg" in plan
    # The array expression is not repeated in a filter.
    assert "size(" not in plan


def test_curve_reads_the_scores_once(spark, folder):
    scored = B.scored_models(B.table(spark, folder, "lineitem"))
    plan = plan_of(evaluation.threshold_curve(scored, ["model"]))
    assert plan.count("FileScan") == 1
    # Only the slots travel, not the distinct scores.
    assert "hashpartitioning(model" in plan and "hashpartitioning(p" not in plan


def test_route_is_shuffle_free(spark, folder):
    assert "Exchange" not in plan_of(QUERIES["operational_alerts"](spark, folder))
    assert "Exchange" not in plan_of(QUERIES["score_lots"](spark, folder))
    assert "Exchange" not in plan_of(QUERIES["missing_row_gate"](spark, folder))


def test_integrity_checks_read_each_table_once(spark, folder):
    # Two star tables, both projections of the events, and the sensor arrays.
    assert plan_of(QUERIES["integrity_checks"](spark, folder)).count("FileScan") == 3


def test_set_difference_profiles_the_readings_once(spark, folder):
    # The statistics are written; what is left reads their file, not the arrays.
    assert "embedding" not in plan_of(QUERIES["candidate_set_difference"](spark, folder))


def test_bucketed_star_join_moves_no_row(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["star_join_bucketed"](spark, folder))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
