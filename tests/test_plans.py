"""Scale properties of the physical plans, guarded as tests (sf0.001 data)."""

import os

import pytest

import __spark_entry__ as E
from homestat.plans import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas")


@pytest.fixture(autouse=True)
def _full_metadata(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # do not truncate PushedFilters
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()  # with its subqueries, each final and initial


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_cartesian_or_python_evaluation(spark, name):
    plan = _final_plan(E.queries()[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


@pytest.mark.parametrize("name,filt", [
    ("zip_price_trends", "GreaterThanOrEqual(o_orderdate,1999-01-02"),
    ("resale_flips", "GreaterThanOrEqual(o_orderdate,1999-07-05"),
    ("assessment_ratio", "GreaterThanOrEqual(l_shipdate,2000-01-02"),
    ("investor_activity", "GreaterThanOrEqual(o_orderdate,2000-01-02"),
    ("appraisal_gap", "GreaterThanOrEqual(l_shipdate,"),
    ("trend_lines", "GreaterThanOrEqual(o_orderdate,"),
])
def test_date_bounds_reach_the_scan(spark, name, filt):
    assert filt in _final_plan(E.queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["consecutive_pairs", "median_by_group", "pct_change", "rank_by_ratio", "resale_flips"])
def test_no_job_starts_before_an_action(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", "plan building")
    try:
        E.queries()[name](spark, SF)
        # reading a Parquet schema is a job of its own; nothing else runs
        for j in tracker.getJobIdsForGroup(f"build-{name}"):
            stages = [tracker.getStageInfo(s) for s in tracker.getJobInfo(j).stageIds]
            assert all(s is None or s.numTasks <= 1 for s in stages)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["consecutive_pairs", "pct_change", "rank_by_ratio"])
def test_ordered_operators_shuffle_the_rows_once(spark, name):
    df = E.queries()[name](spark, SF)
    whole = spark.read.parquet(f"{SF}/{'customer' if name == 'rank_by_ratio' else 'orders'}.parquet").count()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    main = plan.split("Subqueries")[0]
    assert main.count("Exchange hashpartitioning") <= 3 and "Checkpoint" not in plan and "Scan ExistingRDD" not in plan
    assert whole > 0


def test_latest_n_limits_before_the_shuffle(spark):
    plan = _final_plan(E.queries()["latest_n"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_column_pruning_at_the_scan(spark):
    plan = _final_plan(E.queries()["investor_activity"](spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
