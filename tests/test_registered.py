import re

import pytest

import __spark_entry__ as entry
from check import compare, connect
from dotreef.plans import registered
from dotreef.session import TASK_SETTINGS

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(registered.QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    assert compare(spark, con, SMALL, name) == ""


def test_every_query_has_sql():
    assert set(registered.QUERIES) == set(registered.SQL)
    assert set(registered.QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_plans_stay_in_the_jvm_and_never_pair_everything(spark):
    for name, fn in registered.QUERIES.items():
        plan = fn(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        found = re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|ArrowEvalPython|BatchEvalPython|SinglePartition", plan)
        # One-row results (and the preview) end in a single partition by nature.
        allowed = {"SinglePartition"} if name in ("qc_report", "profile", "row_id", "row_number", "preview") else set()
        assert set(found) <= allowed, (name, found)


@pytest.mark.parametrize("name", ["unmatched_classes", "unmatched_classes_sink", "campaign_id_diff", "campaign_point_checks", "coverage_summary", "anti_single", "fan_outs", "landing_findings", "archive_findings"])
def test_findings_are_not_empty(spark, name):
    assert registered.QUERIES[name](spark, SMALL).count() > 0


@pytest.mark.parametrize("name", ["overlay_labels", "counts_by_path", "rosetta_counts", "qc_report", "archive_findings"])
def test_dots_are_read_once(spark, name):
    df = registered.QUERIES[name](spark, SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet[^\n]*lineitem.parquet", plan)) == 1, plan


def test_scans_read_only_what_they_need(spark):
    plan = entry.queries()["benthos_by_code"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"lineitem.parquet.*?ReadSchema: struct<([^>]*)>", plan, re.S).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"}
    assert plan.count("Exchange hashpartitioning(campaignid") == 1


def test_tasks_are_cut_by_bytes(spark):
    """A registered query bounds its tasks whatever the session says: nothing larger than the advisory size, hot keys cut."""
    old = {key: spark.conf.get(key, None) for key in TASK_SETTINGS}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        entry.queries()["benthos_without_code"](spark, SMALL)
        assert {key: spark.conf.get(key) for key in TASK_SETTINGS} == TASK_SETTINGS
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
