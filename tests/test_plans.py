"""Physical plans and results of the registered queries."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from paygrain import queries as catalogue

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")

WRITES_FILES = {
    "backfill_table",
    "bi_safe_export",
    "bronze_append",
    "bronze_scan",
    "bronze_stream_upsert",
    "load_report",
    "watermark_state",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_an_sql_twin():
    assert set(catalogue.REGISTRY) == set(catalogue.oracle_sql()) <= set(entry.queries())


def test_no_query_crosses_or_leaves_the_jvm(spark):
    """With broadcasts switched off, as it would be if every table were large."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in sorted(set(catalogue.REGISTRY) - WRITES_FILES):
            plan = plan_of(catalogue.run(name, spark, SMALL))
            for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
                assert word not in plan, (name, word)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_latest_version_is_limited_before_the_shuffle(spark):
    plan = plan_of(catalogue.run("latest_per_key", spark, SMALL))
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_window_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(catalogue.run("incremental_window", spark, SMALL))
    assert "GreaterThan(ts," in plan and "LessThanOrEqual(ts," in plan
    assert "props" not in plan and "value" not in plan.split("ReadSchema")[1]


def test_movements_are_shuffled_once_for_their_versions(spark):
    """The lines' only shuffle is the point-in-time join; the dimension's windows share one."""
    dim = plan_of(catalogue.run("dim_employee", spark, SMALL))
    assert dim.count("Exchange hashpartitioning(employment_id") == 1


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 6000 and df.columns[0] == "movement_id"


def test_slicers_come_before_the_windows(spark):
    """The orders meet the slicer's customers before anything else; lines are scanned once per fact."""
    for name in ("report_kpis", "report_net_by_month", "report_net_by_concept", "slicer_filter"):
        plan = catalogue.run(name, spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.splitlines()
        for at in [i for i, line in enumerate(lines) if line.lstrip(" :+-").startswith("Window")]:
            depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
            below = []
            for line in lines[at + 1 :]:
                if len(line) - len(line.lstrip(" :+-")) <= depth:
                    break
                below.append(line)
            assert any("LeftSemi" in line for line in below), name
    plan = plan_of(catalogue.run("fct_payroll_movement", spark, SMALL))
    assert plan.count("lineitem.parquet") == 1


def test_additive_measures_do_not_expand_the_fact(spark):
    for name in ("m_earnings", "m_deductions", "m_settlements", "m_paid_indemnity"):
        above, below = plan_of(catalogue.run(name, spark, SMALL)).split("Expand", 1)
        assert "lineitem.parquet" not in above and below.count("HashAggregate(keys=[country_code") >= 2
