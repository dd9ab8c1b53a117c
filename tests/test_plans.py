"""Plan shape: pushed filters, pruned scans, no Cartesian products, no Python."""

import pytest

import __spark_entry__ as E
from conftest import SMALL
from tallyhall.operators import explore, filters
from tallyhall.plans import catalog
from tallyhall.sources import fixtures as fx


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Line-item scans of the queries that read the fact a second time.
SCANS = {"active_sites_per_sheet": 2, "pivot_all_grains": 2, "monthly_home_pivot": 2, "preview_200": 2, "site_month_series": 2,
         "heat_grid": 2, "payload_envelope": 3,
         "complete_sheets": 4}  # its list of sheets is named three times in the plan and run once

# Queries about tables that they write first.
WRITES = {"fact_table_months", "search_index", "bucketed_fact_months", "export_csv_summary"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_of_every_query(spark, name):
    """Building a query runs no job; its plan has no Cartesian product, no
    Python, no round robin, and reads the line items once."""
    sc = spark.sparkContext
    sc.setJobGroup(f"plan-{name}", name)
    try:
        p = plan_of(E.queries()[name](spark, SMALL))
        assert name in WRITES or not sc.statusTracker().getJobIdsForGroup(f"plan-{name}")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "RoundRobinPartitioning"):
        assert bad not in p, f"{name}: {bad}"
    assert sum("lineitem.parquet" in x for x in p.splitlines() if "FileScan" in x) <= SCANS.get(name, 1)


def test_explorer_filter_reaches_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        p = plan_of(E.queries()["preview_200"](spark, SMALL))
        assert "EqualTo(o_orderpriority,1-URGENT)" in p
        view = explore.export_view(fx.fact(spark, SMALL, explore.EXPORT_FACT_COLUMNS))
        view.limit(50).write.parquet(f"{tmp_path}/view")
        hit = spark.read.parquet(f"{tmp_path}/view").where(filters.spec_predicate(catalog.FIXTURE_SPEC))
        pushed = plan_of(hit).split("PushedFilters")[1]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(pillar_name,1-URGENT)" in pushed
    assert "GreaterThanOrEqual(event_startdate,1996-01-01)" in pushed and "LessThanOrEqual(event_startdate,1997-12-31)" in pushed


def test_status_filter_pushed_into_scan(spark):
    p = plan_of(E.queries()["site_index"](spark, SMALL))
    assert "Not(EqualTo(o_orderstatus,P))" in p


def test_scan_is_pruned(spark):
    p = plan_of(E.queries()["monthly_rollup"](spark, SMALL))
    li = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "l_partkey" not in li.split("ReadSchema")[-1] or "ReadSchema" not in li
    assert "part.parquet" not in p and "supplier.parquet" not in p


def test_monthly_rollup_needs_only_orders_and_lineitem(spark):
    p = plan_of(E.queries()["monthly_rollup"](spark, SMALL))
    assert "customer.parquet" not in p and "part.parquet" not in p
