"""Physical-plan properties the design relies on."""

import pytest

import __spark_entry__ as entry
from skuflow.plans import warehouse
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_python_udf_and_no_cartesian(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def final_plan(df):
    """The plan that ran: adaptive execution reuses equal subplans as it goes."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("threshold", ["-1", "64MB"])
def test_flagship_scans_facts_once(spark, threshold):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k, None) for k in keys]
    for k in keys:
        spark.conf.set(k, threshold)
    try:
        p = final_plan(warehouse.sales_report_zero_filled(spark, SF_SMALL))
    finally:
        for k, v in zip(keys, before):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert p.count("lineitem.parquet") == 1
    assert p.count("orders.parquet") == 1


@pytest.mark.parametrize("name", ["sales_report_zero_filled", "inventory_report_zero_filled", "report_contract", "run_summary",
                                  "sales_report_wide"])
def test_reports_need_no_window(spark, name):
    p = final_plan(entry.queries()[name](spark, SF_SMALL))
    assert "Window" not in p and p.count("lineitem.parquet") == 1


def test_order_documents_shuffle_lines_once(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k, None) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        p = plan(warehouse.landed_tiktok_fbt(spark, SF_SMALL))
    finally:
        for k, v in zip(keys, before):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    by_order = [x for x in p.splitlines() if "Exchange hashpartitioning(" in x and "orderkey" in x]
    assert len(by_order) == 2, p      # lines and orders; the grouping needs none


def test_pushdown_and_pruning(spark):
    p = final_plan(warehouse.sales_report_zero_filled(spark, SF_SMALL))
    assert "PushedFilters: [Not(EqualNullSafe(o_orderstatus,P))" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in p


def test_pre_aggregation_before_mapping_join(spark):
    p = plan(warehouse.sales_by_sku_channel(spark, SF_SMALL))
    # the mapping join sits above a final hash aggregate on the source key
    join_at = p.find("Join [source_key")
    assert join_at >= 0
    assert "HashAggregate(keys=[_k" in p[join_at:]
