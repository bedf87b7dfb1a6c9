"""Plan guards for every registered query: what must never appear at scale."""

import contextlib
import io
import re

import pytest

from warehaus.plans.catalog import queries

from conftest import SF_SMALL

# The batch runs are sequences of jobs, each planned by the same operators.
QUERIES = {k: f for k, f in queries().items() if not k.startswith(("etl_", "snapshot_rows"))}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_text(fn(spark, SF_SMALL)) for k, fn in QUERIES.items()}


def physical(text: str) -> str:
    return text.split("== Physical Plan ==", 1)[-1]


def test_no_cross_joins_or_python_udfs(plans):
    for key, text in plans.items():
        p = physical(text)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                    "ArrowEvalPython", "PythonUDF"):
            assert bad not in p, (key, bad)


def test_windows_only_over_partition_counts(plans):
    for key, text in plans.items():
        for line in physical(text).splitlines():
            if re.search(r"\bWindow \[", line):
                assert "_pid" in line, (key, line)


def test_batch_date_filters_reach_the_scan(plans):
    p = physical(plans["daily_customer_summary"])
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(orderdate", p)
    p = physical(plans["daily_customer_payments"])
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(paymentdate", p)
    p = physical(plans["scd2_product"])
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(dw_active_record_ind,1\)", p)


def test_columns_are_pruned_at_the_scan(plans):
    p = physical(plans["daily_product_summary"])
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all("src_create_timestamp" not in s for s in schemas)


def tree(p: str) -> list[str]:
    return p.splitlines()


def joins_on(p: str, key: str) -> int:
    return sum(1 for line in tree(p) if re.search(r"(SortMerge|BroadcastHash|ShuffledHash)Join \[" + key, line))


def scans(p: str) -> str:
    return "\n".join(line for line in tree(p) if "FileScan" in line)


def test_daily_summaries_join_lines_once_and_never_expand(plans):
    for key in ("daily_customer_summary", "daily_product_summary", "daily_customer_orders", "daily_product_orders"):
        p = physical(plans[key])
        assert "Expand" not in p, key
        assert joins_on(p, "dw_order_id") == 1, key


def test_single_blocks_push_their_own_condition(plans):
    for key, column in (("daily_customer_cancelled", "cancelleddate"), ("daily_customer_shipped", "shippeddate"),
                        ("daily_product_cancelled", "cancelleddate"), ("daily_product_orders", "orderdate")):
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(" + column, physical(plans[key])), key
    assert "dw_products" not in scans(physical(plans["daily_customer_cancelled"]))


def test_update_reads_only_the_dimensions_it_sets(plans):
    for key in ("update_newer_orderdetails", "update_newer_payments"):
        p = physical(plans[key])
        assert not re.search(r"/dw_(orders|products|customers)\b", p), key


def test_upsert_classifies_the_stage_once(spark, tmp_root):
    from warehaus.operators.upsert import classify
    from warehaus.schemas import TABLES
    from warehaus.sources.fixtures import Fixtures
    fx = Fixtures(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = physical(plan_text(classify(fx.stg_orders, fx.dw_orders, TABLES["orders"])))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum("Exchange hashpartitioning" in line for line in tree(p)) == 2   # the stage and the narrow probe
    assert re.search(r"ReadSchema: struct<src_ordernumber:bigint,src_update_timestamp:timestamp_ntz>", p)


def test_history_is_scanned_once_for_closes_and_opens(plans):
    for key in ("scd2_close_product", "scd2_open_customer"):
        p = physical(plans[key])
        assert len(re.findall(r"\bSortMergeJoin|ShuffledHashJoin", p)) <= 1, key
