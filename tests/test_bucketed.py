"""Bucketed tables: merges that shuffle the stage only, and what a load leaves in the folder."""

import re

import pytest
from pyspark.sql import functions as F

from warehaus.operators.upsert import classify, pinned, update_newer
from warehaus.plans.bucketed import BucketedStore
from warehaus.plans.storage import PART, TableStore, month_of
from warehaus.plans.upserts import lookup_dims, upsert_bucketed, upsert_table
from warehaus.plans.warehouse import load_table
from warehaus.schemas import TABLES
from warehaus.sources.fixtures import BATCH, Fixtures

from conftest import SF_SMALL
from test_plans import physical, plan_text
from test_storage import Stop, files, stops_after


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def filled(spark, root, table, buckets=16):
    fx, spec = Fixtures(spark, SF_SMALL), TABLES[table]
    store = BucketedStore(spark, root, {table: buckets})
    store.create(table, store.by_key(table, fx.dw(table), spec.dw_key))
    return fx, spec, store


def moved_scans(plan: str, table: str) -> list[str]:
    """Exchanges that stand above a scan of the table, from the indented plan tree."""
    lines, found = plan.split("== Physical Plan ==", 1)[-1].splitlines(), []
    depth = lambda line: re.search(r"[A-Za-z*(]", line.replace("+-", "  ").replace(":", " ")).start() if line.strip() else 0
    for i, line in enumerate(lines):
        if "FileScan" in line and table in line:  # a catalog name, or a column that only the table has
            level = depth(line)
            for above in reversed(lines[:i]):
                if above.strip() and depth(above) < level:
                    level = depth(above)
                    if "Exchange" in above:
                        found.append(above.strip())
    return found


@pytest.mark.parametrize("table", ["orders", "orderdetails"])
def test_no_exchange_above_the_target(spark, tmp_root, no_broadcast, table):
    fx, spec, store = filled(spark, f"{tmp_root}/wh", table)
    dw = store.read(table, spec.dw_schema)
    seen = classify(store.by_key(table, fx.stage(table), spec.key), dw, spec, month_of())
    name = store.name(table)
    plan = plan_text(seen)
    assert name in physical(plan) and moved_scans(plan, name) == []
    rows = pinned(seen)
    plan = plan_text(update_newer(store.by_key(table, rows, spec.dw_key), dw, spec, BATCH, lookup_dims(fx)))
    assert name in physical(plan) and moved_scans(plan, name) == []
    # the same steps on a plain table move it
    plain = TableStore(spark, f"{tmp_root}/plain")
    plain.create(table, fx.dw(table))
    plan = plan_text(classify(fx.stage(table), plain.read(table, spec.dw_schema), spec, month_of()))
    assert moved_scans(plan, "src_update_timestamp") != []


def test_bucketed_load_equals_the_plain_one_and_touches_its_months_only(spark, tmp_root):
    fx, spec, store = filled(spark, f"{tmp_root}/wh", "orders", 4)
    store.create("customers", fx.dw_customers)
    before = files(store, "orders")
    got = load_table(store, "orders", fx.stg_orders, BATCH)
    want = upsert_table(fx, "orders")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    after = files(store, "orders")
    changed = {r[0] for r in got.where(F.col("etl_batch_no") == BATCH.no).select(F.concat(F.lit(f"{PART}="), month_of())).distinct().collect()}
    assert {p for p in after if after[p] != before.get(p)} == changed and set(before) - changed
    # at most one file a bucket from each of the two branches
    assert all(len(after[p]) <= 2 * 4 for p in changed)
    again = BucketedStore(spark, f"{tmp_root}/wh", {"orders": 4})  # another opening of the same folder
    assert again.read("orders").exceptAll(want).count() == 0


def test_stopped_bucketed_replacement_is_completed(spark, tmp_root, monkeypatch):
    fx, spec, store = filled(spark, f"{tmp_root}/wh", "orders", 4)
    store.create("customers", fx.dw_customers)
    stops_after(monkeypatch, TableStore, "_move", 2)
    with pytest.raises(Stop):
        load_table(store, "orders", fx.stg_orders, BATCH)
    monkeypatch.undo()
    got = BucketedStore(spark, f"{tmp_root}/wh", {"orders": 4}).read("orders")
    assert got.exceptAll(upsert_table(fx, "orders")).count() == 0


def test_query_is_the_store_load(spark):
    fx = Fixtures(spark, SF_SMALL)
    assert upsert_bucketed(fx, "orderdetails").exceptAll(upsert_table(fx, "orderdetails")).count() == 0
