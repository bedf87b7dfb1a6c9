"""Queries for the keyed upserts, FK resolution and surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from warehaus.operators.lookup import backfill_office, resolve_manager
from warehaus.operators.repair import repair_fk
from warehaus.operators.surrogate import assign_surrogate_keys
from warehaus.operators.upsert import classify, insert_new, prepare_stage, update_newer, upsert
from warehaus.plans.bucketed import BucketedStore
from warehaus.plans.warehouse import load_table
from warehaus.schemas import LOAD_ORDER, TABLES
from warehaus.session import scratch_path
from warehaus.sources.fixtures import BATCH, Fixtures


def lookup_dims(fx: Fixtures) -> dict[str, DataFrame]:
    """Dimensions as the warehouse held them before the batch."""
    return {"productlines": fx.dw_productlines, "customers": fx.dw_customers,
            "orders": fx.dw_orders, "products": fx.dw_products}


def prepared(fx: Fixtures, table: str) -> DataFrame:
    return prepare_stage(fx.stage(table), TABLES[table], lookup_dims(fx))


def _classified(fx: Fixtures, table: str) -> DataFrame:
    return classify(fx.stage(table), fx.dw(table), TABLES[table])


def insert_new_rows(fx: Fixtures, table: str) -> DataFrame:
    return insert_new(_classified(fx, table), fx.dw(table), TABLES[table], BATCH, lookup_dims(fx))


def update_newer_rows(fx: Fixtures, table: str) -> DataFrame:
    return update_newer(_classified(fx, table), fx.dw(table), TABLES[table], BATCH, lookup_dims(fx), only_changed=True)


def upsert_table(fx: Fixtures, table: str) -> DataFrame:
    out = upsert(fx.stage(table), fx.dw(table), TABLES[table], BATCH, lookup_dims(fx))
    if table == "employees":
        out = backfill_office(resolve_manager(out), fx.dw_offices)
    return out


def repaired_orderdetails(fx: Fixtures) -> DataFrame:
    """Lines inserted before their new orders, then filled by the orders that the batch inserts."""
    spec = TABLES["orderdetails"]
    parents = {"orders": insert_new_rows(fx, "orders"), "products": insert_new_rows(fx, "products")}
    return repair_fk(insert_new_rows(fx, "orderdetails"), parents, spec.lookups)


def upsert_bucketed(fx: Fixtures, table: str, buckets: int = 16) -> DataFrame:
    """A table's upsert in a store that keeps it bucketed on its natural key."""
    spec = TABLES[table]
    store = BucketedStore(fx.spark, scratch_path(fx.spark, "bucketed"), {table: buckets})
    store.create(table, store.by_key(table, fx.dw(table), spec.dw_key))
    for lk in spec.lookups:
        store.create(lk.dimension, lookup_dims(fx)[lk.dimension])
    return load_table(store, table, fx.stage(table), BATCH)


def _q(fn, *args):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Fixtures(spark, sf_dir), *args)
    return run


def queries() -> dict:
    q = {}
    for t in LOAD_ORDER:
        q[f"insert_new_{t}"] = _q(insert_new_rows, t)
        q[f"update_newer_{t}"] = _q(update_newer_rows, t)
        q[f"upsert_{t}"] = _q(upsert_table, t)
    for t in ("products", "orders", "orderdetails", "payments"):
        q[f"fk_{t}"] = _q(prepared, t)
    q["fk_employees_manager"] = _q(lambda fx: resolve_manager(fx.dw_employees))
    q["fk_employees_office"] = _q(lambda fx: backfill_office(fx.dw_employees, fx.dw_offices))
    for t in ("orders", "orderdetails"):
        q[f"upsert_{t}_bucketed"] = _q(upsert_bucketed, t)
    q["fk_repair_orderdetails"] = _q(repaired_orderdetails)
    q["surrogate_keys"] = _q(lambda fx: assign_surrogate_keys(
        fx.stg_orders.select("ordernumber", "customernumber", "orderdate"),
        "dw_order_id", ["ordernumber"], start=0))
    return q
