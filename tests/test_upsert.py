import datetime as dt

from pyspark.sql import functions as F

from warehaus.batch import Batch
from warehaus.operators.dedupe import latest_per_key
from warehaus.operators.lookup import backfill_office, resolve_manager
from warehaus.operators.surrogate import assign_surrogate_keys
from warehaus.operators.upsert import classify, insert_new, update_newer, upsert
from warehaus.schemas import TABLES, conform

B = Batch.of(7, "1998-06-01", "1998-06-02 00:00:00")
T0, T1, T2 = dt.datetime(1998, 1, 1), dt.datetime(1998, 2, 1), dt.datetime(1998, 3, 1)


def offices_stage(spark, rows):
    df = spark.createDataFrame(rows, "officecode string, city string, create_timestamp timestamp_ntz, "
                                     "update_timestamp timestamp_ntz")
    return conform(df, TABLES["offices"].stage)


def offices_dw(spark, rows):
    df = spark.createDataFrame(rows, "dw_office_id bigint, officecode string, city string, "
                                     "src_create_timestamp timestamp_ntz, src_update_timestamp timestamp_ntz")
    return conform(df, TABLES["offices"].dw_schema)


def test_insert_new_and_update_newer(spark):
    spec = TABLES["offices"]
    dw = offices_dw(spark, [(1, "A", "old", T0, T1), (2, "B", "old", T0, T1), (3, "C", "old", T0, None)])
    stage = offices_stage(spark, [("A", "newer", T0, T2), ("B", "same", T0, T1), ("C", "x", T0, T2),
                                  ("E", "new2", T0, T0), ("D", "new1", T0, T0)])
    out = {r.officecode: r for r in upsert(stage, dw, spec, B).collect()}
    assert out["A"].city == "newer" and out["A"].etl_batch_no == 7 and out["A"].src_update_timestamp == T2
    assert out["A"].src_create_timestamp == T0 and out["A"].dw_create_timestamp is None
    assert out["B"].city == "old" and out["B"].etl_batch_no is None          # not strictly newer
    assert out["C"].city == "old"                                            # NULL timestamp: no update
    assert (out["D"].dw_office_id, out["E"].dw_office_id) == (4, 5)          # dense, natural-key order
    assert out["D"].dw_create_timestamp == B.run_ts and out["D"].etl_batch_date == B.date


def test_upsert_is_idempotent(spark):
    spec = TABLES["offices"]
    dw = offices_dw(spark, [(1, "A", "old", T0, T1)])
    stage = offices_stage(spark, [("A", "newer", T0, T2), ("D", "new", T0, T0)])
    once = upsert(stage, dw, spec, B)
    twice = upsert(stage, once, spec, B)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


def test_dedupe_keeps_latest_and_null_keys(spark):
    df = spark.createDataFrame([("A", 1, T0), ("A", 2, T2), ("A", 3, T1), (None, 4, T0), (None, 5, T0)],
                               "k string, v int, update_timestamp timestamp_ntz")
    rows = sorted(((r.k, r.v) for r in latest_per_key(df, ["k"], "update_timestamp").collect()),
                  key=repr)
    assert rows == [("A", 2), (None, 4), (None, 5)]


def test_surrogate_keys_dense_across_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k")).repartition(13)
    out = assign_surrogate_keys(df, "sid", ["k"], start=100).collect()
    assert sorted(r.sid for r in out) == list(range(101, 5101))
    assert all(r.sid == 101 + r.k for r in out)


def test_lookup_misses_give_null_and_updates_reresolve(spark):
    spec = TABLES["orders"]
    customers = conform(spark.createDataFrame([(10, 1)], "dw_customer_id bigint, src_customernumber bigint"),
                        TABLES["customers"].dw_schema)
    stage = conform(spark.createDataFrame(
        [(100, 1, T0, T2), (101, 2, T0, T0)],
        "ordernumber bigint, customernumber bigint, create_timestamp timestamp_ntz, update_timestamp timestamp_ntz"),
        spec.stage)
    dw = conform(spark.createDataFrame([(5, None, 100, 1, T0, T1)],
                                       "dw_order_id bigint, dw_customer_id bigint, src_ordernumber bigint, "
                                       "src_customernumber bigint, src_create_timestamp timestamp_ntz, "
                                       "src_update_timestamp timestamp_ntz"), spec.dw_schema)
    seen, dims = classify(stage, dw, spec), {"customers": customers}
    upd = {r.src_ordernumber: r for r in update_newer(seen, dw, spec, B, dims).collect()}
    assert upd[100].dw_customer_id == 10
    new = {r.src_ordernumber: r for r in insert_new(seen, dw, spec, B, dims).collect()}
    assert new[101].dw_customer_id is None and new[101].dw_order_id == 6


def test_employee_fk_backfills(spark):
    spec = TABLES["employees"]
    emp = conform(spark.createDataFrame(
        [(11, 1, None, "1", None), (12, 2, 1, "2", 99), (13, 3, 7, "1", None)],
        "dw_employee_id bigint, employeenumber bigint, reportsto bigint, officecode string, dw_office_id bigint"),
        spec.dw_schema)
    offices = conform(spark.createDataFrame([(501, "1"), (502, "2")], "dw_office_id bigint, officecode string"),
                      TABLES["offices"].dw_schema)
    out = {r.employeenumber: r for r in backfill_office(resolve_manager(emp), offices).collect()}
    assert out[2].dw_reporting_employee_id == 11
    assert out[3].dw_reporting_employee_id is None          # manager 7 unknown: unchanged
    assert out[1].dw_office_id == 501 and out[2].dw_office_id == 99   # fill only when NULL
