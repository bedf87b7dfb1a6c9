"""Steps that grew faster than what a batch changes: stage dedupe, order lines, files of a partitioned write."""

import datetime as dt

from pyspark.sql import functions as F

from warehaus.operators import summary as S
from warehaus.operators.upsert import NEW, NEWER, PARTS, VERDICT, classify
from warehaus.plans.storage import PART, TableStore, month_of
from warehaus.schemas import TABLES

from test_plans import physical, plan_text
from test_summary import B, tables
from test_upsert import T0, T1, T2, offices_dw, offices_stage

SPEC = TABLES["offices"]


def test_stage_meets_the_target_before_it_is_reduced(spark):
    stage = offices_stage(spark, [("A", "x", T0, T2)])
    dw = offices_dw(spark, [(1, "A", "old", T0, T1)])
    lines = physical(plan_text(classify(stage, dw, SPEC, month_of()))).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join [" in line)
    assert not any("Aggregate(" in line for line in lines[join:])


def test_repeats_on_both_sides_are_classified_once(spark):
    later = dt.datetime(1998, 2, 5)
    dw = offices_dw(spark, [(1, "A", "jan", T0, T0), (2, "A", "feb", later, T1), (3, "A", "kept", T2, T2),
                            (4, "B", "old", T0, T1), (5, "C", "old", T0, None)])
    stage = offices_stage(spark, [
        ("A", "first", T0, T1), ("A", "last", T0, T2), ("A", "no time", T0, None), ("B", "same", T0, T1), ("C", "x", T0, T2),
        ("D", "older", T0, T0), ("D", "newer", T0, T1), ("E", "no time", T0, None), (None, "one", T0, T0), (None, "one", T0, T0)])
    got = classify(stage, dw, SPEC, month_of()).collect()
    found = sorted(((r.officecode or "-", r.city, r[VERDICT], sorted(r[PARTS] or [])) for r in got))
    assert found == [("-", "one", NEW, []), ("-", "one", NEW, []), ("A", "last", NEWER, ["1998-01", "1998-02"]),
                     ("D", "newer", NEW, []), ("E", "no time", NEW, [])]


def test_order_lines_are_aggregated_in_the_blocks_only(spark):
    o, od, p, c, pay = tables(spark)
    for df in (S.daily_product_summary(o, od, p, B), S.customer_orders_block(o, od, p, B)):
        text = physical(plan_text(df))
        assert sum("Aggregate(" in line for line in text.splitlines()) == 4  # two levels, each in two steps
    # a product on two lines of an order counts once, its values add up
    twice = od.where("dw_order_id = 1 and dw_product_id = 7")
    rows = {(r.summary_date, r.dw_customer_id): r for r in S.customer_orders_block(o, od.unionByName(twice), p, B).collect()}
    r = rows[(dt.date(1998, 6, 1), 100)]
    assert (r.order_count, r.products_ordered_qty, r.products_items_qty, str(r.order_cost_amount)) == (2, 2, 4, "13.00")


def test_files_of_a_write_do_not_multiply_tasks_by_months(spark, tmp_root):
    store = TableStore(spark, tmp_root)
    rows = spark.range(0, 2400, 1, 12).select(
        "id", F.expr("timestamp_ntz'2005-01-01 00:00:00' + make_interval(0, int(id % 24))").alias("src_create_timestamp"))
    assert store.create("t", rows).exceptAll(rows).count() == 0
    files = store.spark.read.parquet(store.path("t")).select(PART, F.input_file_name().alias("f")).distinct().count()
    assert len(store.parts("t")) == 24 and files <= 2 * 24
