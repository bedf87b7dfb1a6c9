import datetime as dt
from decimal import Decimal as D

from warehaus.batch import Batch
from warehaus.operators import monthly as M
from warehaus.operators import summary as S
from warehaus.schemas import TABLES, conform

B = Batch.of(7, "1998-06-01", "1998-06-02 00:00:00")
D1, D2 = dt.date(1998, 6, 1), dt.date(1998, 6, 2)


def tables(spark):
    orders = conform(spark.createDataFrame(
        [(1, 100, D1, None, None, "Cancelled"), (2, 100, D1, D2, None, "Shipped"),
         (3, None, D1, None, None, "In Process"), (4, 100, dt.date(1998, 5, 1), None, D2, "Cancelled")],
        "dw_order_id bigint, dw_customer_id bigint, orderdate date, shippeddate date, cancelleddate date, "
        "status string"), TABLES["orders"].dw_schema)
    od = conform(spark.createDataFrame(
        [(1, 7, 2, D("1.50")), (1, 8, 1, D("2.00")), (2, 7, 5, D("1.00")), (3, 7, 1, D("1.00")),
         (4, 8, 3, D("2.00"))],
        "dw_order_id bigint, dw_product_id bigint, quantityordered int, priceeach decimal(18,2)"),
        TABLES["orderdetails"].dw_schema)
    products = conform(spark.createDataFrame([(7, D("3.00")), (8, D("4.00"))],
                                             "dw_product_id bigint, msrp decimal(18,2)"),
                       TABLES["products"].dw_schema)
    customers = conform(spark.createDataFrame([(100, dt.datetime(1998, 6, 2))],
                                              "dw_customer_id bigint, src_create_timestamp timestamp_ntz"),
                        TABLES["customers"].dw_schema)
    payments = conform(spark.createDataFrame([(100, D2, D("9.99"))],
                                             "dw_customer_id bigint, paymentdate date, amount decimal(18,2)"),
                       TABLES["payments"].dw_schema)
    return orders, od, products, customers, payments


def test_daily_customer_summary(spark):
    rows = {(r.summary_date, r.dw_customer_id): r
            for r in S.daily_customer_summary(*tables(spark), B).collect()}
    r = rows[(D1, 100)]
    assert (r.order_count, r.order_apd, r.products_ordered_qty, r.products_items_qty) == (2, 1, 2, 3)
    assert r.order_cost_amount == D("10.00") and r.order_mrp_amount == D("25.00")
    assert rows[(D1, None)].order_count == 1                      # NULL customer forms its own group
    r2 = rows[(D2, 100)]
    assert (r2.shipped_order_count, r2.shipped_order_apd, r2.shipped_order_amount) == (1, 1, D("5.00"))
    assert (r2.cancelled_order_count, r2.cancelled_order_amount) == (1, D("6.00"))  # line count
    assert (r2.payment_apd, r2.new_customer_paid_apd, r2.new_customer_apd) == (1, 1, 1)


def test_daily_product_summary_normalises_status(spark):
    o, od, p, _, _ = tables(spark)
    rows = {(r.summary_date, r.dw_product_id): r for r in S.daily_product_summary(o, od, p, B).collect()}
    assert rows[(D1, 7)].customer_apd == 1                          # NULL customer not counted
    assert rows[(D2, 8)].cancelled_product_qty == 3 and rows[(D2, 8)].cancelled_order_apd == 1


def test_monthly_delta_and_additive_merge(spark):
    daily = S.daily_customer_summary(*tables(spark), B)
    delta = M.monthly_customer_delta(daily, B)
    row = [r for r in delta.collect() if r.dw_customer_id == 100][0]
    assert row.order_apm == 2 and row.shipped_order_apm == 1 and row.payment_apm == 1
    key = ["start_of_the_month_date", "dw_customer_id"]
    once = M.merge_additive(M.stamp_new(delta, B), delta, key, M.MONTHLY_CUSTOMER_COLUMNS, B)
    got = {r.dw_customer_id: r for r in once.collect()}
    assert got[100].order_count == 2 * row.order_count
    # NULL keys never match: the delta's NULL-customer row is inserted again.
    assert sum(1 for r in once.collect() if r.dw_customer_id is None) == 2
