"""Metamorphic properties on the fixture warehouse (sf0.001)."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from warehaus.batch import Batch
from warehaus.operators import monthly as M
from warehaus.operators import summary as S
from warehaus.operators.scd2 import scd2
from warehaus.schemas import conform, history_schema
from warehaus.sources.fixtures import BATCH, Fixtures

from conftest import SF_SMALL


def test_daily_totals_equal_source_lines(spark):
    fx = Fixtures(spark, SF_SMALL)
    daily = S.daily_customer_summary(fx.wh_orders, fx.wh_orderdetails, fx.dw_products,
                                     fx.dw_customers, fx.wh_payments, BATCH)
    lines = (fx.wh_orders.filter(F.col("orderdate") >= F.lit(BATCH.date))
             .join(fx.wh_orderdetails, "dw_order_id")
             .join(fx.dw_products.select("dw_product_id", "msrp"), "dw_product_id"))
    want = lines.agg(F.sum(F.col("priceeach") * F.col("quantityordered")).alias("a"),
                     F.count("quantityordered").alias("n")).first()
    got = daily.agg(F.sum("order_cost_amount").alias("a"), F.sum("products_items_qty").alias("n")).first()
    assert got.a == want.a and got.n == want.n
    pay = fx.wh_payments.filter(F.col("paymentdate") >= F.lit(BATCH.date)).agg(F.sum("amount")).first()[0]
    assert daily.agg(F.sum("payment_amount")).first()[0] == pay


def test_additive_merge_is_associative_for_sums(spark):
    fx = Fixtures(spark, SF_SMALL)
    key = ["start_of_the_month_date", "dw_product_id"]
    L = M.MONTHLY_PRODUCT_COLUMNS
    base = fx.monthly_product_prior.filter(F.col("dw_product_id").isNotNull())
    delta = M.monthly_product_delta(fx.daily_product_hist, BATCH).filter(F.col("dw_product_id").isNotNull())
    half_a = delta.filter(F.col("dw_product_id") % 2 == 0)
    half_b = delta.filter(F.col("dw_product_id") % 2 == 1)
    b8 = Batch.of(8, "1998-06-02")
    stepwise = M.merge_additive(M.merge_additive(base, half_a, key, L, BATCH), half_b, key, L, b8)
    at_once = M.merge_additive(base, delta, key, L, BATCH)
    sums = ["product_cost_amount", "product_mrp_amount", "cancelled_product_qty"]
    def totals(df):
        return df.agg(*[F.sum(c).alias(c) for c in sums], F.count(F.lit(1)).alias("n")).first()
    assert totals(stepwise) == totals(at_once)


def test_same_day_second_change_closes_before_it_opened(spark):
    h = conform(spark.createDataFrame([(1, D("10"), dt.date(1998, 1, 1), None, 1)],
                                      "dw_product_id bigint, msrp decimal(18,2), effective_from_date date, "
                                      "effective_to_date date, dw_active_record_ind int"),
                history_schema("dw_product_id", "msrp"))
    first = scd2(h, spark.createDataFrame([(1, D("11"))], "dw_product_id bigint, msrp decimal(18,2)"),
                 "dw_product_id", "msrp", BATCH)
    second = scd2(first, spark.createDataFrame([(1, D("12"))], "dw_product_id bigint, msrp decimal(18,2)"),
                  "dw_product_id", "msrp", BATCH)
    row = [r for r in second.collect() if r.msrp == D("11")][0]
    assert row.effective_from_date == BATCH.date
    assert row.effective_to_date == BATCH.date - dt.timedelta(days=1)   # kept as the reference does
    assert sum(r.dw_active_record_ind for r in second.collect()) == 1
