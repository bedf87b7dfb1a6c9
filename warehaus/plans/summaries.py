"""Summary queries over the fixture warehouse (daily blocks, daily, monthly, merges)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warehaus.operators import active_days as D
from warehaus.operators import monthly as M
from warehaus.operators import summary as S
from warehaus.sources.fixtures import BATCH, PRIOR_BATCH, Fixtures


def _inputs(fx: Fixtures):
    return fx.wh_orders, fx.wh_orderdetails, fx.dw_products, fx.dw_customers, fx.wh_payments


def daily_customer(fx: Fixtures, batch=BATCH) -> DataFrame:
    return S.daily_customer_summary(*_inputs(fx), batch)


def daily_product(fx: Fixtures, batch=BATCH) -> DataFrame:
    o, od, p, _, _ = _inputs(fx)
    return S.daily_product_summary(o, od, p, batch)


def merged_with_days(fx: Fixtures, subject: str) -> DataFrame:
    """Monthly merge whose day counts come from day maps: a day in both batches counts once."""
    if subject == "customer":
        id_col, days, layout, delta = "dw_customer_id", D.CUSTOMER_DAYS, M.MONTHLY_CUSTOMER_COLUMNS, M.monthly_customer_delta
        prior, daily = fx.monthly_customer_prior, fx.daily_customer_hist
    else:
        id_col, days, layout, delta = "dw_product_id", D.PRODUCT_DAYS, M.MONTHLY_PRODUCT_COLUMNS, M.monthly_product_delta
        prior, daily = fx.monthly_product_prior, fx.daily_product_hist
    stored = D.day_maps(daily.where(F.col("etl_batch_date") < BATCH.date_col()), PRIOR_BATCH, id_col, days)
    maps = D.merge_maps(stored, D.day_maps(daily, BATCH, id_col, days), id_col, days)
    merged = M.merge_additive(prior, delta(daily, BATCH), [D.MONTH, id_col], layout, BATCH)
    return D.count_days(merged, maps, id_col, days)


def _q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Fixtures(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


def queries() -> dict:
    return {
        "daily_customer_summary": _q(daily_customer),
        "daily_customer_orders": _q(lambda fx: S.customer_orders_block(
            fx.wh_orders, fx.wh_orderdetails, fx.dw_products, BATCH)),
        "daily_customer_new": _q(lambda fx: S.customer_new_block(fx.dw_customers, BATCH)),
        "daily_customer_cancelled": _q(lambda fx: S.customer_cancelled_block(
            fx.wh_orders, fx.wh_orderdetails, fx.dw_products, BATCH)),
        "daily_customer_payments": _q(lambda fx: S.customer_payments_block(fx.wh_payments, BATCH)),
        "daily_customer_shipped": _q(lambda fx: S.customer_shipped_block(
            fx.wh_orders, fx.wh_orderdetails, fx.dw_products, BATCH)),
        "daily_product_orders": _q(lambda fx: S.product_orders_block(
            fx.wh_orders, fx.wh_orderdetails, fx.dw_products, BATCH)),
        "daily_product_cancelled": _q(lambda fx: S.product_cancelled_block(
            fx.wh_orders, fx.wh_orderdetails, fx.dw_products, BATCH)),
        "daily_product_summary": _q(daily_product),
        "monthly_customer_delta": _q(lambda fx: M.monthly_customer_delta(
            fx.daily_customer_hist, BATCH)),
        "monthly_product_delta": _q(lambda fx: M.monthly_product_delta(
            fx.daily_product_hist, BATCH)),
        "monthly_customer_merge": _q(lambda fx: M.merge_additive(
            fx.monthly_customer_prior, M.monthly_customer_delta(fx.daily_customer_hist, BATCH),
            ["start_of_the_month_date", "dw_customer_id"], M.MONTHLY_CUSTOMER_COLUMNS, BATCH)),
        "monthly_customer_merge_days": _q(lambda fx: merged_with_days(fx, "customer")),
        "monthly_product_merge_days": _q(lambda fx: merged_with_days(fx, "product")),
        "monthly_product_merge": _q(lambda fx: M.merge_additive(
            fx.monthly_product_prior, M.monthly_product_delta(fx.daily_product_hist, BATCH),
            ["start_of_the_month_date", "dw_product_id"], M.MONTHLY_PRODUCT_COLUMNS, BATCH)),
    }
