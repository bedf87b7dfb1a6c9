"""SCD-2 history queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from warehaus.operators.scd2 import close_changed, open_new, scd2
from warehaus.sources.fixtures import BATCH, Fixtures

# history key -> (history fixture, dimension fixture, id column, tracked column)
SUBJECTS = {"product": ("dw_product_history", "dw_products", "dw_product_id", "msrp"),
            "customer": ("dw_customer_history", "dw_customers", "dw_customer_id", "creditlimit")}


def _args(fx: Fixtures, subject: str):
    hist, dim, id_col, tracked = SUBJECTS[subject]
    return getattr(fx, hist), getattr(fx, dim), id_col, tracked


def _q(fn, subject):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        h, d, i, t = _args(Fixtures(spark, sf_dir), subject)
        return fn(h, d, i, t, BATCH)
    return run


def queries() -> dict:
    q = {}
    for subject in SUBJECTS:
        q[f"scd2_close_{subject}"] = _q(close_changed, subject)
        q[f"scd2_open_{subject}"] = _q(open_new, subject)
        q[f"scd2_{subject}"] = _q(scd2, subject)
    return q
