"""Monthly roll-ups of the daily summaries and their additive merge.

``COUNT(DISTINCT CASE WHEN m > 0 THEN summary_date END)`` is computed as a
two-level aggregate: first per (month, entity, day) with an "any row has
m > 0" flag, then per (month, entity) summing the flags.  This equals the
distinct count and avoids expanding every daily row once per distinct
expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warehaus.batch import Batch
from warehaus.operators.summary import cents, from_cents

# Fixed values, which must equal the reference's: layouts of the monthly summaries (ids and counts bigint).
MONTHLY_CUSTOMER_COLUMNS = (
    ("start_of_the_month_date", "date"), ("dw_customer_id", "bigint"),
    ("order_count", "bigint"), ("order_apd", "bigint"), ("order_apm", "bigint"),
    ("order_cost_amount", "decimal(18,2)"),
    ("cancelled_order_count", "bigint"), ("cancelled_order_amount", "decimal(18,2)"),
    ("cancelled_order_apd", "bigint"), ("cancelled_order_apm", "bigint"),
    ("shipped_order_count", "bigint"), ("shipped_order_amount", "decimal(18,2)"),
    ("shipped_order_apd", "bigint"), ("shipped_order_apm", "bigint"),
    ("payment_apd", "bigint"), ("payment_apm", "bigint"), ("payment_amount", "decimal(18,2)"),
    ("products_ordered_qty", "bigint"), ("products_items_qty", "bigint"),
    ("order_mrp_amount", "decimal(18,2)"),
    ("new_customer_apd", "bigint"), ("new_customer_apm", "bigint"),
    ("new_customer_paid_apd", "bigint"), ("new_customer_paid_apm", "bigint"))

MONTHLY_PRODUCT_COLUMNS = (
    ("start_of_the_month_date", "date"), ("dw_product_id", "bigint"),
    ("customer_apd", "bigint"), ("customer_apm", "bigint"),
    ("product_cost_amount", "decimal(18,2)"), ("product_mrp_amount", "decimal(18,2)"),
    ("cancelled_product_qty", "bigint"), ("cancelled_cost_amount", "decimal(18,2)"),
    ("cancelled_mrp_amount", "decimal(18,2)"),
    ("cancelled_order_apd", "bigint"), ("cancelled_order_apm", "bigint"))

# Monthly "active days" measures: apm column -> daily measure that must be > 0.
CUSTOMER_ACTIVE_DAYS = {"cancelled_order_apm": "cancelled_order_count",
                        "shipped_order_apm": "shipped_order_count",
                        "payment_apm": "payment_amount",
                        "new_customer_apm": "new_customer_apd",
                        "new_customer_paid_apm": "new_customer_paid_apd"}
CUSTOMER_SUMMED = ("order_count", "order_apd", "order_cost_amount", "cancelled_order_count",
                   "cancelled_order_amount", "cancelled_order_apd", "shipped_order_count",
                   "shipped_order_amount", "shipped_order_apd", "payment_apd", "payment_amount",
                   "products_ordered_qty", "products_items_qty", "order_mrp_amount",
                   "new_customer_apd", "new_customer_paid_apd")


STAMPS = ("dw_create_timestamp", "dw_update_timestamp", "etl_batch_no", "etl_batch_date")


def _layout(df: DataFrame, layout) -> DataFrame:
    """The layout's columns, its money given in cents."""
    return df.select(*[(from_cents(n) if t.startswith("decimal") else F.col(n)).cast(t).alias(n) for n, t in layout])


def _summand(name: str, layout):
    """A daily measure as it is summed: money in whole cents (bigint), as in the daily summaries."""
    return (cents(name) if dict(layout)[name].startswith("decimal") else F.col(name)).alias(name)


def batch_rows(daily: DataFrame, batch: Batch) -> DataFrame:
    """Daily rows written by this batch or later (partition filter on etl_batch_date)."""
    return daily.filter(F.col("etl_batch_date") >= batch.date_col())


def monthly_customer_delta(daily: DataFrame, batch: Batch) -> DataFrame:
    # Dealt once by the coarse key, which serves both levels: a daily table has few rows per day and
    # customer, so a combine before the shuffle would save nothing.
    rows = batch_rows(daily, batch).select(
        F.trunc("summary_date", "month").alias("start_of_the_month_date"), "dw_customer_id", "summary_date",
        *[_summand(m, MONTHLY_CUSTOMER_COLUMNS) for m in CUSTOMER_SUMMED]).repartition("start_of_the_month_date", "dw_customer_id")
    per_day = rows.groupBy("start_of_the_month_date", "dw_customer_id", "summary_date").agg(
        *[F.sum(m).alias(m) for m in CUSTOMER_SUMMED],
        *[F.max(F.when(F.col(src) > 0, 1).otherwise(0)).alias(f"_{apm}")
          for apm, src in CUSTOMER_ACTIVE_DAYS.items()])
    dated = F.col("summary_date").isNotNull()
    g = per_day.groupBy("start_of_the_month_date", "dw_customer_id").agg(
        *[F.sum(m).alias(m) for m in CUSTOMER_SUMMED],
        F.count("summary_date").alias("order_apm"),
        *[F.sum(F.when(dated, F.col(f"_{apm}")).otherwise(0)).alias(apm)
          for apm in CUSTOMER_ACTIVE_DAYS])
    return _layout(g, MONTHLY_CUSTOMER_COLUMNS)


def monthly_product_delta(daily: DataFrame, batch: Batch) -> DataFrame:
    rows = batch_rows(daily, batch)
    g = rows.groupBy(F.trunc("summary_date", "month").alias("start_of_the_month_date"),
                     "dw_product_id").agg(
        F.max("customer_apd").alias("customer_apd"), F.lit(1).alias("customer_apm"),
        F.sum(_summand("product_cost_amount", MONTHLY_PRODUCT_COLUMNS)).alias("product_cost_amount"),
        F.sum(_summand("product_mrp_amount", MONTHLY_PRODUCT_COLUMNS)).alias("product_mrp_amount"),
        F.sum("cancelled_product_qty").alias("cancelled_product_qty"),
        F.sum(_summand("cancelled_cost_amount", MONTHLY_PRODUCT_COLUMNS)).alias("cancelled_cost_amount"),
        F.sum(_summand("cancelled_mrp_amount", MONTHLY_PRODUCT_COLUMNS)).alias("cancelled_mrp_amount"),
        F.max("cancelled_order_apd").alias("cancelled_order_apd"),
        F.sum("cancelled_order_apd").alias("cancelled_order_apm"))
    return _layout(g, MONTHLY_PRODUCT_COLUMNS)


def stamp_new(delta: DataFrame, batch: Batch) -> DataFrame:
    return delta.select("*", batch.ts_col().alias("dw_create_timestamp"),
                        batch.ts_col().alias("dw_update_timestamp"),
                        batch.no_col().alias("etl_batch_no"), batch.date_col().alias("etl_batch_date"))


def merge_additive(monthly: DataFrame, delta: DataFrame, key: list[str], layout,
                   batch: Batch) -> DataFrame:
    """Stored aggregates plus this batch's delta.

    Matching keys add every measure (a NULL on either side gives NULL, as SQL
    addition does); delta keys without a stored row are inserted; NULL keys
    never match, so such delta rows are always inserted.  One full join, so
    either side is computed and shuffled once.
    """
    types, measures = dict(layout), [n for n, _ in layout if n not in key]
    m = monthly.select(*[F.col(n) for n, _ in layout], *STAMPS, F.lit(True).alias("_stored"))
    t = delta.select(*[F.col(c).alias(f"_t_{c}") for c in types], F.lit(True).alias("_brought"))
    j = m.join(t, reduce(lambda a, b: a & b, [m[k] == t[f"_t_{k}"] for k in key]), "full")
    stored, brought = F.col("_stored").isNotNull(), F.col("_brought").isNotNull()
    both = lambda n: F.when(stored & brought, F.col(n) + F.col(f"_t_{n}")).when(stored, F.col(n)).otherwise(F.col(f"_t_{n}"))
    now = {"dw_create_timestamp": (~stored, batch.ts_col(), "timestamp_ntz"), "dw_update_timestamp": (brought, batch.ts_col(), "timestamp_ntz"),
           "etl_batch_no": (brought, batch.no_col(), "int"), "etl_batch_date": (brought, batch.date_col(), "date")}
    return j.select(
        *[F.when(stored, F.col(k)).otherwise(F.col(f"_t_{k}")).cast(types[k]).alias(k) for k in key],
        *[both(n).cast(types[n]).alias(n) for n in measures],
        *[F.when(new, value).otherwise(F.col(n)).cast(kind).alias(n) for n, (new, value, kind) in now.items()])
