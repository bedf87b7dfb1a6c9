"""Daily customer and product summaries.

Orders are joined to their lines, and these to the products, once.  Each order's lines are
then dealt to the blocks they belong to (ordered, cancelled, shipped), grouped
per (date, entity, counted id) and once more per (date, entity).  Money is
summed in whole cents (bigint, which holds more than the layouts' decimal(18,2)).  Distinct
counts come out as plain counts of the finer level, so no row is expanded per
distinct expression, and a hot customer or the NULL-customer group combines
map-side.  New customers and payments meet these on the way to (date, entity), and a batch that writes
both summaries joins their lines once (``daily_lines``).  A single block filters the orders by its own
condition only.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from warehaus.batch import Batch

# Fixed values, which must equal the reference's: block layouts (name, type) of the daily
# customer and product summaries.  Ids and counts are wider here (bigint).
DAILY_CUSTOMER_COLUMNS = (
    ("summary_date", "date"), ("dw_customer_id", "bigint"),
    ("order_count", "bigint"), ("order_apd", "bigint"), ("order_cost_amount", "decimal(18,2)"),
    ("cancelled_order_count", "bigint"), ("cancelled_order_amount", "decimal(18,2)"),
    ("cancelled_order_apd", "bigint"),
    ("shipped_order_count", "bigint"), ("shipped_order_amount", "decimal(18,2)"),
    ("shipped_order_apd", "bigint"),
    ("payment_apd", "bigint"), ("payment_amount", "decimal(18,2)"),
    ("products_ordered_qty", "bigint"), ("products_items_qty", "bigint"),
    ("order_mrp_amount", "decimal(18,2)"),
    ("new_customer_apd", "bigint"), ("new_customer_paid_apd", "bigint"))

DAILY_PRODUCT_COLUMNS = (
    ("summary_date", "date"), ("dw_product_id", "bigint"), ("customer_apd", "bigint"),
    ("product_cost_amount", "decimal(18,2)"), ("product_mrp_amount", "decimal(18,2)"),
    ("cancelled_product_qty", "bigint"), ("cancelled_cost_amount", "decimal(18,2)"),
    ("cancelled_mrp_amount", "decimal(18,2)"), ("cancelled_order_apd", "bigint"))

AUDIT_COLUMNS = (("dw_create_timestamp", "timestamp_ntz"), ("dw_update_timestamp", "timestamp_ntz"),
                 ("etl_batch_no", "int"), ("etl_batch_date", "date"))


def table_schema(layout) -> StructType:
    """Layout of a stored summary: its columns and the audit columns."""
    return StructType.fromDDL(", ".join(f"{n} {t}" for n, t in (*layout, *AUDIT_COLUMNS)))


def _pad(df: DataFrame, layout, values: dict[str, Column]) -> DataFrame:
    """Project onto a block layout: given values, else constant 0, cast per column."""
    return df.select(*[values.get(n, F.lit(0)).cast(t).alias(n) for n, t in layout])


def _since(c: str, batch: Batch) -> Column:
    return F.to_date(F.col(c)) >= batch.date_col()


def cents(c: str) -> Column:
    return (F.col(c).cast("decimal(18,2)") * 100).cast("bigint")


def from_cents(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)") * F.lit(Decimal("0.01"))


def order_lines(orders, orderdetails, products, order_filter: Column) -> DataFrame:
    """The lines of the chosen orders with their values.

    Orders are filtered first, so the predicate reaches the scan, and meet their lines before the
    products do, so only lines of chosen orders are matched with these.  ``known``:
    the product exists; ``mrp`` is null otherwise; ``amount`` and ``mrp`` are cents.  Without ``products`` the
    lines are not joined to any.  An order holds a product on one line as a
    rule, so lines are not reduced to (order, product) first: the counted ids
    are made distinct in the blocks' own finer level.
    """
    o = orders.filter(order_filter).select(
        "dw_order_id", "dw_customer_id", *[F.to_date(c).alias(c) for c in ("orderdate", "cancelleddate", "shippeddate")], "status")
    od = orderdetails.select("dw_order_id", "dw_product_id", "quantityordered", "priceeach")
    lines = o.join(od, "dw_order_id")
    if products is None:
        lines = lines.withColumns({"msrp": F.lit(None).cast("decimal(18,2)"), "known": F.lit(None).cast("boolean")})
    else:
        lines = lines.join(products.select("dw_product_id", "msrp", F.lit(True).alias("known")), "dw_product_id", "left")
    return lines.select(
        *o.columns, "dw_product_id", "known", F.lit(1).alias("lines"), F.col("quantityordered").isNotNull().cast("int").alias("items"),
        F.col("quantityordered").alias("quantity"), (cents("priceeach") * F.col("quantityordered")).alias("amount"),
        (cents("msrp") * F.col("quantityordered")).alias("mrp"))


def _conditions(batch: Batch) -> dict[str, Column]:
    return {"orders": _since("orderdate", batch),
            "cancelled": _since("cancelleddate", batch) & (F.col("status") == "Cancelled"),
            "shipped": _since("shippeddate", batch) & (F.col("status") == "Shipped")}


def _any(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out | c
    return out


# -- daily customer blocks ----------------------------------------------------
# What the counted id of an entry identifies (numbers, as they are part of a grouping key).
PRODUCT, ORDER, NOTHING = 1, 2, 3
# Measures of a customer's day below the layout: summed ones (money in cents) and flags.
COUNTS, MONEY = ("items", "cancelled_lines", "shipped_lines"), ("order_amount", "mrp", "cancelled_amount", "shipped_amount")
DAY_SUMS = ("orders", "products", *COUNTS, *MONEY, "payment")
DAY_FLAGS = ("order_apd", "cancelled_apd", "shipped_apd", "payment_apd", "new_apd")


def _customer_entries(rows: DataFrame, wanted: dict[str, Column]) -> DataFrame:
    """The order-based blocks' entries, aggregated to (date, customer, counted id).

    Every line gives an entry per block it belongs to, and in
    the ordered block one more that only names its order; orders and products
    are then counted on the (date, customer, counted id) level.
    """
    flags = ("order_apd", "cancelled_apd", "shipped_apd")

    def entry(date: str, kind: int, counted: Column, flag: str, **values: str | None) -> Column:
        """``kind``: what ``counted`` identifies (``PRODUCT``, ``ORDER``, ``NOTHING``); a value not given is 0, None is NULL."""
        def value(n: str) -> Column:
            return F.lit(0) if n not in values else F.lit(None) if values[n] is None else F.col(values[n])

        return F.struct(
            F.col(date).alias("summary_date"), F.lit(kind).alias("kind"), counted.cast("bigint").alias("counted"),
            *[value(n).cast("bigint").alias(n) for n in (*COUNTS, *MONEY)],
            *[F.lit(int(f == flag)).cast("bigint").alias(f) for f in flags])

    parts = []
    if "orders" in wanted:
        ordered = wanted["orders"] & F.col("known")
        parts += [F.when(ordered, entry("orderdate", PRODUCT, F.col("dw_product_id"), "order_apd",
                                        items="items", order_amount="amount", mrp="mrp")),
                  F.when(ordered, entry("orderdate", ORDER, F.col("dw_order_id"), "order_apd", order_amount=None, mrp=None))]
    for block in ("cancelled", "shipped"):
        if block in wanted:
            parts.append(F.when(wanted[block], entry(
                f"{block}date", NOTHING, F.lit(None), f"{block}_apd", **{f"{block}_lines": "lines", f"{block}_amount": "amount"})))
    dealt = rows.select("dw_customer_id", F.inline(F.array(*parts))).where("kind is not null")
    fine = dealt.groupBy("summary_date", "dw_customer_id", "kind", "counted").agg(
        *[F.sum(m).alias(m) for m in (*COUNTS, *MONEY)], *[F.max(m).alias(m) for m in flags])
    counted = lambda kind: ((F.col("kind") == kind) & F.col("counted").isNotNull()).cast("bigint")
    return _day_rows(fine, {**{n: F.col(n) for n in (*COUNTS, *MONEY, *flags)}, "orders": counted(ORDER), "products": counted(PRODUCT)})


def _day_rows(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Rows that add up to a customer's day; a measure not given is 0."""
    return df.select("summary_date", "dw_customer_id", *[
        values.get(n, F.lit(0)).cast("bigint").alias(n) for n in (*DAY_SUMS, *DAY_FLAGS)])


def _customer_days(rows: DataFrame) -> DataFrame:
    """One row per (date, customer) in the common layout."""
    g = rows.groupBy("summary_date", "dw_customer_id").agg(
        *[F.sum(m).alias(m) for m in DAY_SUMS], *[F.max(m).alias(m) for m in DAY_FLAGS])
    return _pad(g, DAILY_CUSTOMER_COLUMNS, {
        "summary_date": F.col("summary_date"), "dw_customer_id": F.col("dw_customer_id"),
        "order_count": F.col("orders"), "order_apd": F.col("order_apd"), "order_cost_amount": from_cents("order_amount"),
        "cancelled_order_count": F.col("cancelled_lines"), "cancelled_order_amount": from_cents("cancelled_amount"),
        "cancelled_order_apd": F.col("cancelled_apd"),
        "shipped_order_count": F.col("shipped_lines"), "shipped_order_amount": from_cents("shipped_amount"),
        "shipped_order_apd": F.col("shipped_apd"), "payment_apd": F.col("payment_apd"), "payment_amount": from_cents("payment"),
        "products_ordered_qty": F.col("products"), "products_items_qty": F.col("items"), "order_mrp_amount": from_cents("mrp"),
        "new_customer_apd": F.col("new_apd"), "new_customer_paid_apd": F.col("payment_apd")})


def _customer_order_blocks(orders, orderdetails, products, batch: Batch, blocks: tuple[str, ...]) -> DataFrame:
    """The order-based blocks, aggregated together per (date, customer) in the common layout."""
    wanted = {b: c for b, c in _conditions(batch).items() if b in blocks}
    rows = order_lines(orders, orderdetails, products if "orders" in wanted else None, _any(wanted.values()))
    return _customer_days(_customer_entries(rows, wanted))


def customer_orders_block(orders, orderdetails, products, batch: Batch) -> DataFrame:
    return _customer_order_blocks(orders, orderdetails, products, batch, ("orders",))


def _new_customers(customers, batch: Batch) -> DataFrame:
    return customers.filter(_since("src_create_timestamp", batch)).withColumn("summary_date", F.to_date("src_create_timestamp"))


def customer_new_block(customers, batch: Batch) -> DataFrame:
    return _pad(_new_customers(customers, batch), DAILY_CUSTOMER_COLUMNS, {
        "summary_date": F.col("summary_date"),
        "dw_customer_id": F.col("dw_customer_id"), "new_customer_apd": F.lit(1)})


def customer_cancelled_block(orders, orderdetails, products, batch: Batch) -> DataFrame:
    return _customer_order_blocks(orders, orderdetails, products, batch, ("cancelled",))


def customer_shipped_block(orders, orderdetails, products, batch: Batch) -> DataFrame:
    return _customer_order_blocks(orders, orderdetails, products, batch, ("shipped",))


def _payments(payments, batch: Batch) -> DataFrame:
    p = payments.filter(_since("paymentdate", batch)).withColumn("summary_date", F.to_date("paymentdate"))
    return _day_rows(p, {"payment": cents("amount"), "payment_apd": F.lit(1)})


def customer_payments_block(payments, batch: Batch) -> DataFrame:
    return _customer_days(_payments(payments, batch))


def _stamp(df: DataFrame, batch: Batch) -> DataFrame:
    return df.select("*", batch.ts_col().alias("dw_create_timestamp"),
                     batch.ts_col().alias("dw_update_timestamp"),
                     batch.no_col().alias("etl_batch_no"), batch.date_col().alias("etl_batch_date"))


def daily_lines(orders, orderdetails, products, batch: Batch) -> DataFrame:
    """The lines that either daily summary deals to its blocks, for both to read."""
    return order_lines(orders, orderdetails, products, _any([*_conditions(batch).values(), *_product_conditions(batch).values()]))


def daily_customer_summary(orders, orderdetails, products, customers, payments,
                           batch: Batch, lines: DataFrame | None = None) -> DataFrame:
    """All blocks.  New customers and payments join the orders' entries on the way to (date, customer),
    so one aggregate gives the day.  ``lines``: ``daily_lines`` of the batch, where they are at hand."""
    wanted = _conditions(batch)
    rows = order_lines(orders, orderdetails, products, _any(wanted.values())) if lines is None else lines
    days = (_customer_entries(rows, wanted)
            .unionByName(_day_rows(_new_customers(customers, batch), {"new_apd": F.lit(1)}))
            .unionByName(_payments(payments, batch)))
    return _stamp(_customer_days(days), batch)


# -- daily product blocks -------------------------------------------------------
def _product_conditions(batch: Batch) -> dict[str, Column]:
    return {"orders": _since("orderdate", batch),
            "cancelled": (F.lower(F.trim(F.col("status"))) == "cancelled") & _since("cancelleddate", batch)}


def _product_blocks(orders, orderdetails, products, batch: Batch, blocks: tuple[str, ...],
                    lines: DataFrame | None = None) -> DataFrame:
    """Both product blocks, aggregated together per (date, product) in the common layout."""
    wanted = {b: c for b, c in _product_conditions(batch).items() if b in blocks}
    rows = (order_lines(orders, orderdetails, products, _any(wanted.values())) if lines is None else lines).where("known")
    zero = F.lit(0).cast("bigint")

    def entry(date: str, mine: bool) -> Column:
        """``mine``: an ordered row, else a cancelled one; the counted id is the customer or the order."""
        one, two = F.lit(mine), F.lit(not mine)
        pick = lambda use, c: F.when(use, F.col(c)).otherwise(zero)
        return F.struct(F.col(date).alias("summary_date"), one.alias("ordered"),
                        F.when(one, F.col("dw_customer_id")).otherwise(F.col("dw_order_id")).alias("counted"),
                        pick(one, "amount").alias("cost"), pick(one, "mrp").alias("mrp"),
                        F.when(two, F.col("quantity")).otherwise(F.lit(0)).alias("cancelled_qty"),
                        pick(two, "amount").alias("cancelled_cost"), pick(two, "mrp").alias("cancelled_mrp"))

    parts = [F.when(c, entry("orderdate" if b == "orders" else "cancelleddate", b == "orders")) for b, c in wanted.items()]
    dealt = rows.select("dw_product_id", F.inline(F.array(*parts))).where("ordered is not null")
    measures = ("cost", "mrp", "cancelled_qty", "cancelled_cost", "cancelled_mrp")
    fine = dealt.groupBy("summary_date", "dw_product_id", "ordered", "counted").agg(*[F.sum(m).alias(m) for m in measures])
    g = fine.groupBy("summary_date", "dw_product_id").agg(
        *[F.sum(m).alias(m) for m in measures], F.count(F.when(F.col("ordered"), F.col("counted"))).alias("customers"),
        F.count(F.when(~F.col("ordered"), F.col("counted"))).alias("cancelled_orders"))
    return _pad(g, DAILY_PRODUCT_COLUMNS, {
        "summary_date": F.col("summary_date"), "dw_product_id": F.col("dw_product_id"), "customer_apd": F.col("customers"),
        "product_cost_amount": from_cents("cost"), "product_mrp_amount": from_cents("mrp"),
        "cancelled_product_qty": F.col("cancelled_qty"), "cancelled_cost_amount": from_cents("cancelled_cost"),
        "cancelled_mrp_amount": from_cents("cancelled_mrp"), "cancelled_order_apd": F.col("cancelled_orders")})


def product_orders_block(orders, orderdetails, products, batch: Batch) -> DataFrame:
    return _product_blocks(orders, orderdetails, products, batch, ("orders",))


def product_cancelled_block(orders, orderdetails, products, batch: Batch) -> DataFrame:
    return _product_blocks(orders, orderdetails, products, batch, ("cancelled",))


def daily_product_summary(orders, orderdetails, products, batch: Batch, lines: DataFrame | None = None) -> DataFrame:
    return _stamp(_product_blocks(orders, orderdetails, products, batch, ("orders", "cancelled"), lines), batch)
