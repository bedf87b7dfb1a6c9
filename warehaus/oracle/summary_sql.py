"""Oracle SQL for the daily and monthly summaries."""

from __future__ import annotations

from warehaus.oracle.base import pad_sql
from warehaus.oracle.fixtures_sql import CTES
# Fixed values, stated here on their own: the summary layouts.  n: bigint, d: decimal(18,2).
def _columns(id_col: str, first: str, text: str) -> tuple[tuple[str, str], ...]:
    types = {"n": "bigint", "d": "decimal(18,2)"}
    return ((first, "date"), (id_col, "bigint"), *[(x.split(":")[0], types[x.split(":")[1]]) for x in text.split()])


DAILY_CUSTOMER_COLUMNS = _columns("dw_customer_id", "summary_date", """
order_count:n order_apd:n order_cost_amount:d cancelled_order_count:n cancelled_order_amount:d cancelled_order_apd:n
shipped_order_count:n shipped_order_amount:d shipped_order_apd:n payment_apd:n payment_amount:d products_ordered_qty:n
products_items_qty:n order_mrp_amount:d new_customer_apd:n new_customer_paid_apd:n""")
DAILY_PRODUCT_COLUMNS = _columns("dw_product_id", "summary_date", """
customer_apd:n product_cost_amount:d product_mrp_amount:d cancelled_product_qty:n cancelled_cost_amount:d
cancelled_mrp_amount:d cancelled_order_apd:n""")
MONTHLY_CUSTOMER_COLUMNS = _columns("dw_customer_id", "start_of_the_month_date", """
order_count:n order_apd:n order_apm:n order_cost_amount:d cancelled_order_count:n cancelled_order_amount:d
cancelled_order_apd:n cancelled_order_apm:n shipped_order_count:n shipped_order_amount:d shipped_order_apd:n
shipped_order_apm:n payment_apd:n payment_apm:n payment_amount:d products_ordered_qty:n products_items_qty:n
order_mrp_amount:d new_customer_apd:n new_customer_apm:n new_customer_paid_apd:n new_customer_paid_apm:n""")
MONTHLY_PRODUCT_COLUMNS = _columns("dw_product_id", "start_of_the_month_date", """
customer_apd:n customer_apm:n product_cost_amount:d product_mrp_amount:d cancelled_product_qty:n cancelled_cost_amount:d
cancelled_mrp_amount:d cancelled_order_apd:n cancelled_order_apm:n""")
# Flags OR-ed across blocks; every other customer measure is summed.
CUSTOMER_FLAGS = ("order_apd", "cancelled_order_apd", "shipped_order_apd", "payment_apd", "new_customer_apd",
                  "new_customer_paid_apd")


def batch_stamp(no: int, run_ts: str, date: str) -> str:
    return (f"CAST(TIMESTAMP '{run_ts}' AS TIMESTAMP) AS dw_create_timestamp, "
            f"CAST(TIMESTAMP '{run_ts}' AS TIMESTAMP) AS dw_update_timestamp, "
            f"CAST({no} AS INTEGER) AS etl_batch_no, DATE '{date}' AS etl_batch_date")


B7 = (7, "1998-06-02 00:00:00", "1998-06-01")
B6 = (6, "1998-05-02 00:00:00", "1998-05-01")


# The tables a daily summary reads.
WH = {"orders": "wh_orders", "orderdetails": "wh_orderdetails", "products": "dw_products", "customers": "dw_customers",
      "payments": "wh_payments"}


def _tagged(tables: dict[str, str], d: str, cancelled: str) -> str:
    """Every line with the days it counts for, if from ``d`` on: ordered, cancelled, shipped."""
    return (f"SELECT l.dw_order_id, l.dw_product_id, l.quantityordered, l.priceeach * l.quantityordered AS paid, "
            f"a.msrp * l.quantityordered AS listed, a.dw_product_id IS NOT NULL AS known, h.dw_customer_id, "
            f"CASE WHEN CAST(h.orderdate AS DATE) >= DATE '{d}' THEN CAST(h.orderdate AS DATE) END AS ordered_on, "
            f"CASE WHEN CAST(h.cancelleddate AS DATE) >= DATE '{d}' AND {cancelled} THEN CAST(h.cancelleddate AS DATE) END AS cancelled_on, "
            f"CASE WHEN CAST(h.shippeddate AS DATE) >= DATE '{d}' AND h.status = 'Shipped' THEN CAST(h.shippeddate AS DATE) END AS shipped_on "
            f"FROM {tables['orderdetails']} l JOIN {tables['orders']} h USING (dw_order_id) "
            f"LEFT JOIN {tables['products']} a ON a.dw_product_id = l.dw_product_id")


def customer_blocks(d: str, tables: dict[str, str] = WH) -> dict[str, str]:
    layout = DAILY_CUSTOMER_COLUMNS
    tagged = _tagged(tables, d, "h.status = 'Cancelled'")

    def lines(day: str, only: str, **values: str) -> str:
        row = pad_sql(layout, {"summary_date": day, "dw_customer_id": "dw_customer_id", **values})
        return f"SELECT {row} FROM ({tagged}) AS t WHERE {day} IS NOT NULL AND {only} GROUP BY {day}, dw_customer_id"

    new = pad_sql(layout, {"summary_date": "CAST(src_create_timestamp AS DATE)", "dw_customer_id": "dw_customer_id",
                           "new_customer_apd": "1"})
    paid = pad_sql(layout, {"summary_date": "CAST(paymentdate AS DATE)", "dw_customer_id": "dw_customer_id", "payment_apd": "1",
                            "payment_amount": "SUM(amount)", "new_customer_paid_apd": "1"})
    return {
        "orders": lines("ordered_on", "known", order_count="COUNT(DISTINCT dw_order_id)", order_apd="1", order_cost_amount="SUM(paid)",
                        products_ordered_qty="COUNT(DISTINCT dw_product_id)", products_items_qty="COUNT(quantityordered)",
                        order_mrp_amount="SUM(listed)"),
        "new": f"SELECT {new} FROM {tables['customers']} WHERE CAST(src_create_timestamp AS DATE) >= DATE '{d}'",
        "cancelled": lines("cancelled_on", "true", cancelled_order_count="COUNT(dw_order_id)", cancelled_order_amount="SUM(paid)",
                           cancelled_order_apd="1"),
        "payments": f"SELECT {paid} FROM {tables['payments']} WHERE CAST(paymentdate AS DATE) >= DATE '{d}' "
                    f"GROUP BY CAST(paymentdate AS DATE), dw_customer_id",
        "shipped": lines("shipped_on", "true", shipped_order_count="COUNT(dw_order_id)", shipped_order_amount="SUM(paid)",
                         shipped_order_apd="1")}


def daily_customer_final(d: str, stamp, tables: dict[str, str] = WH) -> str:
    blocks = "\nUNION ALL\n".join(customer_blocks(d, tables).values())
    layout = DAILY_CUSTOMER_COLUMNS
    aggs = {n: (f"MAX({n})" if n in CUSTOMER_FLAGS else f"SUM({n})") for n, _ in layout[2:]}
    aggs.update(summary_date="summary_date", dw_customer_id="dw_customer_id")
    return (f"SELECT {pad_sql(layout, aggs)}, {batch_stamp(*stamp)} FROM (\n{blocks}\n) AS blocks "
            f"GROUP BY summary_date, dw_customer_id")


def product_blocks(d: str, tables: dict[str, str] = WH) -> dict[str, str]:
    layout = DAILY_PRODUCT_COLUMNS
    tagged = _tagged(tables, d, "lower(trim(h.status)) = 'cancelled'")

    def lines(day: str, **values: str) -> str:
        row = pad_sql(layout, {"summary_date": day, "dw_product_id": "dw_product_id", **values})
        return f"SELECT {row} FROM ({tagged}) AS t WHERE {day} IS NOT NULL AND known GROUP BY {day}, dw_product_id"

    return {"orders": lines("ordered_on", customer_apd="COUNT(DISTINCT dw_customer_id)", product_cost_amount="SUM(paid)",
                            product_mrp_amount="SUM(listed)"),
            "cancelled": lines("cancelled_on", cancelled_product_qty="SUM(quantityordered)", cancelled_cost_amount="SUM(paid)",
                               cancelled_mrp_amount="SUM(listed)", cancelled_order_apd="COUNT(DISTINCT dw_order_id)")}


def daily_product_final(d: str, stamp, tables: dict[str, str] = WH) -> str:
    blocks = "\nUNION ALL\n".join(product_blocks(d, tables).values())
    layout = DAILY_PRODUCT_COLUMNS
    aggs = {n: f"SUM({n})" for n, _ in layout[2:]}
    aggs.update(summary_date="summary_date", dw_product_id="dw_product_id")
    return (f"SELECT {pad_sql(layout, aggs)}, {batch_stamp(*stamp)} FROM (\n{blocks}\n) AS blocks "
            f"GROUP BY summary_date, dw_product_id")


CTES.add("daily_customer_b7", daily_customer_final("1998-06-01", B7))
CTES.add("daily_customer_b6", daily_customer_final("1998-05-01", B6))
CTES.add("daily_product_b7", daily_product_final("1998-06-01", B7))
CTES.add("daily_product_b6", daily_product_final("1998-05-01", B6))
CTES.add("daily_customer_hist",
         "SELECT * FROM daily_customer_b6 WHERE summary_date < DATE '1998-06-15' "
         "UNION ALL SELECT * FROM daily_customer_b7")
CTES.add("daily_product_hist",
         "SELECT * FROM daily_product_b6 WHERE summary_date < DATE '1998-06-15' "
         "UNION ALL SELECT * FROM daily_product_b7")


def monthly_customer_delta(src: str, d: str) -> str:
    L = MONTHLY_CUSTOMER_COLUMNS
    vals = {"start_of_the_month_date": "CAST(date_trunc('month', summary_date) AS DATE)",
            "dw_customer_id": "dw_customer_id", "order_apm": "COUNT(DISTINCT summary_date)"}
    conds = {"cancelled_order_apm": "cancelled_order_count", "shipped_order_apm": "shipped_order_count",
             "payment_apm": "payment_amount", "new_customer_apm": "new_customer_apd",
             "new_customer_paid_apm": "new_customer_paid_apd"}
    for n, _ in L[2:]:
        if n in conds:
            vals[n] = f"COUNT(DISTINCT CASE WHEN {conds[n]} > 0 THEN summary_date END)"
        elif n not in vals:
            vals[n] = f"SUM({n})"
    return (f"SELECT {pad_sql(L, vals)} FROM {src} WHERE etl_batch_date >= DATE '{d}' "
            f"GROUP BY date_trunc('month', summary_date), dw_customer_id")


def monthly_product_delta(src: str, d: str) -> str:
    L = MONTHLY_PRODUCT_COLUMNS
    vals = {"start_of_the_month_date": "CAST(date_trunc('month', summary_date) AS DATE)",
            "dw_product_id": "dw_product_id", "customer_apd": "MAX(customer_apd)",
            "customer_apm": "1", "cancelled_order_apd": "MAX(cancelled_order_apd)",
            "cancelled_order_apm": "SUM(cancelled_order_apd)"}
    for n, _ in L[2:]:
        vals.setdefault(n, f"SUM({n})")
    return (f"SELECT {pad_sql(L, vals)} FROM {src} WHERE etl_batch_date >= DATE '{d}' "
            f"GROUP BY date_trunc('month', summary_date), dw_product_id")


CTES.add("monthly_customer_delta_b7", monthly_customer_delta("daily_customer_hist", "1998-06-01"))
CTES.add("monthly_product_delta_b7", monthly_product_delta("daily_product_hist", "1998-06-01"))
CTES.add("monthly_customer_prior",
         f"SELECT *, {batch_stamp(*B6)} FROM ("
         + monthly_customer_delta("(SELECT * FROM daily_customer_b6 WHERE summary_date < DATE '1998-06-15')",
                                  "1998-05-01") + ") AS m")
CTES.add("monthly_product_prior",
         f"SELECT *, {batch_stamp(*B6)} FROM ("
         + monthly_product_delta("(SELECT * FROM daily_product_b6 WHERE summary_date < DATE '1998-06-15')",
                                 "1998-05-01") + ") AS m")


def merge_sql(prior: str, delta: str, id_col: str, layout, stamp) -> str:
    measures = [n for n, _ in layout[2:]]
    key = ("start_of_the_month_date", id_col)
    on = " AND ".join(f"m.{k} = t.{k}" for k in key)
    upd = ", ".join(f"CASE WHEN t.{id_col} IS NOT NULL THEN m.{n} + t.{n} ELSE m.{n} END AS {n}"
                    for n in measures)
    no, ts, d = stamp
    updated = (f"SELECT m.start_of_the_month_date, m.{id_col}, {upd}, m.dw_create_timestamp, "
               f"CASE WHEN t.{id_col} IS NOT NULL THEN TIMESTAMP '{ts}' ELSE m.dw_update_timestamp END "
               f"AS dw_update_timestamp, "
               f"CASE WHEN t.{id_col} IS NOT NULL THEN {no} ELSE m.etl_batch_no END AS etl_batch_no, "
               f"CASE WHEN t.{id_col} IS NOT NULL THEN DATE '{d}' ELSE m.etl_batch_date END "
               f"AS etl_batch_date "
               f"FROM {prior} m LEFT JOIN {delta} t ON {on}")
    inserted = (f"SELECT t.*, {batch_stamp(*stamp)} FROM {delta} t "
                f"WHERE NOT EXISTS (SELECT 1 FROM {prior} m WHERE {on})")
    typed = pad_sql(layout, {n: n for n, _ in layout})
    return (f"SELECT {typed}, CAST(dw_create_timestamp AS TIMESTAMP) AS dw_create_timestamp, "
            f"CAST(dw_update_timestamp AS TIMESTAMP) AS dw_update_timestamp, "
            f"CAST(etl_batch_no AS INTEGER) AS etl_batch_no, etl_batch_date "
            f"FROM ({updated} UNION ALL {inserted}) AS merged")


# Fixed values, stated on their own: day-count column and the daily measure that makes a day active.
ACTIVE = {"customer": {"order_apm": "1", "cancelled_order_apm": "cancelled_order_count", "shipped_order_apm": "shipped_order_count",
                       "payment_apm": "payment_amount", "new_customer_apm": "new_customer_apd",
                       "new_customer_paid_apm": "new_customer_paid_apd"},
          "product": {"customer_apm": "1", "cancelled_order_apm": "cancelled_order_apd"}}


def merge_days_sql(subject: str, merged: str, layout) -> str:
    """The merged month with every active day counted once, straight from the daily rows of both batches."""
    id_col = f"dw_{subject}_id"
    rows = (f"SELECT * FROM daily_{subject}_b6 WHERE summary_date < DATE '1998-06-15' AND etl_batch_date >= DATE '1998-05-01' "
            f"UNION ALL SELECT * FROM daily_{subject}_hist WHERE etl_batch_date >= DATE '1998-06-01'")
    days = ", ".join(f"COUNT(DISTINCT CASE WHEN {m} > 0 THEN summary_date END) AS {c}" for c, m in ACTIVE[subject].items())
    counted = (f"SELECT CAST(date_trunc('month', summary_date) AS DATE) AS month, {id_col}, {days} FROM ({rows}) AS r GROUP BY 1, 2")
    cols = ", ".join(f"coalesce(c.{n}, g.{n}) AS {n}" if n in ACTIVE[subject] else f"g.{n}" for n, _ in layout)
    return (f"SELECT {cols}, g.dw_create_timestamp, g.dw_update_timestamp, g.etl_batch_no, g.etl_batch_date FROM ({merged}) AS g "
            f"LEFT JOIN ({counted}) AS c ON c.month = g.start_of_the_month_date AND c.{id_col} = g.{id_col}")


def queries() -> dict[str, str]:
    q = {}
    for name, sql in customer_blocks("1998-06-01").items():
        q[f"daily_customer_{name}"] = sql
    q["daily_customer_summary"] = "SELECT * FROM daily_customer_b7"
    for name, sql in product_blocks("1998-06-01").items():
        q[f"daily_product_{name}"] = sql
    q["daily_product_summary"] = "SELECT * FROM daily_product_b7"
    q["monthly_customer_delta"] = "SELECT * FROM monthly_customer_delta_b7"
    q["monthly_product_delta"] = "SELECT * FROM monthly_product_delta_b7"
    q["monthly_customer_merge"] = merge_sql("monthly_customer_prior", "monthly_customer_delta_b7",
                                            "dw_customer_id", MONTHLY_CUSTOMER_COLUMNS, B7)
    q["monthly_product_merge"] = merge_sql("monthly_product_prior", "monthly_product_delta_b7",
                                           "dw_product_id", MONTHLY_PRODUCT_COLUMNS, B7)
    q["monthly_customer_merge_days"] = merge_days_sql("customer", q["monthly_customer_merge"], MONTHLY_CUSTOMER_COLUMNS)
    q["monthly_product_merge_days"] = merge_days_sql("product", q["monthly_product_merge"], MONTHLY_PRODUCT_COLUMNS)
    return {k: CTES.build(v) for k, v in q.items()}
