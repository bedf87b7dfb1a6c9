"""Oracle SQL for the SCD-2 histories."""

from __future__ import annotations

from warehaus.oracle.base import sql_type
from warehaus.oracle.fixtures_sql import CTES
from warehaus.schemas import history_schema

# (number, date, run timestamp)
B7 = (7, "1998-06-01", "1998-06-02 00:00:00")


def _typed(id_col: str, tracked: str, exprs: dict[str, str]) -> str:
    return ", ".join(f"CAST({exprs.get(f.name, 'NULL')} AS {sql_type(f.dataType)}) AS {f.name}"
                     for f in history_schema(id_col, tracked).fields)


def close_sql(hist: str, dim: str, id_col: str, tracked: str, batch=B7) -> str:
    no, day, run = batch
    changed = (f"(h.dw_active_record_ind = 1 AND d.{id_col} IS NOT NULL "
               f"AND h.{tracked} <> d.{tracked})")
    cols = {f.name: f"h.{f.name}" for f in history_schema(id_col, tracked).fields}
    cols.update(
        effective_to_date=f"CASE WHEN {changed} THEN DATE '{day}' - 1 ELSE h.effective_to_date END",
        dw_active_record_ind=f"CASE WHEN {changed} THEN 0 ELSE h.dw_active_record_ind END",
        dw_update_timestamp=f"CASE WHEN {changed} THEN TIMESTAMP '{run}' ELSE h.dw_update_timestamp END",
        update_etl_batch_no=f"CASE WHEN {changed} THEN {no} ELSE h.update_etl_batch_no END",
        update_etl_batch_date=f"CASE WHEN {changed} THEN DATE '{day}' ELSE h.update_etl_batch_date END")
    return (f"SELECT {_typed(id_col, tracked, cols)} FROM {hist} AS h "
            f"LEFT JOIN {dim} AS d ON h.{id_col} = d.{id_col}")


def open_sql(closed: str, dim: str, id_col: str, tracked: str, batch=B7) -> str:
    """Insert step as written for a warehouse that has already run the close step."""
    no, day, run = batch
    cols = {id_col: f"d.{id_col}", tracked: f"d.{tracked}", "effective_from_date": f"DATE '{day}'",
            "dw_active_record_ind": "1", "dw_create_timestamp": f"TIMESTAMP '{run}'",
            "dw_update_timestamp": f"TIMESTAMP '{run}'", "create_etl_batch_no": str(no),
            "create_etl_batch_date": f"DATE '{day}'"}
    return (f"SELECT {_typed(id_col, tracked, cols)} FROM {dim} AS d "
            f"LEFT JOIN (SELECT {id_col}, {tracked} FROM {closed} WHERE dw_active_record_ind = 1) AS h "
            f"ON d.{id_col} = h.{id_col} "
            f"WHERE h.{id_col} IS NULL OR h.{tracked} <> d.{tracked}")


SUBJECTS = {"product": ("dw_product_history", "dw_products", "dw_product_id", "msrp"),
            "customer": ("dw_customer_history", "dw_customers", "dw_customer_id", "creditlimit")}

for _s, (_h, _d, _i, _t) in SUBJECTS.items():
    CTES.add(f"closed_{_s}_history", close_sql(_h, _d, _i, _t))


def queries() -> dict[str, str]:
    q = {}
    for s, (h, d, i, t) in SUBJECTS.items():
        q[f"scd2_close_{s}"] = f"SELECT * FROM closed_{s}_history"
        q[f"scd2_open_{s}"] = open_sql(f"closed_{s}_history", d, i, t)
        q[f"scd2_{s}"] = (f"SELECT * FROM closed_{s}_history UNION ALL "
                          + open_sql(f"closed_{s}_history", d, i, t))
    return {k: CTES.build(v) for k, v in q.items()}
