"""Oracle SQL of the two-batch run: both snapshots, and every table after each batch.

Chains the single-step formulations: a batch's tables start from its landed
and stage-loaded snapshot and from the tables of the batch before, and look up
the dimensions as they stand after their own load in the same batch.
"""

from __future__ import annotations

from pyspark.sql.types import DateType, TimestampNTZType

from warehaus.oracle.base import sql_type
from warehaus.oracle.fixtures_sql import CTES
from warehaus.oracle.history_sql import close_sql, open_sql
from warehaus.oracle.ingest_sql import stage_load_sql
from warehaus.oracle.summary_sql import (MONTHLY_CUSTOMER_COLUMNS, MONTHLY_PRODUCT_COLUMNS, batch_stamp, daily_customer_final,
                                         daily_product_final, merge_sql, monthly_customer_delta, monthly_product_delta)
from warehaus.oracle.upsert_sql import employees_fk_sql, insert_sql, prepared_sql, update_sql
from warehaus.operators.summary import AUDIT_COLUMNS, DAILY_CUSTOMER_COLUMNS, DAILY_PRODUCT_COLUMNS
from warehaus.schemas import HISTORIES, LOAD_ORDER, TABLES, history_schema

# (number, date, run timestamp); 2566 days lie between 1998-06-01 and 2005-06-10.
BATCHES = ((7, "2005-06-10", "2005-06-11 00:00:00"), (8, "2005-06-11", "2005-06-12 00:00:00"))
SHIFT = 2566

NUMBER = {"offices": "cast(officecode as bigint)", "employees": "employeenumber", "productlines": "cast(length(productline) as bigint)",
          "products": "cast(productcode as bigint)", "customers": "customernumber", "orders": "ordernumber",
          "orderdetails": "ordernumber + cast(productcode as bigint)", "payments": "cast(substr(checknumber, 4) as bigint)"}
CHANGED = {"offices": {"phone": "'+2-' || officecode"}, "employees": {"jobtitle": "'Lead'"},
           "productlines": {"textdescription": "'Only ' || productline"}, "products": {"msrp": "msrp + 7"},
           "customers": {"creditlimit": "creditlimit + 250"},
           "orders": {"status": "'Shipped'", "shippeddate": "date '2005-06-12'", "cancelleddate": "null"},
           "orderdetails": {"priceeach": "priceeach + 1"}, "payments": {"amount": "amount + 3"}}


def _moved(source: str, schema) -> str:
    def one(f):
        if isinstance(f.dataType, DateType):
            return f"{f.name} + {SHIFT} as {f.name}"
        if isinstance(f.dataType, TimestampNTZType):
            return f"{f.name} + interval {SHIFT} day as {f.name}"
        return f.name
    return f"select {', '.join(map(one, schema.fields))} from {source}"


def _snapshots(t: str) -> None:
    spec = TABLES[t]
    names = spec.stage.names
    CTES.add(f"moved_{t}", f"select *, {NUMBER[t]} as n from ({_moved('stg_' + t, spec.stage)}) as m")
    cols = ", ".join(names)
    keyless = ", ".join(f"cast(null as {sql_type(spec.stage[c].dataType)}) as {c}" if c == spec.key[0] else c for c in names)
    order = ", ".join([*spec.key, "create_timestamp", "n"])
    nobody = f"(select {keyless} from moved_{t} where n % 13 = 0 order by {order} limit 1)"
    older = ", ".join("update_timestamp - interval 1 day as update_timestamp" if c == "update_timestamp" else c for c in names)
    CTES.add(f"snap7_{t}", f"select {cols} from moved_{t} where n % 17 <> 3 union all "
                           f"select {older} from moved_{t} where n % 17 <> 3 and n % 11 = 0 union all select * from {nobody}")
    new = {**CHANGED[t], "update_timestamp": "timestamp '2005-06-11 06:00:00'"}
    second = ", ".join(f"cast(case when n % 4 = 1 then {new[c]} else {c} end as {sql_type(spec.stage[c].dataType)}) as {c}"
                       if c in new else c for c in names)
    CTES.add(f"snap8_{t}", f"select {second} from moved_{t} union all select * from {nobody}")


def _chain() -> None:
    for t in LOAD_ORDER:
        _snapshots(t)
        CTES.add(f"after6_{t}", _moved(f"dw_{t}", TABLES[t].dw_schema))
    histories = {"product_history": ("products", "dw_product_id", "msrp"), "customer_history": ("customers", "dw_customer_id", "creditlimit")}
    for h, (_, id_col, tracked) in histories.items():
        CTES.add(f"after6_{h}", _moved(f"dw_{h}", history_schema(id_col, tracked)))
    for batch in BATCHES:
        b, day, run = batch
        after = {t: f"after{b}_{t}" for t in LOAD_ORDER}
        for t in LOAD_ORDER:
            spec = TABLES[t]
            CTES.add(f"staged{b}_{t}", stage_load_sql(t, f"snap{b}_{t}"))
            missing = " or ".join(f"{k} is null" for k in spec.key)
            CTES.add(f"latest{b}_{t}", f"select * from staged{b}_{t} where {missing} union all "
                     f"select * exclude (place) from (select *, row_number() over (partition by {', '.join(spec.key)} "
                     f"order by update_timestamp desc) as place from staged{b}_{t} where not ({missing})) as r where place = 1")
            CTES.add(f"prep{b}_{t}", prepared_sql(spec, after, stage=f"latest{b}_{t}"))
            body = (f"{update_sql(spec, False, f'prep{b}_{t}', f'after{b - 1}_{t}', batch)} UNION ALL "
                    f"{insert_sql(spec, f'prep{b}_{t}', f'after{b - 1}_{t}', batch)}")
            if t == "employees":
                CTES.add(f"raw{b}_employees", body)
                body = employees_fk_sql(f"raw{b}_employees", offices=after["offices"])
            CTES.add(after[t], body)
        for h, (dim, id_col, tracked) in histories.items():
            CTES.add(f"closed{b}_{h}", close_sql(f"after{b - 1}_{h}", after[dim], id_col, tracked, batch))
            CTES.add(f"after{b}_{h}", f"select * from closed{b}_{h} UNION ALL "
                     + open_sql(f"closed{b}_{h}", after[dim], id_col, tracked, batch))
        stamp = (b, run, day)
        CTES.add(f"customer_days{b}", daily_customer_final(day, stamp, after))
        CTES.add(f"product_days{b}", daily_product_final(day, stamp, after))
        CTES.add(f"customer_delta{b}", monthly_customer_delta(f"customer_days{b}", day))
        CTES.add(f"product_delta{b}", monthly_product_delta(f"product_days{b}", day))
    first = BATCHES[0]
    for kind, id_col, layout in (("customer", "dw_customer_id", MONTHLY_CUSTOMER_COLUMNS), ("product", "dw_product_id", MONTHLY_PRODUCT_COLUMNS)):
        CTES.add(f"{kind}_months7", f"select *, {batch_stamp(first[0], first[2], first[1])} from {kind}_delta7")
        b, day, run = BATCHES[1]
        CTES.add(f"{kind}_months8", merge_sql(f"{kind}_months7", f"{kind}_delta8", id_col, layout, (b, run, day)))


_chain()


SUMMARIES = {"daily_customer_summary": DAILY_CUSTOMER_COLUMNS, "daily_product_summary": DAILY_PRODUCT_COLUMNS,
             "monthly_customer_summary": MONTHLY_CUSTOMER_COLUMNS, "monthly_product_summary": MONTHLY_PRODUCT_COLUMNS}


def _columns(t: str) -> list[tuple[str, bool]]:
    """(name, whether it is a timestamp) of a table's columns."""
    if t in SUMMARIES:
        return [(n, kind == "timestamp_ntz") for n, kind in (*SUMMARIES[t], *AUDIT_COLUMNS)]
    schema = history_schema(*HISTORIES[t][1:]) if t in HISTORIES else TABLES[t].dw_schema
    return [(f.name, isinstance(f.dataType, TimestampNTZType)) for f in schema.fields]


def _row_text(t: str) -> str:
    def one(name: str, is_time: bool) -> str:
        return f"coalesce({f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')" if is_time else f'cast({name} as varchar)'}, '~')"
    return "concat_ws('|', " + ", ".join(one(*c) for c in _columns(t)) + ")"


def _changes(t: str) -> str:
    spec = TABLES[t]
    key = ", ".join(f"coalesce(cast({k} as varchar), '-')" for k in spec.key)
    there = " and ".join(f"b.{c} is not distinct from s.{c}" for c in spec.stage.names)
    return (f"SELECT '{t}' AS table_name, concat_ws('/', {key}) AS row_key, update_timestamp FROM snap8_{t} AS s "
            f"WHERE {' or '.join(f'{k} is null' for k in spec.key)} or not exists (select 1 from snap7_{t} AS b where {there})")


def queries() -> dict[str, str]:
    q = {f"etl_two_batches_{t}": f"SELECT * FROM after8_{t}" for t in (*LOAD_ORDER, "product_history", "customer_history")}
    for kind in ("customer", "product"):
        q[f"etl_two_batches_daily_{kind}_summary"] = f"SELECT * FROM {kind}_days7 UNION ALL SELECT * FROM {kind}_days8"
        q[f"etl_two_batches_monthly_{kind}_summary"] = f"SELECT * FROM {kind}_months8"
    q["etl_two_batches"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
        f"cast(coalesce(sum(cast('0x' || substr(md5({_row_text(t)}), 1, 8) AS bigint)), 0) AS bigint) AS digest "
        f"FROM ({q[f'etl_two_batches_{t}']}) AS r" for t in (
            *LOAD_ORDER, "product_history", "customer_history", "daily_customer_summary", "daily_product_summary",
            "monthly_customer_summary", "monthly_product_summary"))
    q["snapshot_changes"] = " UNION ALL ".join(_changes(t) for t in LOAD_ORDER)
    q["snapshot_rows"] = " UNION ALL ".join(
        f"SELECT '{day}' AS batch_date, '{t}' AS table_name, count(*) AS n_rows FROM snap{b}_{t}"
        for b, day, _ in BATCHES for t in LOAD_ORDER)
    return {k: CTES.build(v, materialized=True) for k, v in q.items()}
