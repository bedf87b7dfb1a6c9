"""Oracle SQL for upserts, lookups and surrogate keys, generated from the table registry."""

from __future__ import annotations

from warehaus.oracle.base import sql_type
from warehaus.oracle.fixtures_sql import CTES
from warehaus.schemas import LOAD_ORDER, TABLES, TableSpec

# (number, date, run timestamp)
B7 = (7, "1998-06-01", "1998-06-02 00:00:00")
# Fixed values, stated here on their own: the columns an update of an existing row sets.
UPDATED = {
    "offices": "city phone addressline1 addressline2 state country postalcode territory",
    "employees": "lastname firstname extension email officecode reportsto jobtitle",
    "productlines": "textdescription htmldescription image",
    "products": "productname productline productscale productvendor productdescription quantityinstock buyprice msrp "
                "dw_product_line_id",
    "customers": "customername contactlastname contactfirstname phone addressline1 addressline2 city state postalcode "
                 "country salesrepemployeenumber creditlimit",
    "orders": "dw_customer_id orderdate requireddate shippeddate status comments cancelleddate src_customernumber",
    "orderdetails": "quantityordered priceeach orderlinenumber",
    "payments": "paymentdate amount",
}
LOOKUP_SOURCE = {"productlines": "dw_productlines", "customers": "dw_customers",
                 "orders": "dw_orders", "products": "dw_products"}


def prepared_sql(spec: TableSpec, sources: dict[str, str] | None = None,
                 stage: str | None = None) -> str:
    sources = sources or LOOKUP_SOURCE
    renamed = ", ".join(f"{c} AS {spec.dw_name(c)}" for c in spec.stage.names)
    sql = f"SELECT {renamed} FROM {stage or 'stg_' + spec.name}"
    for i, lk in enumerate(spec.lookups):
        sql = (f"SELECT b.*, l{i}.{lk.dim_id} AS {lk.target} FROM ({sql}) AS b "
               f"LEFT JOIN {sources[lk.dimension]} AS l{i} ON b.{lk.stage_col} = l{i}.{lk.dim_col}")
    return sql


def _typed(spec: TableSpec, exprs: dict[str, str]) -> str:
    return ", ".join(f"CAST({exprs.get(f.name, 'NULL')} AS {sql_type(f.dataType)}) AS {f.name}"
                     for f in spec.dw_schema.fields)


def insert_sql(spec: TableSpec, prep: str | None = None, base: str | None = None, batch=B7) -> str:
    prep, base = prep or f"prep_{spec.name}", base or f"dw_{spec.name}"
    no, day, run = batch
    on = " AND ".join(f"d.{k} = p.{k}" for k in spec.dw_key)
    exprs = {c: f"p.{c}" for c in spec.dw_columns if c not in ("dw_create_timestamp",)}
    exprs.update(dw_create_timestamp=f"TIMESTAMP '{run}'", dw_update_timestamp=f"TIMESTAMP '{run}'",
                 etl_batch_no=str(no), etl_batch_date=f"DATE '{day}'")
    for ph in spec.placeholders:
        exprs[ph] = "NULL"
    if spec.surrogate:
        order = ", ".join(f"p.{k} NULLS FIRST" for k in spec.dw_key)
        exprs[spec.surrogate] = (f"(SELECT coalesce(max({spec.surrogate}), 0) FROM {base}) "
                                 f"+ row_number() OVER (ORDER BY {order})")
    return (f"SELECT {_typed(spec, exprs)} FROM {prep} AS p "
            f"WHERE NOT EXISTS (SELECT 1 FROM {base} AS d WHERE {on})")


def update_sql(spec: TableSpec, only_changed: bool, prep: str | None = None, base: str | None = None, batch=B7) -> str:
    prep, base = prep or f"prep_{spec.name}", base or f"dw_{spec.name}"
    no, day, run = batch
    on = " AND ".join(f"d.{k} = p.{k}" for k in spec.dw_key)
    newer = "(p.hit_flag = 1 AND d.src_update_timestamp < p.src_update_timestamp)"
    exprs = {c: f"d.{c}" for c in spec.dw_columns}
    for c in (*UPDATED[spec.name].split(), "src_update_timestamp"):
        exprs[c] = f"CASE WHEN {newer} THEN p.{c} ELSE d.{c} END"
    exprs.update(
        dw_update_timestamp=f"CASE WHEN {newer} THEN TIMESTAMP '{run}' ELSE d.dw_update_timestamp END",
        etl_batch_no=f"CASE WHEN {newer} THEN {no} ELSE d.etl_batch_no END",
        etl_batch_date=f"CASE WHEN {newer} THEN DATE '{day}' ELSE d.etl_batch_date END")
    sql = (f"SELECT {_typed(spec, exprs)} FROM {base} AS d "
           f"LEFT JOIN (SELECT *, 1 AS hit_flag FROM {prep}) AS p ON {on}")
    if only_changed:
        sql += f" WHERE {newer}"
    return sql


def employees_fk_sql(src: str, offices: str = "dw_offices") -> str:
    spec = TABLES["employees"]
    cols = {c: f"e.{c}" for c in spec.dw_columns}
    cols["dw_reporting_employee_id"] = ("CASE WHEN m.employeenumber IS NOT NULL THEN m.dw_employee_id "
                                        "ELSE e.dw_reporting_employee_id END")
    with_mgr = (f"SELECT {_typed(spec, cols)} FROM {src} AS e "
                f"LEFT JOIN {src} AS m ON e.reportsto = m.employeenumber")
    cols2 = {c: f"e.{c}" for c in spec.dw_columns}
    cols2["dw_office_id"] = ("CASE WHEN e.dw_office_id IS NULL AND o.officecode IS NOT NULL "
                             "THEN o.dw_office_id ELSE e.dw_office_id END")
    return (f"SELECT {_typed(spec, cols2)} FROM ({with_mgr}) AS e "
            f"LEFT JOIN {offices} AS o ON e.officecode = o.officecode")


for _t in LOAD_ORDER:
    CTES.add(f"prep_{_t}", prepared_sql(TABLES[_t]))
CTES.add("upserted_employees", f"{update_sql(TABLES['employees'], False)} "
                               f"UNION ALL {insert_sql(TABLES['employees'])}")


def queries() -> dict[str, str]:
    q = {}
    for t in LOAD_ORDER:
        spec = TABLES[t]
        q[f"insert_new_{t}"] = insert_sql(spec)
        q[f"update_newer_{t}"] = update_sql(spec, True)
        q[f"upsert_{t}"] = f"{update_sql(spec, False)} UNION ALL {insert_sql(spec)}"
    for t in ("orders", "orderdetails"):
        q[f"upsert_{t}_bucketed"] = q[f"upsert_{t}"]
    q["upsert_employees"] = employees_fk_sql("upserted_employees")
    filled = {c: f"b.{c}" for c in TABLES["orderdetails"].dw_columns}
    filled["dw_order_id"] = "coalesce(b.dw_order_id, o.dw_order_id)"
    filled["dw_product_id"] = "coalesce(b.dw_product_id, p.dw_product_id)"
    q["fk_repair_orderdetails"] = (
        f"SELECT {_typed(TABLES['orderdetails'], filled)} FROM ({insert_sql(TABLES['orderdetails'])}) AS b "
        f"LEFT JOIN ({insert_sql(TABLES['orders'])}) AS o ON o.src_ordernumber = b.src_ordernumber "
        f"LEFT JOIN ({insert_sql(TABLES['products'])}) AS p ON p.src_productcode = b.src_productcode")
    for t in ("products", "orders", "orderdetails", "payments"):
        q[f"fk_{t}"] = f"SELECT * FROM prep_{t}"
    spec = TABLES["employees"]
    manager_only = {c: f"e.{c}" for c in spec.dw_columns}
    manager_only["dw_reporting_employee_id"] = (
        "CASE WHEN m.employeenumber IS NOT NULL THEN m.dw_employee_id ELSE e.dw_reporting_employee_id END")
    q["fk_employees_manager"] = (f"SELECT {_typed(spec, manager_only)} FROM dw_employees AS e "
                                 f"LEFT JOIN dw_employees AS m ON e.reportsto = m.employeenumber")
    office_only = {c: f"e.{c}" for c in spec.dw_columns}
    office_only["dw_office_id"] = ("CASE WHEN e.dw_office_id IS NULL AND o.officecode IS NOT NULL "
                                   "THEN o.dw_office_id ELSE e.dw_office_id END")
    q["fk_employees_office"] = (f"SELECT {_typed(spec, office_only)} FROM dw_employees AS e "
                                f"LEFT JOIN dw_offices AS o ON e.officecode = o.officecode")
    q["surrogate_keys"] = ("SELECT CAST(row_number() OVER (ORDER BY ordernumber) AS BIGINT) AS dw_order_id, "
                           "ordernumber, customernumber, orderdate FROM stg_orders")
    return {k: CTES.build(v) for k, v in q.items()}
