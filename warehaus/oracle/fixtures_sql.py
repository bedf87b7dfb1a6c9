"""The fixture scenario as SQL over the given tables (see FIXTURES.md)."""

from __future__ import annotations

from warehaus.oracle.base import CteSet, conform_sql
from warehaus.schemas import TABLES, history_schema

CTES = CteSet()


def _stage(name: str, inner: str, cols: str) -> None:
    CTES.add(f"stg_{name}", conform_sql(inner, TABLES[name].stage, set(cols.split())))


def _dw(name: str, inner: str, cols: str, cte: str | None = None) -> None:
    CTES.add(cte or f"dw_{name}", conform_sql(inner, TABLES[name].dw_schema, set(cols.split())))


_stage("offices", """
select cast(n_nationkey as varchar) as officecode, n_name as city,
  case when n_nationkey % 3 = 0 then concat('+1-', cast(n_nationkey as varchar)) end as phone,
  r_name as territory, timestamp '1997-01-01 00:00:00' as create_timestamp,
  case when n_nationkey % 3 = 0 then timestamp '1998-05-30 00:00:00'
       else timestamp '1997-01-01 00:00:00' end as update_timestamp
from nation join region on n_regionkey = r_regionkey""",
       "officecode city phone territory create_timestamp update_timestamp")

_dw("offices", """
select n_nationkey + 1 as dw_office_id, cast(n_nationkey as varchar) as officecode, n_name as city,
  r_name as territory, timestamp '1997-01-01 00:00:00' as src_create_timestamp,
  timestamp '1997-01-01 00:00:00' as src_update_timestamp
from nation join region on n_regionkey = r_regionkey where n_nationkey % 10 <> 9""",
    "dw_office_id officecode city territory src_create_timestamp src_update_timestamp")

_stage("employees", """
select s_suppkey as employeenumber, s_name as lastname, cast(s_nationkey as varchar) as officecode,
  case when s_suppkey >= 10 then cast(floor(s_suppkey / 10) as bigint) end as reportsto,
  case when s_suppkey % 3 = 0 then 'Sales Manager' else 'Sales Rep' end as jobtitle,
  timestamp '1997-01-01 00:00:00' as create_timestamp,
  case when s_suppkey % 3 = 0 then timestamp '1998-05-30 00:00:00'
       else timestamp '1997-01-01 00:00:00' end as update_timestamp
from supplier""", "employeenumber lastname officecode reportsto jobtitle create_timestamp update_timestamp")

_dw("employees", """
select employeenumber + 1 as dw_employee_id, employeenumber, lastname, officecode, reportsto,
  'Sales Rep' as jobtitle, case when employeenumber % 4 = 0 then cast(1 as bigint) end as dw_office_id,
  create_timestamp as src_create_timestamp, create_timestamp as src_update_timestamp
from stg_employees where employeenumber % 10 <> 9""",
    "dw_employee_id employeenumber lastname officecode reportsto jobtitle dw_office_id "
    "src_create_timestamp src_update_timestamp")

_stage("productlines", """
select p_type as productline, concat('All ', p_type) as textdescription,
  timestamp '1997-01-01 00:00:00' as create_timestamp, timestamp '1998-05-30 00:00:00' as update_timestamp
from part group by p_type""", "productline textdescription create_timestamp update_timestamp")

_dw("productlines", """
select row_number() over (order by productline) as dw_product_line_id, productline,
  'old text' as textdescription, create_timestamp as src_create_timestamp,
  create_timestamp as src_update_timestamp
from stg_productlines where productline <> (select max(p_type) from part)""",
    "dw_product_line_id productline textdescription src_create_timestamp src_update_timestamp")

_stage("products", """
select p_partkey as productcode, p_name as productname, p_type as productline, p_brand as productvendor,
  p_size as quantityinstock, cast(p_retailprice as decimal(18,2)) as msrp,
  cast(date '1997-01-01' + cast(p_partkey % 365 as int) as timestamp) as create_timestamp,
  cast(date '1998-01-01' + cast(case when p_partkey % 3 = 0 then 100 else 0 end as int) as timestamp)
    as update_timestamp
from part""", "productcode productname productline productvendor quantityinstock msrp "
              "create_timestamp update_timestamp")

_dw("products", """
select p_partkey + 1 as dw_product_id, p_partkey as src_productcode, p_name as productname,
  p_type as productline, p_brand as productvendor, p_size as quantityinstock,
  cast(cast(p_retailprice as decimal(18,2)) - case when p_partkey % 6 = 0 then 10 else 0 end
       as decimal(18,2)) as msrp,
  cast(date '1997-01-01' + cast(p_partkey % 365 as int) as timestamp) as src_create_timestamp,
  cast(date '1998-01-01' as timestamp) as src_update_timestamp
from part where p_partkey % 10 <> 9""",
    "dw_product_id src_productcode productname productline productvendor quantityinstock msrp "
    "src_create_timestamp src_update_timestamp")

_stage("customers", """
select c_custkey as customernumber, c_name as customername, n_name as country,
  cast(cast(c_acctbal as decimal(18,2)) + case when c_custkey % 3 = 0 then 500 else 0 end
       as decimal(18,2)) as creditlimit,
  cast(date '1998-05-01' + cast(c_custkey % 60 as int) as timestamp) as create_timestamp,
  cast(date '1998-05-01' + cast(c_custkey % 60 + case when c_custkey % 3 = 0 then 5 else 0 end as int)
       as timestamp) as update_timestamp
from customer join nation on c_nationkey = n_nationkey""",
       "customernumber customername country creditlimit create_timestamp update_timestamp")

_dw("customers", """
select c_custkey + 1 as dw_customer_id, c_custkey as src_customernumber, c_name as customername,
  n_name as country, cast(c_acctbal as decimal(18,2)) as creditlimit,
  cast(date '1998-05-01' + cast(c_custkey % 60 as int) as timestamp) as src_create_timestamp,
  cast(date '1998-05-01' + cast(c_custkey % 60 as int) as timestamp) as src_update_timestamp
from customer join nation on c_nationkey = n_nationkey where c_custkey % 10 <> 9""",
    "dw_customer_id src_customernumber customername country creditlimit src_create_timestamp "
    "src_update_timestamp")

_stage("orders", """
select o_orderkey as ordernumber, cast(o_orderdate as date) as orderdate,
  cast(o_orderdate as date) + 30 as requireddate,
  case when o_orderstatus = 'F' then cast(o_orderdate as date) + cast(1 + o_orderkey % 7 as int) end
    as shippeddate,
  case when o_orderstatus = 'F' then 'Shipped' when o_orderstatus = 'O' then 'In Process'
       when o_orderkey % 11 = 0 then ' cancelled ' else 'Cancelled' end as status,
  case when o_orderstatus = 'P' then cast(o_orderdate as date) + cast(1 + o_orderkey % 5 as int) end
    as cancelleddate,
  o_custkey as customernumber, cast(o_orderdate as timestamp) as create_timestamp,
  cast(cast(o_orderdate as date) + cast(case when o_orderkey % 3 = 0 then 5 else 0 end as int)
       as timestamp) as update_timestamp
from orders""", "ordernumber orderdate requireddate shippeddate status cancelleddate customernumber "
                "create_timestamp update_timestamp")

_dw("orders", """
select s.ordernumber + 1 as dw_order_id, c.dw_customer_id, s.ordernumber as src_ordernumber,
  s.orderdate, s.requireddate, s.shippeddate, s.status, s.cancelleddate,
  s.customernumber as src_customernumber, s.create_timestamp as src_create_timestamp,
  s.update_timestamp as src_update_timestamp
from stg_orders s left join dw_customers c on s.customernumber = c.src_customernumber""",
    "dw_order_id dw_customer_id src_ordernumber orderdate requireddate shippeddate status "
    "cancelleddate src_customernumber src_create_timestamp src_update_timestamp", cte="wh_orders")

_dw("orders", """
select dw_order_id, dw_customer_id, src_ordernumber, orderdate, requireddate,
  'In Process' as status, src_customernumber, src_create_timestamp,
  src_create_timestamp as src_update_timestamp
from wh_orders where src_ordernumber % 10 <> 9""",
    "dw_order_id dw_customer_id src_ordernumber orderdate requireddate status src_customernumber "
    "src_create_timestamp src_update_timestamp")

_stage("orderdetails", """
select l_orderkey as ordernumber, l_partkey as productcode,
  sum(cast(l_quantity as bigint)) as quantityordered,
  max(cast(l_extendedprice as decimal(18,2))) as priceeach, min(l_linenumber) as orderlinenumber,
  cast(min(cast(l_shipdate as date)) as timestamp) as create_timestamp,
  cast(min(cast(l_shipdate as date)) + cast(case when l_orderkey % 3 = 0 then 5 else 0 end as int)
       as timestamp) as update_timestamp
from lineitem group by l_orderkey, l_partkey""",
       "ordernumber productcode quantityordered priceeach orderlinenumber create_timestamp "
       "update_timestamp")

_dw("orderdetails", """
select o.dw_order_id, p.dw_product_id, s.ordernumber as src_ordernumber,
  s.productcode as src_productcode, s.quantityordered, s.priceeach, s.orderlinenumber,
  s.create_timestamp as src_create_timestamp, s.update_timestamp as src_update_timestamp
from stg_orderdetails s left join wh_orders o on s.ordernumber = o.src_ordernumber
  left join dw_products p on s.productcode = p.src_productcode""",
    "dw_order_id dw_product_id src_ordernumber src_productcode quantityordered priceeach "
    "orderlinenumber src_create_timestamp src_update_timestamp", cte="wh_orderdetails")

_dw("orderdetails", """
select dw_order_id, dw_product_id, src_ordernumber, src_productcode,
  quantityordered + 1 as quantityordered, priceeach, orderlinenumber, src_create_timestamp,
  src_create_timestamp as src_update_timestamp
from wh_orderdetails where src_ordernumber % 10 <> 9""",
    "dw_order_id dw_product_id src_ordernumber src_productcode quantityordered priceeach "
    "orderlinenumber src_create_timestamp src_update_timestamp")

_stage("payments", """
select o_custkey as customernumber, concat('CHK', cast(o_orderkey as varchar)) as checknumber,
  cast(o_orderdate as date) + 10 as paymentdate, cast(o_totalprice as decimal(18,2)) as amount,
  cast(o_orderdate as timestamp) as create_timestamp,
  cast(cast(o_orderdate as date) + cast(case when o_orderkey % 9 = 0 then 5 else 0 end as int)
       as timestamp) as update_timestamp
from orders""",
       "customernumber checknumber paymentdate amount create_timestamp update_timestamp")

_dw("payments", """
select c.dw_customer_id, s.customernumber as src_customernumber, s.checknumber, s.paymentdate,
  s.amount, s.create_timestamp as src_create_timestamp, s.update_timestamp as src_update_timestamp
from stg_payments s left join dw_customers c on s.customernumber = c.src_customernumber""",
    "dw_customer_id src_customernumber checknumber paymentdate amount src_create_timestamp "
    "src_update_timestamp", cte="wh_payments")

_dw("payments", """
select dw_customer_id, src_customernumber, checknumber, paymentdate,
  cast(amount - 1 as decimal(18,2)) as amount, src_create_timestamp,
  src_create_timestamp as src_update_timestamp
from wh_payments where src_customernumber % 10 <> 8""",
    "dw_customer_id src_customernumber checknumber paymentdate amount src_create_timestamp "
    "src_update_timestamp")


def _history(name: str, dim: str, id_col: str, key: str, tracked: str, d_active: int,
             d_closed: int) -> None:
    inner = f"""
select {id_col}, case when cast({key} as bigint) % 50 = 0 then null
    when cast({key} as bigint) % 4 = 0 then cast({tracked} - {d_active} as decimal(18,2)) else {tracked} end as {tracked},
  date '1998-01-01' as effective_from_date, cast(null as date) as effective_to_date,
  1 as dw_active_record_ind
from {dim} where cast({key} as bigint) % 7 <> 6
union all
select {id_col}, cast({tracked} - {d_closed} as decimal(18,2)), date '1997-01-01', date '1997-12-31', 0
from {dim} where cast({key} as bigint) % 5 = 0"""
    CTES.add(name, conform_sql(inner, history_schema(id_col, tracked),
                               {id_col, tracked, "effective_from_date", "effective_to_date",
                                "dw_active_record_ind"}))


_history("dw_product_history", "dw_products", "dw_product_id", "src_productcode", "msrp", 5, 20)
_history("dw_customer_history", "dw_customers", "dw_customer_id", "src_customernumber",
         "creditlimit", 100, 200)

CTES.add("batch_control", """
select cast(r_regionkey + 3 as integer) as etl_batch_no,
  date '1998-05-28' + cast(r_regionkey as int) as etl_batch_date
from region""")
