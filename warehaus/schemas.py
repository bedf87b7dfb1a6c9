"""Table registry: stage layout, natural key, warehouse layout, update sets.

One :class:`TableSpec` per source table drives every generic operator
(extract, landing, stage load, upsert, lookups), so the eight per-table
loaders are data, not code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (DataType, DateType, DecimalType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType)

STR = StringType()
BIG = LongType()
INT = IntegerType()
MONEY = DecimalType(18, 2)
DATE = DateType()
TS = TimestampNTZType()

# Audit columns carried by every upserted warehouse table.
AUDIT = (("src_create_timestamp", TS), ("src_update_timestamp", TS),
         ("dw_create_timestamp", TS), ("dw_update_timestamp", TS),
         ("etl_batch_no", INT), ("etl_batch_date", DATE))

# Stage-side names of the source timestamps and their warehouse names.
SOURCE_TS_RENAMES = {"create_timestamp": "src_create_timestamp",
                     "update_timestamp": "src_update_timestamp"}


@dataclass(frozen=True)
class Lookup:
    """Foreign-key resolution: stage column -> surrogate id of a dimension."""

    target: str        # warehouse column to fill, e.g. dw_customer_id
    dimension: str     # dimension table name, e.g. customers
    stage_col: str     # column of the (renamed) stage row holding the natural key
    dim_col: str       # natural-key column of the dimension
    dim_id: str        # surrogate column of the dimension
    on_update: bool    # re-resolved when an existing row is updated


@dataclass(frozen=True)
class TableSpec:
    name: str
    landing_name: str
    stage: StructType
    key: tuple[str, ...]                  # natural key, stage names
    renames: dict[str, str]               # stage -> warehouse names (besides timestamps)
    surrogate: str | None
    update_columns: tuple[str, ...]       # warehouse business columns refreshed when newer
    lookups: tuple[Lookup, ...] = ()
    placeholders: tuple[str, ...] = ()    # bigint FK columns inserted as NULL

    # -- derived layouts -------------------------------------------------
    def dw_name(self, stage_col: str) -> str:
        return self.renames.get(stage_col, SOURCE_TS_RENAMES.get(stage_col, stage_col))

    @property
    def dw_key(self) -> tuple[str, ...]:
        return tuple(self.dw_name(c) for c in self.key)

    @property
    def dw_schema(self) -> StructType:
        fields: list[StructField] = []
        if self.surrogate:
            fields.append(StructField(self.surrogate, BIG))
        lookup_targets = [lk.target for lk in self.lookups]
        # Lookups that resolve a leading parent id come first (orders: dw_customer_id).
        lead = [t for t in lookup_targets if t in LEADING_FK.get(self.name, ())]
        for t in lead:
            fields.append(StructField(t, BIG))
        for f in self.stage.fields:
            if f.name in SOURCE_TS_RENAMES:
                continue
            fields.append(StructField(self.dw_name(f.name), f.dataType))
        for t in lookup_targets:
            if t not in lead:
                fields.append(StructField(t, BIG))
        for p in self.placeholders:
            fields.append(StructField(p, BIG))
        for n, t in AUDIT:
            fields.append(StructField(n, t))
        return StructType(fields)

    @property
    def dw_columns(self) -> list[str]:
        return [f.name for f in self.dw_schema.fields]

    def type_of(self, dw_col: str) -> DataType:
        return self.dw_schema[dw_col].dataType


def _schema(*cols: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t) for n, t in cols])


_TS_COLS = (("create_timestamp", TS), ("update_timestamp", TS))

# Parent ids placed before the business columns in the warehouse layout.
LEADING_FK = {"orders": ("dw_customer_id",), "orderdetails": ("dw_order_id", "dw_product_id"),
              "payments": ("dw_customer_id",)}

# Fixed values, which must equal the reference's: column names, natural keys, renames,
# surrogate names, update sets and lookups of the eight tables.
OFFICES = TableSpec(
    name="offices", landing_name="Offices",
    stage=_schema(("officecode", STR), ("city", STR), ("phone", STR), ("addressline1", STR),
                  ("addressline2", STR), ("state", STR), ("country", STR), ("postalcode", STR),
                  ("territory", STR), *_TS_COLS),
    key=("officecode",), renames={}, surrogate="dw_office_id",
    update_columns=("city", "phone", "addressline1", "addressline2", "state", "country",
                    "postalcode", "territory"))

EMPLOYEES = TableSpec(
    name="employees", landing_name="Employees",
    stage=_schema(("employeenumber", BIG), ("lastname", STR), ("firstname", STR),
                  ("extension", STR), ("email", STR), ("officecode", STR), ("reportsto", BIG),
                  ("jobtitle", STR), *_TS_COLS),
    key=("employeenumber",), renames={}, surrogate="dw_employee_id",
    update_columns=("lastname", "firstname", "extension", "email", "officecode", "reportsto",
                    "jobtitle"),
    placeholders=("dw_office_id", "dw_reporting_employee_id"))

PRODUCTLINES = TableSpec(
    name="productlines", landing_name="ProductLines",
    stage=_schema(("productline", STR), ("textdescription", STR), ("htmldescription", STR),
                  ("image", STR), *_TS_COLS),
    key=("productline",), renames={}, surrogate="dw_product_line_id",
    update_columns=("textdescription", "htmldescription", "image"))

PRODUCTS = TableSpec(
    name="products", landing_name="Products",
    stage=_schema(("productcode", STR), ("productname", STR), ("productline", STR),
                  ("productscale", STR), ("productvendor", STR), ("productdescription", STR),
                  ("quantityinstock", INT), ("buyprice", MONEY), ("msrp", MONEY), *_TS_COLS),
    key=("productcode",), renames={"productcode": "src_productcode"}, surrogate="dw_product_id",
    update_columns=("productname", "productline", "productscale", "productvendor",
                    "productdescription", "quantityinstock", "buyprice", "msrp",
                    "dw_product_line_id"),
    lookups=(Lookup("dw_product_line_id", "productlines", "productline", "productline",
                    "dw_product_line_id", on_update=True),))

CUSTOMERS = TableSpec(
    name="customers", landing_name="Customers",
    stage=_schema(("customernumber", BIG), ("customername", STR), ("contactlastname", STR),
                  ("contactfirstname", STR), ("phone", STR), ("addressline1", STR),
                  ("addressline2", STR), ("city", STR), ("state", STR), ("postalcode", STR),
                  ("country", STR), ("salesrepemployeenumber", BIG), ("creditlimit", MONEY),
                  *_TS_COLS),
    key=("customernumber",), renames={"customernumber": "src_customernumber"},
    surrogate="dw_customer_id",
    update_columns=("customername", "contactlastname", "contactfirstname", "phone",
                    "addressline1", "addressline2", "city", "state", "postalcode", "country",
                    "salesrepemployeenumber", "creditlimit"))

ORDERS = TableSpec(
    name="orders", landing_name="Orders",
    stage=_schema(("ordernumber", BIG), ("orderdate", DATE), ("requireddate", DATE),
                  ("shippeddate", DATE), ("status", STR), ("comments", STR),
                  ("cancelleddate", DATE), ("customernumber", BIG), *_TS_COLS),
    key=("ordernumber",),
    renames={"ordernumber": "src_ordernumber", "customernumber": "src_customernumber"},
    surrogate="dw_order_id",
    update_columns=("dw_customer_id", "orderdate", "requireddate", "shippeddate", "status",
                    "comments", "cancelleddate", "src_customernumber"),
    lookups=(Lookup("dw_customer_id", "customers", "src_customernumber", "src_customernumber",
                    "dw_customer_id", on_update=True),))

ORDERDETAILS = TableSpec(
    name="orderdetails", landing_name="OrderDetails",
    stage=_schema(("ordernumber", BIG), ("productcode", STR), ("quantityordered", INT),
                  ("priceeach", MONEY), ("orderlinenumber", INT), *_TS_COLS),
    key=("ordernumber", "productcode"),
    renames={"ordernumber": "src_ordernumber", "productcode": "src_productcode"},
    surrogate=None,
    update_columns=("quantityordered", "priceeach", "orderlinenumber"),
    lookups=(Lookup("dw_order_id", "orders", "src_ordernumber", "src_ordernumber",
                    "dw_order_id", on_update=False),
             Lookup("dw_product_id", "products", "src_productcode", "src_productcode",
                    "dw_product_id", on_update=False)))

PAYMENTS = TableSpec(
    name="payments", landing_name="Payments",
    stage=_schema(("customernumber", BIG), ("checknumber", STR), ("paymentdate", DATE),
                  ("amount", MONEY), *_TS_COLS),
    key=("customernumber", "checknumber"), renames={"customernumber": "src_customernumber"},
    surrogate=None,
    update_columns=("paymentdate", "amount"),
    lookups=(Lookup("dw_customer_id", "customers", "src_customernumber", "src_customernumber",
                    "dw_customer_id", on_update=False),))

TABLES: dict[str, TableSpec] = {t.name: t for t in
                                (OFFICES, EMPLOYEES, PRODUCTLINES, PRODUCTS, CUSTOMERS, ORDERS,
                                 ORDERDETAILS, PAYMENTS)}

# Warehouse load order (dimensions before the facts that look them up).
LOAD_ORDER = ("offices", "employees", "productlines", "products", "customers", "orders",
              "orderdetails", "payments")

# SCD-2 histories: (history name, dimension, surrogate, tracked column).
HISTORIES = {"product_history": ("products", "dw_product_id", "msrp"),
             "customer_history": ("customers", "dw_customer_id", "creditlimit")}


def history_schema(id_col: str, tracked: str) -> StructType:
    return _schema((id_col, BIG), (tracked, MONEY), ("effective_from_date", DATE),
                   ("effective_to_date", DATE), ("dw_active_record_ind", INT),
                   ("dw_create_timestamp", TS), ("dw_update_timestamp", TS),
                   ("create_etl_batch_no", INT), ("create_etl_batch_date", DATE),
                   ("update_etl_batch_no", INT), ("update_etl_batch_date", DATE))


def conform(df, schema: StructType):
    """Project ``df`` onto ``schema``: cast present columns, add missing as typed NULL."""
    from pyspark.sql import functions as F
    present = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in present else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])
