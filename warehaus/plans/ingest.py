"""Queries for extract, landing CSV and the tolerant stage load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from warehaus.batch import latest_batch_row, snapshot_col
from warehaus.functions.text import clean_text
from warehaus.schemas import BIG, DATE, LOAD_ORDER, MONEY, STR, TABLES, TS, _schema
from warehaus.session import scratch_path
from warehaus.sources.extract import extract
from warehaus.sources.fixtures import BATCH, Fixtures
from warehaus.sources.landing import PACKED, landing_path, write_landing
from warehaus.sources.stage_load import load_stage, parse_landing, rejects
from warehaus.sources.tables import read_table, spread

DOCUMENTS = _schema(("doc_id", BIG), ("text", STR), ("lang", STR), ("source", STR), ("n_chars", BIG))
CONVERSATIONS = _schema(("conv_id", BIG), ("turn", BIG), ("role", STR), ("text", STR), ("note", STR))
ORDERS_TEXT = _schema(("o_orderkey", BIG), ("o_orderdate", DATE), ("o_orderstatus", STR),
                      ("o_totalprice", MONEY), ("o_orderpriority", STR))
# Layouts the temporal round trip renders every order date in.
DATE_RENDERINGS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "M/d/yyyy", "yyyyMMdd", "dd-MMM-yyyy", "dd-MMM-yy",
                   "dd.MM.yyyy", "MMM d, yyyy", "MMM-dd-yyyy")
TIMESTAMP_RENDERINGS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'",
                        "yyyy-MM-dd HH:mm:ss'+00'", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy hh:mm:ss a", "yyyyMMdd HHmmss",
                        "dd-MMM-yyyy HH:mm:ss")
TRUNCATE_WIDTHS = {"text": 1000, "source": 4}


def _scratch(spark: SparkSession, what: str) -> str:
    return scratch_path(spark, what)


def round_trip(spark: SparkSession, df: DataFrame, schema: StructType, widths=None,
               max_errors: int | None = 100, write_opts=None, read_opts=None) -> DataFrame:
    """Write ``df`` as landing CSV, then load it back tolerantly."""
    land = write_landing(df, landing_path(_scratch(spark, "landing"), "T", BATCH.date_text),
                         **PACKED, **(write_opts or {}))
    return load_stage(spark, land, schema, _scratch(spark, "stage"), widths, max_errors,
                      **(read_opts or {}))


def stage_load_table(fx: Fixtures, table: str) -> DataFrame:
    spec = TABLES[table]
    extracted = extract(fx.stage(table), spec)
    return round_trip(fx.spark, extracted, spec.stage)


def documents_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents"))
    return docs.select("doc_id", clean_text(F.col("text")).alias("text"))


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents").select(*DOCUMENTS.names))
    cleaned = docs.select(*[clean_text(F.col(c)).alias(c) if c in ("text", "lang", "source") else F.col(c)
                            for c in DOCUMENTS.names])
    return round_trip(spark, cleaned, DOCUMENTS)


def stage_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents").select(*DOCUMENTS.names))
    return round_trip(spark, docs, DOCUMENTS, TRUNCATE_WIDTHS).select("doc_id", "text", "source")


def stage_invalid_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing written in ISO-8859-1 by mistake, loaded as UTF-8: bad bytes become '?'."""
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = round_trip(spark, docs, _schema(("doc_id", BIG), ("text", STR)),
                     write_opts={"encoding": "ISO-8859-1"})
    return out


def stage_null_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = spread(read_table(spark, sf_dir, "conversations"))
    src = conv.select("conv_id", "turn", "role", "text",
                      F.repeat(F.lit(" "), F.col("turn").cast("int")).alias("note"))
    return round_trip(spark, src, CONVERSATIONS)


def stage_parse_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order date rendered in every supported layout, loaded back as date and timestamp."""
    o = spread(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    layouts = F.array(*[F.struct(F.lit(f).alias("layout"),
                                 F.date_format(F.col("o_orderdate"), f).alias("as_text"))
                        for f in (*DATE_RENDERINGS, *TIMESTAMP_RENDERINGS)])
    rendered = o.select("o_orderkey", F.inline(layouts))
    schema = _schema(("o_orderkey", BIG), ("layout", STR), ("as_date", DATE), ("as_ts", TS))
    src = rendered.select("o_orderkey", "layout", F.col("as_text").alias("as_date"),
                          F.col("as_text").alias("as_ts"))
    return round_trip(spark, src, schema)


def stage_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing lines with unparseable dates (priority 5) or an extra field (priority 4)."""
    o = read_table(spark, sf_dir, "orders")
    prio = F.col("o_orderpriority")
    date_text = F.when(prio == "5-LOW", F.lit("n/a")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), date_text, F.col("o_orderstatus"),
                       F.col("o_totalprice").cast("decimal(18,2)").cast("string"), prio,
                       F.when(prio == "4-NOT SPECIFIED", F.lit("extra")))
    land = _scratch(spark, "landing-lines")
    o.select(line.alias("value")).write.mode("overwrite").text(land)
    out = _scratch(spark, "stage")
    load_stage(spark, land, ORDERS_TEXT, out, max_errors=None, header="false")
    return rejects(spark, out, ORDERS_TEXT).select("o_orderkey", "reject_reason")


def snapshot_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot of every order's batch date: the six supported dates and one that is not."""
    day = F.col("o_orderkey") % 7
    date = F.when(day == 6, F.lit("2001-01-01")).otherwise(
        F.date_format(F.date_add(F.lit("2005-06-10").cast("date"), day.cast("int")), "yyyy-MM-dd"))
    dates = read_table(spark, sf_dir, "orders").select(date.alias("batch_date")).distinct()
    return dates.select("batch_date", snapshot_col(F.col("batch_date")).alias("snapshot"))


def _q(fn, *args):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Fixtures(spark, sf_dir), *args)
    return run


def queries() -> dict:
    q = {}
    for t in LOAD_ORDER:
        q[f"extract_{t}"] = _q(lambda fx, t=t: extract(fx.stage(t), TABLES[t]))
        q[f"stage_load_{t}"] = _q(stage_load_table, t)
    q["clean_text"] = documents_clean
    q["landing_roundtrip"] = landing_roundtrip
    q["stage_null_normalize"] = stage_null_normalize
    q["stage_parse_temporal"] = stage_parse_temporal
    q["stage_truncate_columns"] = stage_truncate
    q["stage_invalid_chars"] = stage_invalid_chars
    q["stage_reject_rows"] = stage_reject_rows
    q["batch_latest"] = _q(lambda fx: latest_batch_row(fx.batch_control))
    q["snapshot_select"] = snapshot_select
    return q
