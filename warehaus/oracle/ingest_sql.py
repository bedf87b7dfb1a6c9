"""Oracle SQL for extract, landing round trips and stage-load normalisation."""

from __future__ import annotations

from warehaus.oracle.base import sql_type
from warehaus.oracle.fixtures_sql import CTES
from warehaus.oracle.text_sql import clean_text_sql, latin1_misread_sql
from warehaus.schemas import LOAD_ORDER, TABLES

# Fixed values, stated here on their own: the renderings and the widths in bytes.
DATE_RENDERINGS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "M/d/yyyy", "yyyyMMdd", "dd-MMM-yyyy", "dd-MMM-yy",
                   "dd.MM.yyyy", "MMM d, yyyy", "MMM-dd-yyyy")
TIMESTAMP_RENDERINGS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'",
                        "yyyy-MM-dd HH:mm:ss'+00'", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy hh:mm:ss a", "yyyyMMdd HHmmss",
                        "dd-MMM-yyyy HH:mm:ss")
TRUNCATE_WIDTHS = {"text": 1000, "source": 4}

BLANK = "'^[ \\t\\n\\x0B\\f\\r]*$'"


def blank_null(e: str) -> str:
    return f"CASE WHEN regexp_matches({e}, {BLANK}) THEN NULL ELSE {e} END"


def stage_text(e: str, width: int | None = None) -> str:
    return cut_sql(blank_null(e), width) if width else blank_null(e)


def cut_sql(e: str, width: int) -> str:
    """The longest start of a text that takes at most ``width`` bytes: it decodes, up to three bytes shorter ones do not."""
    tries = ", ".join(f"try(decode(array_slice(encode({e}), 1, {width - i})))" for i in range(4))
    return f"coalesce({tries})"


def extract_sql(t: str) -> str:
    spec = TABLES[t]
    cols = []
    for f in spec.stage.fields:
        e = clean_text_sql(f.name) if sql_type(f.dataType) == "VARCHAR" else f.name
        cols.append(f"CAST({e} AS {sql_type(f.dataType)}) AS {f.name}")
    return f"SELECT {', '.join(cols)} FROM stg_{t}"


def stage_load_sql(t: str, source: str | None = None) -> str:
    spec = TABLES[t]
    cols = []
    for f in spec.stage.fields:
        if sql_type(f.dataType) == "VARCHAR":
            e = stage_text(clean_text_sql(f.name))
        else:
            e = f.name
        cols.append(f"CAST({e} AS {sql_type(f.dataType)}) AS {f.name}")
    return f"SELECT {', '.join(cols)} FROM {source or 'stg_' + t}"


def queries() -> dict[str, str]:
    q = {}
    for t in LOAD_ORDER:
        q[f"extract_{t}"] = extract_sql(t)
        q[f"stage_load_{t}"] = stage_load_sql(t)
    q["clean_text"] = f"SELECT doc_id, {clean_text_sql('text')} AS text FROM documents"
    q["landing_roundtrip"] = (
        f"SELECT doc_id, {stage_text(clean_text_sql('text'))} AS text, "
        f"{stage_text(clean_text_sql('lang'))} AS lang, {stage_text(clean_text_sql('source'))} AS source, "
        f"n_chars FROM documents")
    q["stage_truncate_columns"] = (
        f"SELECT doc_id, {stage_text('text', TRUNCATE_WIDTHS['text'])} AS text, "
        f"{stage_text('source', TRUNCATE_WIDTHS['source'])} AS source FROM documents")
    q["stage_invalid_chars"] = (f"SELECT doc_id, {blank_null(latin1_misread_sql('text'))} AS text "
                                "FROM documents")
    q["stage_null_normalize"] = (
        f"SELECT conv_id, turn, {stage_text('role')} AS role, {stage_text('text')} AS text, "
        f"{stage_text("repeat(' ', CAST(turn AS INTEGER))")} AS note "
        f"FROM conversations")
    layouts = ", ".join("'" + x.replace("'", "''") + "'" for x in (*DATE_RENDERINGS, *TIMESTAMP_RENDERINGS))
    q["stage_parse_temporal"] = (
        f"SELECT o_orderkey, layout, CAST(o_orderdate AS DATE) AS as_date, "
        f"CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS as_ts "
        f"FROM (SELECT o_orderkey, o_orderdate, unnest([{layouts}]) AS layout FROM orders) AS r")
    q["stage_reject_rows"] = (
        "SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'malformed' "
        "ELSE 'o_orderdate' END AS reject_reason FROM orders "
        "WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')")
    q["batch_latest"] = ("SELECT etl_batch_no, etl_batch_date FROM batch_control "
                         "ORDER BY etl_batch_date DESC, etl_batch_no DESC LIMIT 1")
    q["snapshot_select"] = (
        "SELECT batch_date, CASE WHEN batch_date = '2001-01-01' THEN 'CM_20050609' "
        "WHEN batch_date IN ('2005-06-10', '2005-06-11', '2005-06-12', '2005-06-13', '2005-06-14') "
        "THEN 'CM_' || replace(batch_date, '-', '') END AS snapshot "
        "FROM (SELECT DISTINCT CASE WHEN o_orderkey % 7 = 6 THEN '2001-01-01' "
        "ELSE strftime(DATE '2005-06-10' + CAST(o_orderkey % 7 AS INTEGER), '%Y-%m-%d') END AS batch_date FROM orders) AS d")
    return {k: CTES.build(v) for k, v in q.items()}
