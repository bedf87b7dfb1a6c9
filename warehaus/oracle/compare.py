"""Compare a Spark result with its oracle SQL run by DuckDB on the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

from warehaus.sources.tables import GIVEN_TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in GIVEN_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, list):
        return tuple(map(norm, v))
    return v


def kind(t: str) -> str:
    t = t.lower()
    for k, names in {"int": ("int", "integer", "int32"), "bigint": ("bigint", "long", "int64"),
                     "str": ("string", "varchar"), "date": ("date",),
                     "ts": ("timestamp_ntz", "timestamp")}.items():
        if t in names:
            return k
    return t.replace(" ", "")


def compare(df, sql: str, con) -> list[str]:
    """Problems found (empty when columns, types, row count and row multiset agree)."""
    s_cols = [(f.name, kind(f.dataType.simpleString())) for f in df.schema.fields]
    s_rows = Counter(tuple(norm(v) for v in r) for r in df.collect())
    cur = con.execute(sql)
    d_cols = [(d[0], kind(str(d[1]))) for d in cur.description]
    d_rows = Counter(tuple(norm(v) for v in r) for r in cur.fetchall())
    problems = []
    if [c for c, _ in s_cols] != [c for c, _ in d_cols]:
        problems.append(f"columns {s_cols} vs {d_cols}")
    elif s_cols != d_cols:
        problems.append("types " + str([(a, b) for a, b in zip(s_cols, d_cols) if a != b]))
    if sum(s_rows.values()) != sum(d_rows.values()):
        problems.append(f"rows {sum(s_rows.values())} vs {sum(d_rows.values())}")
    if s_rows != d_rows:
        problems.append(f"values differ; spark-only {list((s_rows - d_rows).elements())[:3]}; "
                        f"duckdb-only {list((d_rows - s_rows).elements())[:3]}")
    return problems
