"""Helpers that assemble self-contained oracle SQL texts."""

from __future__ import annotations

import re

from pyspark.sql.types import (DateType, DecimalType, IntegerType, LongType, StringType,
                               StructType, TimestampNTZType)


def sql_type(t) -> str:
    if isinstance(t, StringType):
        return "VARCHAR"
    if isinstance(t, LongType):
        return "BIGINT"
    if isinstance(t, IntegerType):
        return "INTEGER"
    if isinstance(t, DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    if isinstance(t, DateType):
        return "DATE"
    if isinstance(t, TimestampNTZType):
        return "TIMESTAMP"
    raise TypeError(t)


def simple_type(t: str) -> str:
    """Spark DDL type string -> SQL type."""
    return {"int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "string": "VARCHAR",
            "timestamp_ntz": "TIMESTAMP"}.get(t, t.upper())


def conform_sql(inner: str, schema: StructType, present: set[str]) -> str:
    """Project ``inner`` onto ``schema``; absent columns become typed NULLs."""
    cols = []
    for f in schema.fields:
        src = f.name if f.name in present else "NULL"
        cols.append(f"CAST({src} AS {sql_type(f.dataType)}) AS {f.name}")
    return f"SELECT {', '.join(cols)} FROM ({inner}) AS src"


def pad_sql(layout, values: dict[str, str]) -> str:
    """Select list for a block layout: given expressions, else 0, cast per column."""
    return ", ".join(f"CAST({values.get(n, '0')} AS {simple_type(t)}) AS {n}" for n, t in layout)


class CteSet:
    """Named SQL snippets; :meth:`build` prepends every snippet a body refers to."""

    def __init__(self):
        self.defs: dict[str, str] = {}

    def add(self, name: str, sql: str) -> None:
        self.defs[name] = sql.strip()

    def _deps(self, sql: str) -> list[str]:
        words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
        return [n for n in self.defs if n in words]

    def build(self, body: str, materialized: bool = False) -> str:
        how = "AS MATERIALIZED" if materialized else "AS"
        order: list[str] = []
        seen: set[str] = set()

        def visit(name: str, stack: tuple[str, ...] = ()):
            if name in seen:
                return
            for d in self._deps(self.defs[name]):
                if d != name and d not in stack:
                    visit(d, stack + (name,))
            seen.add(name)
            order.append(name)

        for d in self._deps(body):
            visit(d)
        if not order:
            return body.strip()
        ctes = ",\n".join(f"{n} {how} (\n{self.defs[n]}\n)" for n in order)
        return f"WITH {ctes}\n{body.strip()}"
