"""Registry of every query key and its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from warehaus.plans import batches, histories, ingest, summaries, upserts
    q: dict = {}
    q.update(summaries.queries())
    q.update(upserts.queries())
    q.update(histories.queries())
    q.update(ingest.queries())
    q.update(batches.queries())
    return q


def oracle_sql() -> dict[str, str]:
    from warehaus.oracle import batches_sql, history_sql, ingest_sql, summary_sql, upsert_sql
    o: dict = {}
    o.update(summary_sql.queries())
    o.update(upsert_sql.queries())
    o.update(history_sql.queries())
    o.update(ingest_sql.queries())
    o.update(batches_sql.queries())
    return o
