"""Batch identity, batch-control lookup and snapshot selection."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Batch:
    """One warehouse load: number, business date and the run timestamp.

    ``run_ts`` stands in for CURRENT_TIMESTAMP so that every row stamped in a
    batch carries the same value and reruns are reproducible.
    """

    no: int
    date: dt.date
    run_ts: dt.datetime

    @classmethod
    def of(cls, no: int, date: str | dt.date, run_ts: str | dt.datetime | None = None) -> "Batch":
        d = dt.date.fromisoformat(date) if isinstance(date, str) else date
        if run_ts is None:
            ts = dt.datetime.combine(d + dt.timedelta(days=1), dt.time())
        elif isinstance(run_ts, str):
            ts = dt.datetime.fromisoformat(run_ts)
        else:
            ts = run_ts
        return cls(int(no), d, ts)

    @property
    def date_text(self) -> str:
        return self.date.strftime("%Y-%m-%d")

    # Column literals used by the stamping operators.
    def no_col(self) -> Column:
        return F.lit(self.no).cast("int")

    def date_col(self) -> Column:
        return F.lit(self.date).cast("date")

    def ts_col(self) -> Column:
        # From text: a string -> timestamp_ntz cast does not depend on any time zone.
        return F.lit(self.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def latest_batch_row(control: DataFrame, no_col: str = "etl_batch_no",
                     date_col: str = "etl_batch_date") -> DataFrame:
    """The current batch: latest date, ties broken by the highest number.

    The control table is tiny; ordering it is a single small task.
    """
    return (control
            .select(F.col(no_col).cast("int").alias("etl_batch_no"),
                    F.to_date(F.col(date_col)).alias("etl_batch_date"))
            .orderBy(F.col("etl_batch_date").desc(), F.col("etl_batch_no").desc())
            .limit(1))


def latest_batch(control: DataFrame, run_ts: dt.datetime | None = None) -> Batch:
    row = latest_batch_row(control).first()
    if row is None:
        raise ValueError("batch control table is empty")
    return Batch.of(row["etl_batch_no"], row["etl_batch_date"], run_ts)


# The supported batch dates and the source snapshot each reads.
# "2001-01-01" is the initial load and reads the base snapshot of 2005-06-09.
INITIAL_LOAD_DATE = "2001-01-01"
BASE_SNAPSHOT = "CM_20050609"
SNAPSHOT_DATES = ("2005-06-10", "2005-06-11", "2005-06-12", "2005-06-13", "2005-06-14")


def snapshot_for(batch_date: str | dt.date) -> str:
    """Name of the source snapshot a batch date reads; unsupported dates raise."""
    text = batch_date if isinstance(batch_date, str) else batch_date.strftime("%Y-%m-%d")
    if text == INITIAL_LOAD_DATE:
        return BASE_SNAPSHOT
    if text in SNAPSHOT_DATES:
        return "CM_" + text.replace("-", "")
    raise ValueError(f"no source snapshot for batch date {text}")


def snapshot_col(date_text: Column) -> Column:
    """Column form of :func:`snapshot_for`; NULL for unsupported dates."""
    supported = F.array(*[F.lit(d) for d in SNAPSHOT_DATES])
    return (F.when(date_text == F.lit(INITIAL_LOAD_DATE), F.lit(BASE_SNAPSHOT))
             .when(F.array_contains(supported, date_text),
                   F.concat(F.lit("CM_"), F.regexp_replace(date_text, "-", ""))))
