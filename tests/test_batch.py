import datetime as dt

import pytest

from warehaus.batch import Batch, latest_batch, snapshot_for


def test_latest_batch(spark):
    df = spark.createDataFrame([(3, dt.date(1998, 5, 28)), (7, dt.date(1998, 6, 1)), (5, dt.date(1998, 5, 30))],
                               "etl_batch_no int, etl_batch_date date")
    b = latest_batch(df)
    assert (b.no, b.date, b.date_text) == (7, dt.date(1998, 6, 1), "1998-06-01")
    with pytest.raises(ValueError):
        latest_batch(df.limit(0))


def test_snapshot_for():
    assert snapshot_for("2001-01-01") == "CM_20050609"
    assert snapshot_for("2005-06-12") == "CM_20050612"
    with pytest.raises(ValueError):
        snapshot_for("2005-06-15")
    assert Batch.of(1, "2005-06-10").run_ts == dt.datetime(2005, 6, 11)


def test_snapshot_col_and_column_list(spark):
    from pyspark.sql import functions as F

    from warehaus.batch import snapshot_col
    from warehaus.schemas import TABLES
    from warehaus.sources.extract import column_list

    df = spark.createDataFrame([("2001-01-01",), ("2005-06-14",), ("2005-06-15",), (None,)], "d string")
    got = [r.s for r in df.select(snapshot_col(F.col("d")).alias("s")).collect()]
    assert got == ["CM_20050609", "CM_20050614", None, None]
    assert column_list(" officecode , city,phone ", TABLES["offices"]) == ["officecode", "city", "phone"]
    assert column_list(None, TABLES["offices"]) == TABLES["offices"].stage.names
