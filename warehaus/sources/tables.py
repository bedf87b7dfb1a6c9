"""Reading the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GIVEN_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                "events", "documents", "embeddings", "pages", "benchmark", "labels",
                "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one given table; projections and filters applied later reach the scan."""
    if name not in GIVEN_TABLES:
        raise KeyError(f"unknown table {name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPREAD_CONF = "spark.warehaus.spreadPartitions"


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over as many partitions as the session asks for.

    Only for inputs known to consist of few large splits (as the single-file
    test tables): a caller sets ``spark.warehaus.spreadPartitions``.  Unset,
    the scan's own splits are kept and nothing is shuffled.
    """
    n = df.sparkSession.conf.get(SPREAD_CONF, None)
    return df.repartition(int(n)) if n else df
