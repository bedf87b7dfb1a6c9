"""Dense surrogate keys for new rows, in natural-key order.

No global window: the rows are range-partitioned and sorted by the natural
key and then the other columns (a distributed sort), pinned with a reliable checkpoint so a re-executed
task sees the same partition contents, counted per partition (one small row
per partition), and numbered as ``start + rows in earlier partitions +
position in the partition``.  The per-partition offsets are bounded by the
partition count, which is what makes broadcasting them safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warehaus.session import ensure_checkpoint_dir


def max_id(df: DataFrame, id_col: str) -> int:
    """Largest existing surrogate (0 for an empty table); one scalar to the driver."""
    row = df.agg(F.max(F.col(id_col)).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def assign_surrogate_keys(df: DataFrame, id_col: str, key: Sequence[str],
                          start: int | Column = 0) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # The other columns break ties: rows without a key spread over partitions and keep one order.
    rest = [c for c in df.columns if c not in key]
    ordered = df.orderBy(*[F.col(k).asc_nulls_first() for k in [*key, *rest]])
    pinned = ordered.checkpoint(eager=True)

    pid = F.spark_partition_id()
    tagged = (pinned
              .withColumn("_pid", pid)
              .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    start_col = start if isinstance(start, Column) else F.lit(int(start))
    numbered = tagged.join(F.broadcast(offsets), "_pid")
    return numbered.select(
        (start_col.cast("bigint") + F.col("_offset") + F.col("_pos") + 1).alias(id_col),
        *[F.col(c) for c in df.columns if c != id_col])
