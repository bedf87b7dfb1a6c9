"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from warehaus.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ARROW_ROWS = 500
BITS_PER_BLOCK = 32768  # fixed by Spark's bitmap functions: 4,096 bytes


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation, and
    every later use sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most ``ARROW_ROWS`` rows in this session (texts may be long).

    Spark's default of 10,000 rows takes hundreds of megabytes of buffers per
    executor on documents; a smaller setting of the session stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def bit_blocks(cells: DataFrame) -> DataFrame:
    """Fold rows (block, cell) into one 4 KB bitmap per block."""
    return cells.groupBy("block").agg(F.expr("bitmap_construct_agg(cell)").alias("bits"))


def bit_is_set(bits: Column, cell: Column) -> Column:
    """Whether bit ``cell`` of a bitmap column is set (false for a null bitmap)."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(cell / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.floor(byte / F.pow(F.lit(2), F.pmod(cell, F.lit(8)))) % 2 == 1, F.lit(False))


def dealt(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is dealt over the tasks, whatever its estimated size.

    For tables that grow with the input: Spark estimates an exploded or stored
    one from its files and would gather it in the driver to broadcast it.
    """
    return df.hint("merge")


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components of an undirected graph of (u, v) long pairs.

    Alternates large-star and small-star steps (each a grouped minimum and a
    join on the node, never by a broadcast) until the edges stop changing;
    every step is written to the shared folder.  Returns (node, comp) for each node that has an edge to
    another node; ``comp`` is the smallest node of the component.
    """
    e = stored(edges.where("u <> v").select("u", "v").distinct(), purpose)
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(dealt(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(dealt(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v")))
        e = stored(small.where("u <> v").distinct(), purpose)
        now = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
        before = now


def numbered(df: DataFrame, group: str, order: list, purpose: str) -> DataFrame:
    """``df`` with ``pos``, each row's place from 0 within its ``group`` in the given order.

    Rows are dealt by ranges of (group, order), so a hot group spreads over
    many partitions; a row's place is its place in its partition plus the rows
    that the group has in earlier ones.  The written rows decide, so a lost
    executor changes nothing; ties in ``order`` take any order.  ``group``
    must not be null.
    """
    rows = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_at", 33)  # fixed by monotonically_increasing_id: the partition stands above bit 33
    runs = rows.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    line = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(group, "_part", (F.coalesce(F.sum("_n").over(line), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.withColumn("_part", part).join(runs, [group, "_part"]) \
        .withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
