"""Exact deduplication by two passes over a Bloom filter.

Pass one hashes every text into cells of a blocked Bloom filter and keeps the
cells that two or more rows touched.  Pass two tests each row: a row with a
cell that nobody else touched is certainly unique and passes straight through;
only the others (the repeated ones and about one unique row in a hundred) are
shuffled by their SHA-256 and resolved exactly.

The filter is broadcast.  Its size is bounded by ``max_blocks`` blocks of 4 KB
(64 MB by default) however large the input is; beyond about 34 million rows it
fills up, more unique rows are shuffled, and the result stays the same.

Defined results: a null text counts as empty; a null id is smaller than any
other; of rows equal in id and text exactly one stays; a very long text is
hashed where it is read and only its digest moves (``drop_exact`` moves the rows
that may be repeated whole); an empty table gives an empty result; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warehaus.llm.common import BITS_PER_BLOCK, bit_blocks, bit_is_set, stored

MAX_BLOCKS = 16384
CELLS_PER_ROW = 16


def repeated_cells(hashes: DataFrame, rows: int, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """The filter of cells touched at least twice, from a column ``h`` of 64-bit hashes."""
    blocks = _blocks(rows, max_blocks)
    twice = _cells(hashes, blocks).groupBy("block", "cell").agg(F.count("*").alias("n")).where("n > 1")
    return bit_blocks(twice), blocks


def key_filter(hashes: DataFrame, rows: int, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """The filter of all cells that the hashes in column ``h`` touch."""
    blocks = _blocks(rows, max_blocks)
    return bit_blocks(_cells(hashes, blocks)), blocks


def _blocks(rows: int, max_blocks: int) -> int:
    return min(max_blocks, 1 << max(0, math.ceil(math.log2(max(1, rows) * CELLS_PER_ROW / BITS_PER_BLOCK))))


def _cells(hashes: DataFrame, blocks: int) -> DataFrame:
    return _located(hashes, blocks).select("block", F.explode(F.array("cell_1", "cell_2")).alias("cell"))


def _located(df: DataFrame, blocks: int) -> DataFrame:
    """Add the filter block of ``h`` and its two cells; equal cells would count one row twice."""
    g = F.xxhash64("h")
    one = g.bitwiseAND(32767)
    step = F.shiftrightunsigned(g, 15).bitwiseAND(16383) + 1
    return df.withColumns({"block": F.pmod("h", F.lit(blocks)), "cell_1": one,
                           "cell_2": (one + step).bitwiseAND(32767)})


def flagged(df: DataFrame, cells: DataFrame, blocks: int) -> DataFrame:
    """Add ``maybe``: whether the row's hash ``h`` may occur again."""
    out = _located(df, blocks).join(F.broadcast(cells), "block", "left")
    maybe = bit_is_set(F.col("bits"), F.col("cell_1")) & bit_is_set(F.col("bits"), F.col("cell_2"))
    return out.withColumn("maybe", maybe).drop("block", "cell_1", "cell_2", "bits")


def mark_exact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays.
    """
    rows = stored(df.select(df[id_col].alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                            F.sha2(F.coalesce(df[text_col], F.lit("")), 256).alias("text_sha256"))
                  .withColumn("h", F.xxhash64("text_sha256")), "exact-rows")
    cells, blocks = repeated_cells(rows, rows.count(), max_blocks)
    seen = flagged(rows, stored(cells, "exact-cells"), blocks)
    single = seen.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    again = seen.where("maybe").select("doc_id", "row", "text_sha256")
    groups = again.groupBy("text_sha256").agg(F.count("*").alias("group_size"),
                                              F.max(F.struct("doc_id", "row")).alias("last"))
    shared = again.join(groups, "text_sha256").select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"), "text_sha256")
    return single.unionByName(shared)


def drop_exact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    Unique rows never leave their task.  The rest meet in a grouped maximum
    that each task applies before the shuffle, so that a text holding a third
    of all rows sends one row per task.
    """
    wide = df.select(F.struct("*").alias("whole"), df[id_col].alias("id"),
                     F.coalesce(df[text_col], F.lit("")).alias("text"))
    wide = wide.withColumn("h", F.xxhash64("text"))
    cells, blocks = repeated_cells(wide, wide.count(), max_blocks)
    seen = flagged(wide, stored(cells, "exact-cells"), blocks)
    single = seen.where(~F.col("maybe")).select("whole")
    order = F.struct("id", F.xxhash64(F.to_json("whole")))
    shared = seen.where("maybe").groupBy(F.sha2("text", 256)).agg(F.max_by("whole", order).alias("whole"))
    return single.unionByName(shared.select("whole")).select("whole.*")
