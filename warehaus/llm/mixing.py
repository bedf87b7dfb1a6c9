"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources get targets by weight (each at most ``max_epochs`` times its size, the
excess shared again by weight).  The target total is cut into blocks of
``block_words`` words.  Blocks are allotted to sources by the highest quotients
target / (2 k + 1), and each source's quota the same way to its shards, which
gives integer quotas.  What a source's whole blocks leave over or take too much
against its target, rounded to a word, is settled in words by its shards, those
with most room first; so a source of fewer words than a block gets its words as
well.  A shard then takes its quota from its documents laid out in a seeded
order: whole rounds first, then the leading words of one more.

Scale: a shard is a hash range of the documents, sized so that it holds about
``shard_rows`` rows of even the largest source; the ordered running sum is
taken within one (source, shard).  Sizes are aggregated before any shuffle;
the windows over sources and shards see one row each.

Defined results: a null or blank text has size 0 and takes 0; a null source is
a source of its own, last in order; equal quotients go to the larger vote, then
to the smaller source or shard; rows equal in id and size are interchangeable,
repeated rows count as rows of their own; a very long text may be taken in part
or up to three times like any other; other columns play no part, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warehaus.llm.common import stored

BLOCK_WORDS = 16
MAX_EPOCHS = 3
SHARD_ROWS = 50_000
SEED = 17


def targets(sizes: DataFrame, weight_cycle: int = 3, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(place, source_size) -> the same with ``weight`` and ``target``.

    ``place`` sorts the sources: "s" and the name, or "~" for the null source.
    Raising a common level until it meets the total, where source i holds
    min(cap_i, level * weight_i), is what sharing the excess again and again
    ends in.  In order of cap / weight the capped sources come first.
    """
    w = F.pmod(F.row_number().over(Window.orderBy("place")) - 1, F.lit(weight_cycle)) + 1
    rows = sizes.withColumns({"weight": w.cast("double"), "cap": (F.lit(max_epochs) * F.col("source_size")).cast("double")})
    at = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    every = Window.partitionBy()
    rows = rows.withColumns({
        "total": F.sum("source_size").over(every),
        "held": F.coalesce(F.sum("cap").over(at.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "open": F.sum("weight").over(at.rowsBetween(0, Window.unboundedFollowing))})
    rows = rows.withColumn("level", (F.col("total") - F.col("held")) / F.col("open"))
    met = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    rows = rows.withColumn("level", F.max(met).over(every))
    goal = F.least("cap", F.coalesce("level", F.lit(math.inf)) * F.col("weight"))
    return rows.select("place", "source_size", "weight", F.round(goal, 6).alias("target"))


def apportion(rows: DataFrame, group: list[str], votes: str, seats: str, out: str) -> DataFrame:
    """Sainte-Lague seats within each group; ``seats`` holds the group's total.

    The highest-quotient result rounds every fair share after one common
    stretch.  With n parties the roundings differ from the shares by n / 2 in
    all, so a party's seats lie within n / 2 times its part of the votes (and
    one rounding) of its fair share.  Seats below that range are certain; the
    explode lists the range, four quotients a party on average, and the
    remaining seats go to the highest.  Ties go to the larger vote, then to
    the smaller ``party``.
    """
    w = Window.partitionBy(*group)
    part = F.when(F.sum(votes).over(w) > 0, F.col(votes) / F.sum(votes).over(w)).otherwise(F.lit(0.0))
    rows = rows.withColumns({"part": part, "slack": F.count("*").over(w) / 2 * part})
    fair = F.col("part") * F.col(seats)
    rows = rows.withColumns({
        "low": F.greatest(F.floor(fair - F.col("slack") + 0.5) - 1, F.lit(0)),
        "high": F.floor(fair + F.col("slack") + 0.5) + 1})
    rows = rows.withColumn("sure", F.sum("low").over(w))
    spare = rows.withColumn("k", F.explode(F.sequence("low", "high")))
    order = Window.partitionBy(*group).orderBy((F.col(votes) / (2 * F.col("k") + 1)).desc(), F.col(votes).desc(),
                                               "party", "k")
    won = F.when(F.row_number().over(order) <= F.col(seats) - F.col("sure"), 1).otherwise(0)
    names = [c for c in rows.columns if c not in ("part", "slack", "low", "high", "sure")]
    return spare.withColumn("won", won).groupBy(*names, "low").agg(F.sum("won").alias("more")) \
        .select(*names, (F.col("low") + F.col("more")).cast("long").alias(out))


def settled(shards: DataFrame) -> DataFrame:
    """Shards with ``words`` moved so that a source's sum is its target, rounded to a word; none below 0 or above ``most``."""
    every = Window.partitionBy("place")
    rows = shards.withColumn("owed", F.round("target").cast("long") - F.sum("words").over(every))
    rows = rows.withColumn("room", F.when(F.col("owed") > 0, F.col("most") - F.col("words")).otherwise(F.col("words")))
    line = every.orderBy(F.desc("room"), "shard").rowsBetween(Window.unboundedPreceding, -1)
    left = F.abs("owed") - F.coalesce(F.sum("room").over(line), F.lit(0))
    moved = F.signum("owed").cast("long") * F.least("room", F.greatest(left, F.lit(0)))
    return rows.withColumn("words", F.col("words") + moved).drop("owed", "room", "most")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_words: int = BLOCK_WORDS, max_epochs: int = MAX_EPOCHS, shard_rows: int = SHARD_ROWS,
        seed: int = SEED, keep_rows: bool = False) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken.

    ``taken`` counts the words the mix takes of the row, repeats included.
    With ``keep_rows`` the input columns come along in a struct ``whole``.
    """
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), df[id_col].cast("string")).cast("binary"))
    words = F.regexp_count(F.coalesce(df[text_col], F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    base = stored(df.select(df[id_col].alias("doc_id"), F.coalesce(F.concat(F.lit("s"), df[source_col]), F.lit("~")).alias("place"),
                            words.alias("size"), order.alias("key"),
                            *([F.struct("*").alias("whole")] if keep_rows else [])), "mix-rows")
    shards = max(1, math.ceil(base.count() / shard_rows))
    base = base.withColumn("shard", F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.lit(shards)))
    per = stored(base.groupBy("place", "shard").agg(F.sum("size").alias("shard_size")), "mix-shards")
    goal = targets(per.groupBy("place").agg(F.sum("shard_size").alias("source_size")), max_epochs=max_epochs)
    goal = goal.withColumns({"seats": F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long"),
                             "party": F.col("place"), "all_sources": F.lit(0)})
    goal = apportion(goal, ["all_sources"], "target", "seats", "quota")
    per = per.join(stored(goal.select("place", "source_size", "target", "quota"), "mix-targets"), "place")
    per = apportion(per.withColumnRenamed("shard", "party"), ["place"], "shard_size", "quota", "blocks")
    per = settled(per.select("place", F.col("party").alias("shard"), "source_size", "target", "shard_size",
                             (F.col("shard_size") * max_epochs).alias("most"),
                             F.least(F.col("blocks") * block_words, F.col("shard_size") * max_epochs).alias("words")))
    line = Window.partitionBy("place", "shard").orderBy("key", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    got = base.withColumn("start", F.coalesce(F.sum("size").over(line), F.lit(0))).join(per, ["place", "shard"])
    rounds = F.when(F.col("shard_size") > 0, F.expr("words div shard_size")).otherwise(F.lit(0))
    left = F.col("words") - rounds * F.col("shard_size")
    taken = rounds * F.col("size") + F.least(F.greatest(left - F.col("start"), F.lit(0)), F.col("size"))
    return got.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"),
                      *(["whole"] if keep_rows else []))


def mixed_rows(df: DataFrame, **how) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them (0 to ``max_epochs`` times).

    A row taken in part counts as one more when at least half its words are.
    """
    rows = mix(df, keep_rows=True, **how)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(F.lit(0)).cast("int")
    return rows.select(F.explode(F.array_repeat("whole", times)).alias("whole")).select("whole.*")
