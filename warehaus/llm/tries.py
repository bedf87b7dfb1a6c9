"""Conversation prefix trie, its subtree totals by parallel tree contraction.

A node of depth d is one distinct sequence of first d turns; its members are
the conversations that start with it.  A node is named by its smallest member
and its depth.  A prefix is recognised by the exclusive or of the fingerprints of
its turns, each of which covers the turn and its place: 120 bits, taken as exact.

Subtree totals: unary chains whose nodes have the same members are compressed
in one aggregation (they share their smallest member and their count).  The
contracted tree is then reduced in join rounds.  A round rakes every leaf into
its parent and then compresses unary chains: an independent set of unary nodes
(a coin per node and round; heads whose parent is not a unary head) is spliced
out, their sums moving to the edge above their child.  After O(log n) rounds
nothing is left; going back through the rounds, a spliced node's total is its
own sum, its child's edge and its child's total.  At last each chain is
expanded: its nodes differ by the running sum of words along the chain.

Scale: turns are numbered and summed in bounded segments (4,096 turns), so one
conversation may hold any share of the rows; a parent's children meet in
partial aggregates, and messages between nodes are joined one to one.  Only
looking up the name of a node's parent may join many children with one row;
adaptive execution splits that join.  The conversations that end at a node are
joined to texts in pieces of 4,096 ids and hashed as a stream.  The driver sees
counts only.

Defined results: rows without a conversation id belong to no conversation and
are left out; null role or text counts as empty; turns are ordered null first,
repeated turn numbers by the digest of role and text, fully equal rows stay and
count as turns of their own; conversations without turns are members of the root; very
long texts cost their hashing only; an empty table has no root and gives an
empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warehaus.llm.common import numbered, stored

SEGMENT_BITS = 12
IDS_A_PIECE = 4096
MOST_SHARED = 4  # h is below this
SHARED_EVERY = 20
# What runs along a path: two fingerprint lanes and the words.
FOLDS = {"x": F.bit_xor, "y": F.bit_xor, "words": F.sum}
NO_ENDS = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from its base."""
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """Rows (conv_id, depth, item, words) of every rebuilt conversation; depth 0, without item, starts each."""
    role, text = F.coalesce(df[role_col], F.lit("")), F.coalesce(df[text_col], F.lit(""))
    own = df.where(df[conv_col].isNotNull()).select(
        df[conv_col].alias("conv_id"), df[turn_col].alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("item"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    own = stored(own.withColumn("tie", F.monotonically_increasing_id()), "trie-turns")
    own = stored(numbered(own, "conv_id", ["turn", "item", "tie"], "trie-turns").drop("turn", "tie"), "trie-turns")
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n")) \
        .withColumns({"h": shared_turns(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % SHARED_EVERY})
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    convs = stored(convs.join(bases, "base", "left")
                   .withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "trie-convs")
    head = own.where((F.col("pos") < MOST_SHARED - 1) & (F.col("conv_id") % SHARED_EVERY == 0)) \
        .select(F.col("conv_id").alias("base"), "pos", "item", "words")
    head = convs.join(head, "base").where("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "item", "words")
    per = convs.select("conv_id", "h", "taken",
                       F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, SEGMENT_BITS))).alias("seg"))
    tail = own.withColumn("seg", F.shiftright("pos", SEGMENT_BITS)).join(per, ["conv_id", "seg"]).where("pos >= h") \
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "item", "words")
    start = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("item"),
                         F.lit(0).cast("long").alias("words"))
    return start.unionByName(head).unionByName(tail)


def paths(turns: DataFrame) -> DataFrame:
    """``turns`` with the fingerprint lanes of the prefix up to each turn (a, b) and before it (pa, pb), and its words."""
    digest = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), "item"), 256)
    lane = lambda at: F.when(F.col("item").isNull(), F.lit(0)) \
        .otherwise(F.conv(F.substring(digest, at, 15), 16, 10).cast("long")).cast("long")
    rows = stored(turns.select("conv_id", "depth", "words", lane(1).alias("x"), lane(17).alias("y"),
                               F.shiftright("depth", SEGMENT_BITS).alias("seg")), "trie-paths")
    line = Window.partitionBy("conv_id", "seg").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    runs = rows.groupBy("conv_id", "seg").agg(*[fold(c).alias(f"s_{c}") for c, fold in FOLDS.items()])
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "seg", *[fold(f"s_{c}").over(before).alias(f"o_{c}") for c, fold in FOLDS.items()])
    rows = rows.select("*", *[fold(c).over(line).alias(f"r_{c}") for c, fold in FOLDS.items()]) \
        .join(runs.where("seg > 0"), ["conv_id", "seg"], "left")
    a, b = (F.col(f"r_{c}").bitwiseXOR(F.coalesce(f"o_{c}", F.lit(0))) for c in ("x", "y"))
    return rows.select("conv_id", "depth", "words", (F.col("r_words") + F.coalesce("o_words", F.lit(0))).alias("path_words"),
                       a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("x")).alias("pa"), b.bitwiseXOR(F.col("y")).alias("pb"))


# ---------------------------------------------------------------- contraction

def coin(node: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(node, F.lit(turn)), F.lit(2)) == 1


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(id, values) with every node's sum over its subtree.

    ``tree`` holds id, parent (null for a root), kids (the number of children)
    and the long ``values``.
    """
    edge = [f"e_{v}" for v in values]
    alive = stored(tree.select("id", "parent", "kids", *values, *[F.lit(0).cast("long").alias(e) for e in edge]), "trie-alive")
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while not alive.isEmpty():
        leaf = F.col("kids") == 0
        up = alive.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id")).agg(
            *[F.sum(F.when(leaf, F.col(v) + F.col(e)).otherwise(0)).alias(f"g_{v}") for v, e in zip(values, edge, strict=True)],
            F.count_if(leaf).alias("raked"), F.min(F.when(~leaf, F.struct("id", *edge))).alias("kid"))
        b = alive.where(~leaf).join(up, "id").select(
            "id", "parent", (F.col("kids") - F.col("raked")).alias("kids"),
            *[(F.col(v) + F.col(f"g_{v}")).alias(v) for v in values], *edge, "kid", coin(F.col("id"), len(rounds)).alias("heads"))
        b = stored(b.withColumn("unary", (F.col("kids") == 1) & F.col("parent").isNotNull()), "trie-raked")
        said = b.where("unary").select(F.col("kid.id").alias("id"), F.col("heads").alias("above"))
        b = stored(b.join(said, "id", "left").withColumn("out", F.expr("unary and heads and not coalesce(above, false)")).drop("above"),
                   "trie-marked")
        moved = b.where("out").select(F.col("kid.id").alias("id"), F.col("parent").alias("new_parent"),
                                      *[(F.col(v) + F.col(e)).alias(f"m_{v}") for v, e in zip(values, edge, strict=True)])
        rounds.append((alive.where(leaf).select("id", *values), b.where("out").select("id", "kid", *values)))
        alive = stored(b.where("not out").join(moved, "id", "left").select(
            "id", F.coalesce("new_parent", "parent").alias("parent"), "kids", *values,
            *[(F.col(e) + F.coalesce(f"m_{v}", F.lit(0))).alias(e) for v, e in zip(values, edge, strict=True)]), "trie-alive")
    known = tree.select("id", *values).limit(0)
    for raked, spliced in reversed(rounds):
        known = known.unionByName(raked)
        back = spliced.join(known.select(F.col("id").alias("below"), *[F.col(v).alias(f"t_{v}") for v in values]),
                            F.col("kid.id") == F.col("below"))
        known = stored(known.unionByName(back.select("id", *[
            (F.col(v) + F.col(f"kid.{e}") + F.col(f"t_{v}")).alias(v) for v, e in zip(values, edge, strict=True)])), "trie-known")
    return known


# ---------------------------------------------------------------- who ends where

def ends_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the comma-joined decimal ids of rows (key, conv_id), numerically ascending."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in batches:
            out = []
            for k, c in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if ids and (k != key or len(ids) == IDS_A_PIECE):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(c)
            yield _batch(out, ("key", "first", "ids"), (pa.string(), pa.int64(), pa.string()))
        if ids:
            yield _batch([(key, ids[0], ",".join(map(str, ids)))], ("key", "first", "ids"), (pa.string(), pa.int64(), pa.string()))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if sha is not None and k == key:
                    sha.update(b",")
                else:
                    if sha is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                sha.update(ids.encode())
            yield _batch(out, ("key", "ends_sha256"), (pa.string(), pa.string()))
        if sha is not None:
            yield _batch([(key, sha.hexdigest())], ("key", "ends_sha256"), (pa.string(), pa.string()))

    rows = ends.select("key", F.col("conv_id").cast("long").alias("conv_id"))
    rows = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    rows = rows.mapInArrow(pieces, "key string, first long, ids string")
    return rows.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key string, ends_sha256 string")


def _batch(rows: list[tuple], names: tuple, types: tuple) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=list(names))


# ---------------------------------------------------------------- the trie

def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie over rows (conv_id, depth, item, words) as ``rebuilt`` gives them."""
    rows = stored(paths(turns), "trie-paths")
    nodes = stored(rows.groupBy("depth", "a", "b").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        F.max("path_words").alias("path_words"), F.max("pa").alias("pa"), F.max("pb").alias("pb")), "trie-nodes")
    root = nodes.where("depth = 0").select("conv_id", "n_convs").first()
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")) \
        .agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, ["depth", "a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    above = nodes.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                                            F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("parent_n"))
    top = nodes.where("depth <= 1").withColumns({
        "parent_conv_id": F.when(F.col("depth") == 1, F.lit(root and root.conv_id)).cast("long"),
        "parent_n": F.when(F.col("depth") == 1, F.lit(root and root.n_convs)).cast("long")})
    nodes = stored(nodes.where("depth > 1").join(above, ["depth", "pa", "pb"]).unionByName(top).select(
        "conv_id", "depth", "parent_conv_id", "parent_n", "n_convs", "n_children", "words", "path_words",
        F.concat_ws(":", *[F.col(c).cast("string") for c in ("depth", "a", "b")]).alias("key")), "trie-nodes")

    chain = nodes.groupBy("conv_id", "n_convs").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"),
        F.sum((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        F.min(F.col("path_words") - F.col("words")).alias("before"),
        F.min_by(F.struct("parent_conv_id", "parent_n"), "depth").alias("above"),
        F.max_by("n_children", "depth").alias("kids"))
    chain = stored(chain.withColumns({
        "id": F.struct(F.col("conv_id").alias("c"), F.col("n_convs").alias("n")),
        "parent": F.when(F.col("top") > 0, F.struct(F.col("above.parent_conv_id").alias("c"), F.col("above.parent_n").alias("n"))),
        "leaves": F.when(F.col("kids") == 0, 1).otherwise(0).cast("long")}), "trie-chains")
    totals = subtree_totals(chain, ["leaves", "saved"])
    totals = chain.select("id", "conv_id", "n_convs", "top", "bottom", "before").join(totals, "id") \
        .select("conv_id", "n_convs", "before", F.col("leaves").alias("n_leaves"), "saved",
                F.explode(F.sequence(F.shiftright("top", SEGMENT_BITS), F.shiftright("bottom", SEGMENT_BITS))).alias("seg"))
    out = nodes.withColumn("seg", F.shiftright("depth", SEGMENT_BITS)).join(totals, ["conv_id", "n_convs", "seg"])

    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("depth", "a", "b"), "depth").alias("end"))
    ends = ends_digests(last.select("conv_id", F.concat_ws(":", *[F.col(f"end.{c}").cast("string") for c in ("depth", "a", "b")]).alias("key")))
    saved = F.col("saved") - (F.col("n_convs") - 1) * (F.col("path_words") - F.col("words") - F.col("before"))
    return out.join(ends, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
