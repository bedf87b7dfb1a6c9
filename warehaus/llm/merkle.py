"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf.  The leaves of a group (a language), in order of their
id, are paired level by level up to the group's subroot, and the subroots, in
order of their groups, the same way up to the root.

Forward sweep: a node is labelled (level, place); labels grow from the leaves
to the root, and a node sends its digest as a message to its parent, which
has a larger label.  A priority queue ordered by label delivers them.  It is
external in that only the messages inside one block of ``2 ** height`` leaves
meet in a task's heap; a block's top digest is written out as the message to
the next tier of blocks, which Spark's shuffle sorts by label again.  So a
tree over n leaves takes log2(n) / height jobs instead of log2(n).

Reversed sweep: from the root down, a node's proof suffix (the siblings from
it up to the root) is delivered to its children, which put their own siblings
in front; a block takes one suffix for its top and hands one to each leaf.

Scale: no task holds more than one block (4,096 narrow rows) beside its
Arrow batch, whatever a group's share of the rows; texts are hashed where they
are read and never shuffled.  Only counts come to the driver.

Defined results: a null id stands before all others of its group, is never
tampered with and verifies; equal ids stand in order of their leaf digests,
fully equal rows in any order; a null group is a group of its own, before all
others; null and empty texts differ (``-`` and ``0:``); very long texts only
cost their hashing; an empty table gives an empty result; other columns of the
table play no part.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warehaus.llm.common import numbered, stored

HEIGHT = 12
#: One step of a proof: the side the sibling stands on and its digest; a node paired with none has an empty step.
LEFT, RIGHT, ALONE = "<", ">", "="
MESSAGES = "place string, pos long, digest string, n long"
SUFFIXES = "place string, pos long, suffix string, subroot string, root string"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def part_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[part_text(v) for v in values]), 256)


# ---------------------------------------------------------------- inside one block

def levels_of(n: int) -> int:
    """Levels above n nodes."""
    return (n - 1).bit_length()


def digest_of(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def forward(digests: list[str], top: int) -> dict[tuple[int, int], str]:
    """Digest of every node of a block, by label; ``top`` is the block's height.

    The heap holds the messages (label of the receiver, label of the sender,
    digest); the smallest label's messages are all there when it comes up.
    """
    queue = [((0, i), (0, i), d) for i, d in enumerate(digests)]
    heapq.heapify(queue)
    nodes: dict[tuple[int, int], str] = {}
    while queue:
        label = queue[0][0]
        got = []
        while queue and queue[0][0] == label:
            got.append(heapq.heappop(queue)[2])
        nodes[label] = got[0] if label[0] == 0 else digest_of(*got)
        if label[0] < top:
            heapq.heappush(queue, ((label[0] + 1, label[1] >> 1), label, nodes[label]))
    return nodes


def reverse(nodes: dict[tuple[int, int], str], top: int, suffix: str) -> list[str]:
    """Proof suffix of every leaf of a block, from that of its top, by falling labels."""
    have = {(top, 0): suffix}
    for level, i in sorted(nodes, reverse=True):
        if level == top:
            continue
        beside = nodes.get((level, i ^ 1))
        step = ALONE if beside is None else (LEFT if i & 1 else RIGHT) + beside
        have[level, i] = step + have[level + 1, i >> 1]
    return [have[0, i] for i in range(sum(level == 0 for level, _ in nodes))]


def steps(proof: str) -> Iterator[tuple[str, str]]:
    at = 0
    while at < len(proof):
        side = proof[at]
        width = 0 if side == ALONE else 64
        yield side, proof[at + 1:at + 1 + width]
        at += 1 + width


def fold(leaf: str, proof: str) -> str:
    """The root that a leaf and its siblings lead to."""
    for side, beside in steps(proof):
        leaf = digest_of(leaf) if side == ALONE else digest_of(beside, leaf) if side == LEFT else digest_of(leaf, beside)
    return leaf


def block_height(n: int, height: int) -> int:
    """A group that fits one block ends below the block's height."""
    return min(levels_of(n), height)


# ---------------------------------------------------------------- the sweeps

def _table(schema: str, rows: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)


def _in_order(block: pa.Table) -> pa.Table:
    return block.sort_by("pos")


def tiers(leaves: DataFrame, height: int, purpose: str) -> list[DataFrame]:
    """Tier 0 is ``leaves`` (place, pos, digest, n); each further one holds the block tops of the one below.

    ``n`` is the number of the group's nodes in the tier.  The last tier has
    one node per group.
    """
    def up(block: pa.Table) -> pa.Table:
        block = _in_order(block)
        place, pos, n = (block[c][0].as_py() for c in ("place", "pos", "n"))
        top = block_height(n, height)
        nodes = forward(block["digest"].to_pylist(), top)
        return _table(MESSAGES, [(place, pos >> height, nodes[top, 0], ((n - 1) >> height) + 1)])

    out, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        blocks = out[-1].select(*[c.split()[0] for c in MESSAGES.split(", ")])
        blocks = blocks.groupBy("place", F.shiftright("pos", height).alias("block"))
        out.append(stored(blocks.applyInArrow(up, MESSAGES), purpose))
        most = ((most - 1) >> height) + 1
    return out


def suffixes(tops: DataFrame, levels: list[DataFrame], last: int, height: int, purpose: str) -> DataFrame:
    """Suffix of every node of tier ``last``, from ``tops``, those of the top tier's nodes."""
    def down(block: pa.Table, above: pa.Table) -> pa.Table:
        block = _in_order(block)
        place, n = block["place"][0].as_py(), block["n"][0].as_py()
        top = block_height(n, height)
        nodes = forward(block["digest"].to_pylist(), top)
        suffix, subroot, root = (above[c][0].as_py() for c in ("suffix", "subroot", "root"))
        return _table(SUFFIXES, [(place, p, s, subroot, root) for p, s in
                                 zip(block["pos"].to_pylist(), reverse(nodes, top, suffix), strict=True)])

    for tier in levels[len(levels) - 2:last - 1 if last else None:-1] if len(levels) > 1 else ():
        tops = stored(_by_block(tier, height).cogroup(tops.groupBy("place", "pos")).applyInArrow(down, SUFFIXES), purpose)
    return tops


def _by_block(tier: DataFrame, height: int):
    return tier.groupBy("place", F.shiftright("pos", height).alias("block"))


def _counted(rows: DataFrame) -> DataFrame:
    """Rows with ``n``, the number of rows of their group."""
    return rows.join(rows.groupBy("place").agg((F.max("pos") + 1).alias("n")), "place")


def manifest(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", group_col: str = "lang",
             count_col: str = "n_chars", text_col: str = "text", tamper: Column | None = None,
             height: int = HEIGHT, with_proof: bool = False) -> DataFrame:
    """One row per row of ``df``: id, leaf, subroot, root, proof_sha256, folded_root, verified, and the proof if asked for.

    ``folded_root`` is folded from the leaf as it is after tampering (1 added
    to ``count_col`` where ``tamper`` holds) along the untampered siblings.
    """
    tamper = F.coalesce(tamper if tamper is not None else F.lit(False), F.lit(False))
    count = df[count_col].cast("decimal(20,0)")
    parts = [df[id_col], df[source_col], df[group_col], count, df[text_col]]
    changed = [df[id_col], df[source_col], df[group_col], count + 1, df[text_col]]
    digest = leaf_digest(*parts)
    leaves = df.select(df[id_col].alias("doc_id"), F.coalesce(F.concat(F.lit("s"), df[group_col]), F.lit("-")).alias("place"),
                       digest.alias("digest"), F.when(tamper & count.isNotNull(), leaf_digest(*changed)).alias("changed"))
    leaves = stored(leaves.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    leaves = numbered(leaves, "place", ["doc_id", "digest", "tie"], "merkle-order").drop("tie")
    leaves = stored(_counted(leaves), "merkle-order")

    own = tiers(leaves, height, "merkle-tier")
    subroots = own[-1].select(F.col("place").alias("group"), F.col("digest"), F.lit("").alias("place"))
    subroots = stored(_counted(numbered(subroots, "place", ["group"], "merkle-groups")), "merkle-groups")
    upper = tiers(subroots, height, "merkle-tier")

    top = upper[-1].select("place", "pos", F.lit("").alias("suffix"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    top = suffixes(top, upper, 0, height, "merkle-suffix")
    tops = top.select("pos", "suffix", "root").join(subroots.select("pos", "group", F.col("digest").alias("subroot")), "pos") \
        .select(F.col("group").alias("place"), F.lit(0).cast("long").alias("pos"), "suffix", "subroot", "root")
    tops = suffixes(tops, own, 1, height, "merkle-suffix")

    def prove(block: pa.Table, above: pa.Table) -> pa.Table:
        block = _in_order(block)
        leaf = block["digest"].to_pylist()
        high = block_height(block["n"][0].as_py(), height)
        suffix, subroot, root = (above[c][0].as_py() for c in ("suffix", "subroot", "root"))
        proofs = reverse(forward(leaf, high), high, suffix)
        folded = [fold(d if c is None else c, p) for d, c, p in zip(leaf, block["changed"].to_pylist(), proofs, strict=True)]
        out = {"doc_id": block["doc_id"], "leaf": leaf, "subroot": [subroot] * len(leaf), "root": [root] * len(leaf),
               "proof_sha256": [digest_of(*[b for _, b in steps(p)]) for p in proofs],
               "folded_root": folded, "verified": [f == root for f in folded]}
        return pa.table(out | ({"proof": proofs} if with_proof else {}))

    schema = PROOFS.replace("doc_id long", f"doc_id {dict(df.dtypes)[id_col]}") + (", proof string" if with_proof else "")
    return _by_block(leaves, height).cogroup(tops.groupBy("place", "pos")).applyInArrow(prove, schema)
