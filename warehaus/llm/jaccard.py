"""N-gram Jaccard self-join with signature trees, returning linked classes.

1. *Sets.*  Every text becomes the set of its distinct word shingles, as
   64-bit hashes (one array pass per batch of texts).  Texts with equal sets
   share one ``key`` and are one representative from here on.

2. *Co-location.*  Sizes fall into classes; for a class the shingles are dealt
   over m segments by hash.  Two linked sets differ in at most H shingles (a
   bound of their class), so with m > H at least m - H segments are equal in
   both, and the hash of an equal segment is a signature of both.  A set emits
   the signatures of its non-empty segments, for its own class and those of
   sets it may be the larger partner of, with the number it *needs*: m - H less
   its empty segments (a set with fewer than one left emits these too).
   Signatures seen for one key only vanish; then the keys with fewer
   signatures left in a class than they need, as no linked pair can hold them.
   The others tie their keys into candidate classes, found by star edges and
   connected components.

3. *Signature tree.*  The sets of one candidate class meet in one task (a
   class of more than ``block`` sets in one task per pair of its blocks, the
   top level of the tree).  Leaves hold up to 32 sets; every node holds the
   OR of its members' token bitmaps, their size range and their largest number
   of colliding tokens.  A dual traversal from the root prunes node pairs whose
   sizes or whose largest possible overlap cannot reach the threshold, and
   pairs whose members are already connected.  What remains is compared
   exactly, set by set.

The result is exact: every link (intersection / union >= threshold, in integer
arithmetic) is either compared or implied by links already found.

Defined results: null and blank texts have an empty set, size 0, link with
nothing and are their own component; a null id is never a component while
another member has one; texts of any length are taken whole; repeated rows
link with each other unless empty; an empty table gives an empty result; other
columns are not looked at.  Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warehaus.llm.common import BITS_PER_BLOCK, bit_blocks, components, dealt, small_batches, stored
from warehaus.llm.exact_dedup import flagged, key_filter

WORDS = 5
PERCENT = 80
BLOCK = 4096
FILTER_BITS = 25  # of each filter that is sent to the tasks: 4 MB
U = np.uint64
BATCH_BYTES = 1 << 18


# ------------------------------------------------------------------ shingles

def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (shift, multiply, twice)."""
    x = (x ^ (x >> U(31))) * U(0x9E6C63D0876A9A47)
    x = (x ^ (x >> U(29))) * U(0xD1342543DE82EF95)
    return x ^ (x >> U(32))


BYTE = mixed(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
BASE = U(0x2545F4914F6CDD1D)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int, known: dict = {}) -> np.ndarray:  # noqa: B006
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; the usual batch length is kept."""
    if int(base) not in known or len(known[int(base)]) < n:
        made = np.full(n, base, U)
        made[:1] = 1
        made = np.cumprod(made, dtype=U)
        if n > 8 * BATCH_BYTES:
            return made
        known[int(base)] = made
    return known[int(base)][:n]


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each text and the end, hashes): sorted distinct shingles of each text."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begin = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(space & ~np.concatenate([[True], space[:-1]]))
    sums = np.concatenate([np.zeros(1, U), np.cumsum(BYTE[raw] * _powers(BASE, len(raw)), dtype=U)])
    word = mixed((sums[end] - sums[begin]) * _powers(BASE_INVERSE, len(raw))[begin])
    text = np.searchsorted(ends_at, begin, side="right")
    count = np.bincount(text, minlength=len(texts))
    rank = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
    total = np.zeros(len(word), U)
    size = np.minimum(count, words)[text]  # a short text is one shingle of all its words
    for j in range(words):
        here = np.zeros(len(word), U)
        here[:len(word) - j] = word[j:] * U(2 * j + 3) + mixed(word[j:] + U(j))
        total += np.where(j < size, here, U(0))
    whole = rank + size <= count[text]
    shingle, text = mixed(total + size.astype(U))[whole], text[whole]
    order = np.lexsort((shingle, text))
    shingle, text = shingle[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])
    shingle, text = shingle[new], text[new]
    return np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))]), shingle


def keys_of(at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One 64-bit key per set; the empty set's is 0."""
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mixed(hashes + U(1)), dtype=U)])
    n = np.diff(at)
    return np.where(n > 0, mixed(sums[at[1:]] - sums[at[:-1]] + n.astype(U)), U(0))


# ---------------------------------------------------------------- signatures

class Classes:
    """Size classes; for each: the least size, the largest difference H of a linked pair, and the segments m."""

    def __init__(self, percent: int):
        self.percent = percent
        lows, differing, parts = [], [], []
        low = 1
        while low < 1 << 40:
            high = low if low <= 3 else low * 13 // 10 - 1
            larger = high * 100 // percent  # the largest partner of a set in this class
            most = (100 - percent) * (high + larger) // (100 + percent)
            lows.append(low)
            differing.append(most)
            parts.append(most + 1 + (most + 4) // 5 if most else 0)  # none: only equal sets can link
            low = high + 1
        self.low, self.differing, self.parts = np.array(lows), np.array(differing), np.array(parts)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, size, side="right") - 1

    def signatures(self, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, signature, demand) of every signature of every set.

        ``demand`` holds the class (above bit 32) and the signatures that a
        linked pair has in common there, at least.
        """
        n = np.diff(at)
        text = np.repeat(np.arange(len(n)), n)
        last = self.of(np.maximum(n, 1))
        first = self.of(np.maximum((n * self.percent + 99) // 100, 1))
        out = [(np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64))]
        for step in range(int((last - first).max(initial=0)) + 1):
            kind = np.minimum(first + step, last)
            parts = np.where((first + step <= last) & (n > 0), self.parts[kind], 0)
            base = np.cumsum(parts) - parts
            used = parts[text] > 0
            t, h = text[used], hashes[used]
            scattered = mixed(h + U(0x5851F42D4C957F2D) * (kind[t].astype(U) + U(1)))
            slot = base[t] + ((scattered >> U(33)).astype(np.int64) % parts[t])
            total = int(parts.sum())
            # Sums of 32-bit halves stay exact in doubles.
            half = lambda x: np.bincount(slot, weights=x.astype(np.float64), minlength=total).astype(U)  # noqa: B023, E731
            held = np.bincount(slot, minlength=total)
            value = half(scattered & U(0xFFFFFFFF)) + (half(scattered >> U(32)) << U(32))
            owner = np.repeat(np.arange(len(n)), parts)
            part = (np.arange(total) - base[owner]).astype(U)
            need = (self.parts - self.differing)[kind] - np.bincount(owner, weights=held == 0, minlength=len(n)).astype(np.int64)
            keep = (held > 0) | (need < 1)[owner]
            sign = mixed(value + mixed(kind[owner].astype(U) * U(1 << 40) + part) * U(3) + held.astype(U))
            demand = (kind << 32) + np.maximum(need, 1)
            out.append((owner[keep], sign[keep], demand[owner][keep]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


# ------------------------------------------------------------ signature tree

LEAF, FAN, BITMAP = 32, 8, 1024


class Tree:
    """OR bitmaps, size ranges and collision counts over sets, leaves first."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        n = np.array([len(s) for s in sets])
        cells = np.zeros((len(sets), BITMAP), bool)
        for i, s in enumerate(sets):
            cells[i, (s % U(BITMAP)).astype(np.int64)] = True
        maps = np.packbits(cells, axis=1).view(U)
        spare = n - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        # Neighbours in this order are of like size and often share their least shingle.
        self.order = np.lexsort(([int(s[0]) for s in sets], n))
        self.levels = [(maps[self.order], n[self.order], n[self.order], spare[self.order])]
        while len(self.levels[-1][0]) > 1:
            cut = np.arange(0, len(self.levels[-1][0]), LEAF if len(self.levels) == 1 else FAN)
            m, lo, hi, sp = self.levels[-1]
            self.levels.append((np.bitwise_or.reduceat(m, cut), np.minimum.reduceat(lo, cut),
                                np.maximum.reduceat(hi, cut), np.maximum.reduceat(sp, cut)))

    def span(self, level: int, i: int) -> slice:
        width = LEAF * FAN ** (level - 1) if level else 1
        return slice(i * width, min((i + 1) * width, len(self.order)))


def possible(a: tuple, b: tuple, percent: int) -> np.ndarray:
    """Which pairs of nodes may hold a linked pair, by sizes and largest overlap."""
    (ma, la, ha, sa), (mb, lb, hb, sb) = a, b
    overlap = np.bitwise_count(ma[:, None] & mb[None]).sum(axis=2, dtype=np.int64) + np.minimum(sa[:, None], sb[None])
    overlap = np.minimum(overlap, np.minimum(ha[:, None], hb[None]))
    need = percent * (la[:, None] + lb[None])
    close = (100 * ha[:, None] >= percent * lb[None]) & (100 * hb[None] >= percent * la[:, None])
    return close & ((100 + percent) * overlap >= need)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def roots(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """For each set (of the left list, then the right) the number of a set it is connected with.

    Without ``right`` all pairs of ``left`` are in question, else the pairs across.
    """
    trees = [Tree(x) for x in ((left, right) if right is not None else (left,)) if x]
    if len(trees) < (1 if right is None else 2):
        return np.arange(len(left) + len(right or []))
    shift = [0, len(left)]
    places = [t.order + s for t, s in zip(trees, shift, strict=False)]
    root = np.arange(len(left) + len(right or []))

    def node(side: int, level: int, span: slice) -> tuple:
        return tuple(x[span] for x in trees[side].levels[level])

    def visit(i: int, j: int, x: int, y: int, other: int) -> None:
        """Node x of level i in the first tree against node y of level j in tree ``other``."""
        a, b = places[0][trees[0].span(i, x)], places[other][trees[other].span(j, y)]
        if i == 0 and j == 0:
            if root[a[0]] != root[b[0]] and linked(trees[0].sets[trees[0].order[x]], trees[other].sets[trees[other].order[y]], percent):
                old, new = root[b[0]], root[a[0]]
                root[root == old] = new
            return
        ra, rb = root[a], root[b]
        if (ra == ra[0]).all() and (rb == ra[0]).all():
            return
        down = lambda side, level, at: (level, slice(at, at + 1)) if level == 0 else (
            level - 1, slice(at * (f := LEAF if level == 1 else FAN), min((at + 1) * f, len(trees[side].levels[level - 1][0]))))
        (i2, xs), (j2, ys) = down(0, i, x), down(other, j, y)
        ok = possible(node(0, i2, xs), node(other, j2, ys), percent)
        for u, v in zip(*np.nonzero(ok), strict=True):
            u, v = int(u) + xs.start, int(v) + ys.start
            if other == 0 and i2 == j2 and v < u or other == 0 and i2 == j2 == 0 and u == v:
                continue
            visit(i2, j2, u, v, other)

    other = len(trees) - 1
    visit(len(trees[0].levels) - 1, len(trees[other].levels) - 1, 0, 0, other)
    return root


# --------------------------------------------------------------------- Spark

def _set_batches(batches: Iterator, words: int) -> Iterator:
    """Slices of Arrow batches of about 256 KB with their shingle sets; the text is the last column."""
    for batch in batches:
        col = batch.column(batch.num_columns - 1)
        start = 0
        while start < batch.num_rows:
            texts, size, stop = [], 0, start
            while stop < batch.num_rows and size < BATCH_BYTES:
                t = (col[stop].as_py() or "").encode("utf-8", "surrogatepass")
                texts.append(t)
                size += len(t) + 1
                stop += 1
            yield batch.slice(start, stop - start), *shingle_sets(texts, words)
            start = stop


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def row_mark(df: DataFrame, id_col: str, text_col: str) -> list:
    """96 hash bits of a row's id and text."""
    return [F.xxhash64(df[id_col], df[text_col]).alias("mark"), F.hash(df[text_col], df[id_col]).alias("mark_more")]


def keyed_rows(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, mark, mark_more, n_shingles, key) per row."""
    rows = df.select(df[id_col].alias("id"), *row_mark(df, id_col, text_col), df[text_col].alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for part, at, hashes in _set_batches(batches, words):
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i) for i in range(3)), pa.array(np.diff(at)), pa.array(_signed(keys_of(at, hashes)))],
                ["id", "mark", "mark_more", "n_shingles", "key"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, mark long, mark_more int, n_shingles long, key long")


def _among(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values a filter of bits may hold."""
    cell = (values % U(1 << FILTER_BITS)).astype(np.int64)
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1


def _filter_bits(values: DataFrame) -> np.ndarray:
    """Bits of the places of column ``v``, folded by Spark; at most 2 ** FILTER_BITS bits reach the driver."""
    cells = values.selectExpr(f"v & {(1 << FILTER_BITS) - 1}L as place") \
        .selectExpr(f"place div {BITS_PER_BLOCK} as block", f"place % {BITS_PER_BLOCK} as cell")
    held = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in bit_blocks(cells).collect():
        held[r["block"] * BITS_PER_BLOCK // 8:(r["block"] + 1) * BITS_PER_BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
    return held


class Speakers:
    """Says which rows speak for their set: of equal sets, the first; by two filters, so a few copies may speak too."""

    def __init__(self, repeated: DataFrame):
        self.keys = _filter_bits(repeated.select(F.col("key").alias("v")))
        self.marks = _filter_bits(repeated.select(F.col("first.mark").alias("v")))

    def of(self, key: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return ~_among(self.keys, key) | _among(self.marks, mark)


def _spoken_sets(df: DataFrame, id_col: str, text_col: str, words: int, speakers: Speakers, only: np.ndarray | None, build, schema: str) -> DataFrame:
    """Rows that ``build(at, hashes, keys)`` makes of the sets of the speaking rows (with ``only``: of keys it may hold)."""
    rows = df.select(row_mark(df, id_col, text_col)[0], df[text_col].alias("text"))
    sent = df.sparkSession.sparkContext.broadcast((speakers, only))

    def run(batches: Iterator) -> Iterator:
        who, wanted = sent.value
        for part, at, hashes in _set_batches(batches, words):
            key = keys_of(at, hashes)
            want = who.of(key, part.column(0).to_numpy(zero_copy_only=False).view(U)) & (np.diff(at) > 0)
            if wanted is not None:
                want &= _among(wanted, key)
            if want.any():
                take = np.repeat(want, np.diff(at))
                yield build(np.concatenate([[0], np.cumsum(np.diff(at)[want])]), hashes[take], key[want])

    return rows.mapInArrow(run, schema)


def signature_rows(df: DataFrame, id_col: str, text_col: str, words: int, percent: int, speakers: Speakers) -> DataFrame:
    """(signature, key, demand): one row per signature of every different set."""
    def build(at: np.ndarray, hashes: np.ndarray, key: np.ndarray):
        import pyarrow as pa
        owner, sign, demand = Classes(percent).signatures(at, hashes)
        return pa.RecordBatch.from_arrays([pa.array(_signed(sign)), pa.array(_signed(key[owner])), pa.array(demand)],
                                          ["signature", "key", "demand"])

    return _spoken_sets(df, id_col, text_col, words, speakers, None, build, "signature long, key long, demand long")


def needed_sets(df: DataFrame, id_col: str, text_col: str, words: int, speakers: Speakers, keys: DataFrame) -> DataFrame:
    """(key, shingles) of the different sets whose key is among ``keys`` (and a few others)."""
    def build(at: np.ndarray, hashes: np.ndarray, key: np.ndarray):
        import pyarrow as pa
        sets = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(_signed(hashes)))
        return pa.RecordBatch.from_arrays([pa.array(_signed(key)), sets], ["key", "shingles"])

    only = _filter_bits(keys.select(F.col("key").alias("v")))
    return _spoken_sets(df, id_col, text_col, words, speakers, only, build, "key long, shingles array<long>")


def _shared(signatures: DataFrame) -> DataFrame:
    """Rows whose signature several keys have, with the smallest of them as ``u``."""
    same = Window.partitionBy("signature")
    return signatures.withColumns({"u": F.min("key").over(same), "top": F.max("key").over(same)}).where("u < top").drop("top")


def candidate_edges(signatures: DataFrame) -> DataFrame:
    """Star edges (u, v) among the keys that have as many shared signatures as a linked pair needs."""
    held = stored(_shared(signatures), "jaccard-shared")
    mine = Window.partitionBy("key", "demand")  # at most as many rows as the class has segments
    enough = held.withColumn("n", F.count("*").over(mine)).where("n >= (demand & 4294967295)")
    return _shared(enough.select("signature", "key")).where("key <> u").select("u", F.col("key").alias("v")).distinct()


def _tree_links(percent: int):
    """Groups of sorted rows (comp, first, second, side, key, shingles) to edges (u, v)."""
    def group(rows: list) -> list[tuple[int, int]]:
        across = rows[0][1] != rows[0][2]
        left = [r for r in rows if r[3] == 0]
        right = [r for r in rows if r[3] == 1] if across else None
        keys = [r[4] for r in left + (right or [])]
        found = roots([r[5] for r in left], [r[5] for r in right] if across else None, percent)
        return [(keys[i], keys[r]) for i, r in enumerate(found) if r != i]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        held, now = [], None

        def out() -> Iterator:
            edges = group(held) if len(held) > 1 else []
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in edges], pa.int64()),
                                                  pa.array([v for _, v in edges], pa.int64())], ["u", "v"])

        for batch in batches:
            ids = [batch.column(i).to_pylist() for i in range(5)]
            col = batch.column(5)
            flat, ends = col.flatten().to_numpy(zero_copy_only=False).view(U), np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())])
            for k, row in enumerate(zip(*ids, strict=True)):
                if row[:3] != now:
                    yield from out()
                    held, now = [], row[:3]
                held.append((*row, flat[ends[k]:ends[k + 1]]))
        yield from out()

    return run


def _classed_rows(df: DataFrame, id_col: str, text_col: str, words: int, percent: int, block: int) -> DataFrame:
    """(id, mark, mark_more, n_shingles, key, comp, component_id) per row; the last two are null for empty sets.

    ``comp`` names the component (several components may share a smallest id).

    The texts are read three times: for keys, for signatures and for the sets of the candidates.
    Only filters of bounded size pass through the driver; no join is by a broadcast.
    """
    small_batches(df.sparkSession)
    rows = stored(keyed_rows(df, id_col, text_col, words), "jaccard-rows")
    least = rows.where("n_shingles > 0").groupBy("key").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.min(F.struct(F.col("id").isNull(), "id", "mark")).alias("first"))
    speakers = Speakers(least.where("copies > 1"))
    least = least.select("key", "id")
    ties = candidate_edges(signature_rows(df, id_col, text_col, words, percent, speakers))
    candidates = stored(components(ties, "jaccard-classes").select(F.col("node").alias("key"), "comp"), "jaccard-candidates")
    size = candidates.groupBy("comp").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = candidates.join(dealt(size), "comp").withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    placed = placed.select("comp", "key", "mine", other).select(
        "comp", F.least("mine", "other").alias("first"), F.greatest("mine", "other").alias("second"),
        F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"), "key")
    sets = needed_sets(df, id_col, text_col, words, speakers, candidates).groupBy("key").agg(F.first("shingles").alias("shingles"))
    meet = placed.join(dealt(sets), "key").select("comp", "first", "second", "side", "key", "shingles") \
        .repartition("comp", "first", "second").sortWithinPartitions("comp", "first", "second", "side", "key")
    edges = stored(meet.mapInArrow(_tree_links(percent), "u long, v long"), "jaccard-edges")
    classes = components(edges, "jaccard-links").withColumnRenamed("node", "key")
    least = least.join(dealt(classes), "key", "left").select("key", "id", F.coalesce("comp", "key").alias("comp"))
    named = least.groupBy("comp").agg(F.min("id").alias("component_id")).join(dealt(least.select("key", "comp")), "comp")
    named = named.select("key", "comp", "component_id")
    return rows.select("id", "mark", "mark_more", "n_shingles", "key").join(dealt(named), "key", "left")


def join_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    rows = _classed_rows(df, id_col, text_col, words, percent, block)
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def drop_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
              percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """The rows of ``df`` without near duplicates: of every component the row with the smallest id stays.

    Rows with an empty set all stay; rows equal in id and text stay or go
    together; components that have their smallest id in common stay apart.  A
    broadcast filter of bounded size finds the rows that may go; only these are
    shuffled, the others pass straight through.
    """
    rows = stored(_classed_rows(df, id_col, text_col, words, percent, block).where("n_shingles > 0"), "near-rows")
    rows = rows.withColumn("place", F.struct(F.col("id").isNull().alias("last"), "id", "mark", "mark_more"))
    stays = rows.groupBy("comp").agg(F.min("place").alias("least"), F.max("place").alias("most")).where("least <> most")
    gone = stored(rows.join(dealt(stays), "comp").where("place <> least").select("mark", "mark_more").distinct(), "near-gone")
    wide = df.select(F.struct("*").alias("whole"), *row_mark(df, id_col, text_col))
    bits, blocks = key_filter(gone.select(F.col("mark").alias("h")), gone.count())
    seen = flagged(wide.withColumnRenamed("mark", "h"), stored(bits, "near-bits"), blocks).withColumnRenamed("h", "mark")
    left = seen.where("maybe").join(dealt(gone), ["mark", "mark_more"], "left_anti")
    return seen.where(~F.col("maybe")).select("whole").unionByName(left.select("whole")).select("whole.*")
