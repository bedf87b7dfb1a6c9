"""Approximate nearest neighbours by low-dimensional stable projections.

Largest inner product becomes smallest Euclidean distance by one more
coordinate, sqrt(M^2 - |x|^2) for rows (M: the largest norm) and 0 for
queries.  Rows are projected with ``dims`` Gaussian vectors; for two points
the squared projected distance over the squared true distance then follows a
chi-square law with ``dims`` degrees of freedom.

The rows are dealt by hash into buckets of about ``bucket_rows`` and each
bucket's projections are indexed by a kd-tree.  A query takes the tree's
leaves by growing distance of their boxes, verifies every row of a leaf by its
inner product, and stops when the chi-square test holds: a row nearer
than the k-th found so far would have a projected distance below the next
box's with probability ``sure``.  The best of all buckets are merged.

Every row is indexed and no bucket, leaf or candidate list is capped; ``sure``
alone decides the recall (about its value or better).

Scale: a (bucket, group of queries) pair is one bounded task (2 x 8,192 rows);
the rows of a bucket are sent once per ``query_rows`` queries.

Defined results: vectors that are null, zero, of another length than most, or
hold a null or non-finite component take no part; every query row is a query
of its own, also when ids repeat, and is excluded as its own candidate only;
a null id never makes a query and comes last among ties; with fewer candidates
than k all are returned; other columns play no part, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warehaus.llm.common import stored

DIMS = 8  # even, so that the chi-square law has a closed form
SURE = 0.95
BUCKET_ROWS = 8192
QUERY_ROWS = 8192
LEAF_ROWS = 64
STEP_LEAVES = 8
ROUNDING = 1e-15  # bounds the difference of two summation orders, for each component and unit of length
SEED = 11
FOUND = "query_row long, query_id long, row long, has_id boolean, vec_id long, score double"


def chi_square_cdf(x: float, dims: int) -> float:
    """P(chi-square with an even number of degrees of freedom <= x)."""
    half, term, total = x / 2, 1.0, 1.0
    if half > 700:
        return 1.0
    for i in range(1, dims // 2):
        term *= half / i
        total += term
    return 1.0 - math.exp(-half) * total


def stop_ratio(dims: int, sure: float) -> float:
    """The least squared-distance ratio at which the test holds (the law's quantile)."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (low, mid) if chi_square_cdf(mid, dims) >= sure else (mid, high)
    return high


class KdTree:
    """Points in leaf order with each leaf's box; halves by the widest coordinate."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF_ROWS):
        order, cuts, work = np.arange(len(points)), [], [(0, len(points))]
        while work:
            a, b = work.pop()
            if b - a <= leaf:
                cuts.append((a, b))
                continue
            part = points[order[a:b]]
            axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, axis], mid)]
            work += [(a, a + mid), (a + mid, b)]
        self.order, self.cuts = order, sorted(cuts)
        self.low = np.array([points[order[a:b]].min(axis=0) for a, b in self.cuts])
        self.high = np.array([points[order[a:b]].max(axis=0) for a, b in self.cuts])

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Squared distance from a query to every leaf's box."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0.0)
        return np.einsum("ij,ij->i", gap, gap)


def projection(width: int, dims: int, seed: int = SEED) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((width + 1, dims))


def exact_scores(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products, each summed over the components in the same order wherever its row stands."""
    total = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        total += rows[:, j] * q[j]
    return total


def search_bucket(rows: np.ndarray, queries: np.ndarray, own: np.ndarray, top_norm: float, k: int, dims: int,
                  ratio: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, inner products) of the candidates worth merging, for each query.

    ``own`` is the place of the query itself among the rows, or -1.
    """
    plane = projection(rows.shape[1], dims)
    norms = np.einsum("ij,ij->i", rows, rows)
    flat = rows @ plane[:-1] + np.sqrt(np.maximum(top_norm - norms, 0.0))[:, None] * plane[-1]
    tree = KdTree(flat)
    laid = rows[tree.order]
    place = np.empty(len(rows), np.int64)
    place[tree.order] = np.arange(len(rows))
    out = []
    for q, f, mine in zip(queries, queries @ plane[:-1], own, strict=True):
        bounds = tree.bounds(f)
        near = np.argsort(bounds, kind="stable")
        base = top_norm + q @ q  # distance^2 = base - 2 * inner product
        got_at, got, best = [], [], np.empty(0)
        for step in range(0, len(near), STEP_LEAVES):
            if len(best) >= k and bounds[near[step]] >= ratio * (base - 2 * best[0]):
                break
            at = np.concatenate([np.arange(*tree.cuts[x]) for x in near[step:step + STEP_LEAVES]])
            if mine >= 0:
                at = at[at != place[mine]]
            score = laid[at] @ q
            got_at.append(at)
            got.append(score)
            best = np.concatenate([best, score])
            best = np.sort(best)[-k:] if len(best) > k else np.sort(best)
        at, score = (np.concatenate(x) if x else np.empty(0) for x in (got_at, got))
        slack = ROUNDING * len(q) * math.sqrt(max(top_norm * (q @ q), 0.0))
        at = at[score >= best[0] - slack].astype(np.int64) if len(best) else np.zeros(0, np.int64)
        out.append((tree.order[at], exact_scores(laid[at], q)))
    return out


def search(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
           dims: int = DIMS, sure: float = SURE, bucket_rows: int = BUCKET_ROWS,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows found nearest to each query row."""
    v = df[vector_col]
    rows = df.select(df[id_col].cast("long").alias("vec_id"), v.cast("array<double>").alias("v"),
                     F.coalesce(is_query, F.lit(False)).alias("asks"))
    usable = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) \
        & F.exists("v", lambda x: x != 0)
    rows = rows.where(usable)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    width = common["n"] if common else 1
    rows = rows.where(F.size("v") == width).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), "ann-rows")
    size = rows.agg(F.count("*").alias("n"), F.max("norm").alias("top"),
                    F.count(F.when(F.col("asks"), 1)).alias("queries")).first()
    buckets, groups = math.ceil(size["n"] / bucket_rows) or 1, math.ceil(size["queries"] / query_rows) or 1
    top, ratio = size["top"] or 0.0, stop_ratio(dims, sure)
    place = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = rows.select("vec_id", "v", "row", place(buckets, 1).alias("bucket"), every(groups).alias("group"))
    asked = rows.where("asks").select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("row").alias("query_row"),
        place(groups, 2).alias("group"), every(buckets).alias("bucket"))

    def meet(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(ours) or not len(theirs):
            return pd.DataFrame({c: [] for c in ("query_row", "query_id", "row", "has_id", "vec_id", "score")}).astype(
                {"query_row": "int64", "query_id": "int64", "row": "int64", "has_id": bool, "vec_id": "int64", "score": float})
        ours = ours.sort_values("row", ignore_index=True)
        number = ours["row"].to_numpy()
        has = ours["vec_id"].notna().to_numpy()
        ids = ours["vec_id"].fillna(0).to_numpy().astype(np.int64)
        asking = theirs["query_row"].to_numpy()
        at = np.minimum(np.searchsorted(number, asking), len(number) - 1)
        found = search_bucket(np.stack(ours["v"].to_numpy()), np.stack(theirs["q"].to_numpy()),
                              np.where(number[at] == asking, at, -1), top, k, dims, ratio)
        many = [len(x) for x, _ in found]
        where = np.concatenate([x for x, _ in found])
        return pd.DataFrame({
            "query_row": np.repeat(asking, many), "query_id": np.repeat(theirs["query_id"].to_numpy().astype(np.int64), many),
            "row": number[where], "has_id": has[where], "vec_id": ids[where],
            "score": np.concatenate([x for _, x in found])})

    found = held.groupBy("bucket", "group").cogroup(asked.groupBy("bucket", "group")).applyInPandas(meet, FOUND)
    found = found.withColumn("vec_id", F.when(F.col("has_id"), F.col("vec_id")))
    by = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
