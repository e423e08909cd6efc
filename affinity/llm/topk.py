"""Exact top-k inner products by no-random-access aggregation (NRA).

Every dimension of a block of vectors is a list sorted by value.  A query
reads its lists sequentially, from the large end where its weight is positive
and from the small end where it is negative.  What it has read of a vector
gives a partial score; the values not yet read lie between the list's last
read value and its far end, which gives an upper and a lower bound.  A query
stops reading a block when the vectors whose upper bound reaches its k-th
best lower bound are few; their final scores are then resolved exactly.

Scale: vectors are hashed into blocks of a bounded number of rows and queries
into blocks too; each (query block, vector block) pair is one group, so no
task holds more than two blocks.  Each group returns at most k rows a query,
and the final ranking starts with Spark's per-partition group limit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_count, saved

BLOCK_ROWS = 8192
QUERY_ROWS = 1024
#: Parts of every list read before bounds are compared.
DEPTHS = (0.25, 0.5)


def usable(df: DataFrame, id_col: str, vec_col: str, factor: int) -> DataFrame:
    """(vec_id, v) with v = floor(factor * x) as integers; unusable vectors go.

    A vector that is null, or holds a null or non-finite component, takes no
    part; nor does a row without an id, which no result could name.
    """
    x = F.col(vec_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double"))
                   | (F.abs(e.cast("double")) == F.lit(float("inf"))))
    return (df.where(F.col(id_col).isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(x, lambda e: F.floor(e.cast("double") * factor).cast("long")).alias("v")))


def _matrix(col, d: int) -> np.ndarray:
    m = np.zeros((len(col), d), np.int64)
    for i, v in enumerate(col):
        m[i, :len(v)] = v
    return m


def nra_block(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int,
              depths=DEPTHS) -> list[tuple[int, int, int]]:
    """(query id, vec id, score) of each query's k best rows of one block."""
    n, d = x.shape
    out: list[tuple[int, int, int]] = []
    if n == 0 or len(q) == 0:
        return out
    # float64 products are exact below 2**53; larger values stay integers
    top = int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(d, 1)
    kind = np.float64 if top < 1 << 53 else object

    def resolve(j: int, rows: np.ndarray) -> None:
        s = x[rows].astype(kind) @ q[j].astype(kind) if d else np.zeros(len(rows))
        rows, s = rows[ids[rows] != qids[j]], s[ids[rows] != qids[j]]
        best = sorted(zip((-s).tolist(), ids[rows].tolist()))[:k]
        out.extend((int(qids[j]), int(i), int(-v)) for v, i in best)

    todo = np.arange(len(q))
    if kind is np.float64 and n > 8 * k and d:
        xf = x.astype(np.float64)
        order = np.argsort(xf, axis=0, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
        lists = np.take_along_axis(xf, order, axis=0)      # ascending lists
        for part in depths:
            if not len(todo):
                break
            read = max(1, int(n * part))
            seen_hi, seen_lo = rank >= n - read, rank < read
            qp, qn = np.maximum(q[todo], 0).astype(float), np.minimum(q[todo], 0).astype(float)
            known = np.where(seen_hi, xf, 0) @ qp.T + np.where(seen_lo, xf, 0) @ qn.T
            miss_hi, miss_lo = (~seen_hi).astype(float), (~seen_lo).astype(float)
            upper = known + miss_hi @ (qp * lists[n - read]).T + miss_lo @ (qn * lists[read - 1]).T
            lower = known + miss_hi @ (qp * lists[0]).T + miss_lo @ (qn * lists[-1]).T
            own = ids[:, None] == qids[todo][None, :]
            lower[own], upper[own] = -np.inf, -np.inf
            kth = np.partition(lower, n - k, axis=0)[n - k]
            alive = upper >= kth
            few = alive.sum(axis=0) <= max(4 * k, n // 8)
            for c in np.flatnonzero(few):
                resolve(todo[c], np.flatnonzero(alive[:, c]))
            todo = todo[~few]
    for j in todo:                                           # the lists read to their ends
        resolve(j, np.arange(n))
    return out


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
               vec_col: str = "embedding", factor: int = 1024,
               block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products.

    ``queries`` and ``vectors`` have an id and a vector column; other columns
    are ignored.  Components become floor(factor * x), so scores are integers
    and exact.  A query never meets rows with its own id; equal queries are
    one; repeated vectors are candidates each.  Ties go to the smaller id; fewer than k candidates give fewer rows; empty tables give no
    rows.  A vector shorter than another counts as padded with zeros.
    """
    v = saved(usable(vectors, id_col, vec_col, factor), "topk_vectors")
    q = saved(usable(queries, id_col, vec_col, factor).distinct(), "topk_queries")
    nb = bucket_count(v.count(), block_rows)
    nq = bucket_count(q.count(), query_rows)
    qb = F.pmod(F.xxhash64("vec_id", "v"), F.lit(nq)).cast("int")
    # by row, so that repeated rows do not share a block
    vb = F.pmod(F.xxhash64("v", "vec_id", F.monotonically_increasing_id()), F.lit(nb)).cast("int")
    # the stated query set meets all rows block by block
    left = v.select(vb.alias("vb"), F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb"),
                    "vec_id", "v")
    right = q.select(F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("vb"), qb.alias("qb"),
                     "vec_id", "v")

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        d = max([len(x) for x in a["v"]] + [len(x) for x in b["v"]], default=0)
        rows = nra_block(a["vec_id"].to_numpy(np.int64), _matrix(a["v"], d),
                         b["vec_id"].to_numpy(np.int64), _matrix(b["v"], d), k)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = (left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb"))
             .applyInPandas(search, "query_id long, vec_id long, score long"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
