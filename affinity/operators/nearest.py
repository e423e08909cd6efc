"""Running lists of the best partners of a block of rows.

A task holds a block of rows and reads the partners' rows as a stream, batch by batch: per row it
keeps the ``k`` best so far, by score (descending), then partner id.  So a row's list leaves the
task once, whole and ranked; neither the partners' rows nor candidates are ever gathered, and a
task's memory is that of its block (rows, lists) and one product of ``PART`` rows by ``chunk`` partners.

A stream is a sorted partition of rows (key, side, cluster, ...): the block's rows
(``LEFT``), the pivots of its category with their clusters' radii and sizes (``PIVOT``, where it is clustered), then
partners: those of the block's clusters that only their own rows, and rows of clusters too small to
fill a list, have to meet (``HOME``), its other clusters (``NEAR``), and those of other blocks (``AWAY``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEFT, PIVOT, HOME, NEAR, AWAY = range(5)
STREAM = ("key", "side", "cluster", "product_id", "row_id", "cat_path", "radius", "size", "vec")
LISTS = "row_id long, product_id long, cat_path string, other_id long, score double, rank int"
REACH = "key string, cluster int, side int, guests long"
#: Rows of a block multiplied at a time.
PART = 1024
#: Scores as integers: cosine * SCALE, shifted to be positive.
_SCALE = 100_000
_SHIFT = _SCALE + 1
#: Bits of a partner id beside the score in one sortable integer.
_ID_BITS = 45
_ID_MASK = (1 << _ID_BITS) - 1
#: Below a rounded score, what may still round to it.
_NEAR = 0.5 / _SCALE + 1e-9
#: Added to every angle's bound: more than the error of angles and of arccos near 1.
MARGIN = 1e-5


def round5(x: np.ndarray) -> np.ndarray:
    """Round half away from zero to 5 places (as ``functions.round_half_away``)."""
    return np.sign(x) * np.floor(np.abs(x) * 1e5 + 0.5) / 1e5


def unit_rows(vec: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have a direction, their unit vectors); zero or non-finite vectors have none."""
    size = pa.compute.list_value_length(vec).to_numpy(zero_copy_only=False)
    if not len(size) or not size[0]:
        return np.zeros(0, np.int64), np.zeros((0, 0))
    if (size != size[0]).any():
        raise ValueError("vectors of a category differ in length")
    m = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(size), -1)
    norm = np.linalg.norm(m, axis=1)
    ok = np.flatnonzero(np.isfinite(norm) & (norm > 0))
    return ok, m[ok] / norm[ok, None]


def _best(score: np.ndarray, other: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row of (score, other), in order; a score of -1 is an empty place."""
    full = score >= 0
    ids = other[full]
    low = int(ids.min()) if len(ids) else 0
    if len(ids) and int(ids.max()) - low > _ID_MASK:                 # ids too far apart: their ranks
        values, rank = np.unique(other, return_inverse=True)
        rank = rank.reshape(other.shape)
    else:
        values, rank = None, other - low
    code = np.where(full, (score.astype(np.int64) << _ID_BITS) | (_ID_MASK - rank), -1)
    if code.shape[1] > k:
        code = np.partition(code, code.shape[1] - k, axis=1)[:, -k:]
    code = -np.sort(-code, axis=1)
    rank = np.where(code >= 0, _ID_MASK - (code & _ID_MASK), 0)
    return np.where(code >= 0, code >> _ID_BITS, -1).astype(np.int32), values[rank] if values is not None else rank + low


class Block:
    """The rows of a block and their k best partners so far."""

    def __init__(self, rows: pa.Table, k: int, chunk: int):
        rows = rows.combine_chunks()
        ok, self.m = unit_rows(_column(rows, "vec"))
        self.rows = rows.drop_columns(["vec"]).take(pa.array(ok))
        self.id = _column(self.rows, "product_id").to_numpy()
        self.k, self.chunk, n = k, chunk, len(ok)
        self.score, self.other = np.full((n, k), -1, np.int32), np.zeros((n, k), np.int64)
        self.low, self.last = np.full(n, -1, np.int64), np.zeros(n, np.int64)     # score and id in the last place
        self.floor = np.full(n, -np.inf)                                         # what a score must reach
        self.seen, self.bound, self.clusters, self.own, self.small, self.home = 0, None, None, None, None, None
        self.waiting: list[list] = [[] for _ in range(0, n, PART)]
        self.width, self.held = [0] * len(self.waiting), [0] * len(self.waiting)

    def pivots(self, rows: pa.Table) -> None:
        """Bounds of every row's scores with the rows of each cluster."""
        rows = rows.combine_chunks()
        self.clusters = _column(rows, "cluster").to_numpy()
        radius = _column(rows, "radius").to_numpy()
        p = unit_rows(_column(rows, "vec"))[1].T
        self.bound = np.empty((len(self.id), len(radius)), np.float32)
        for s in range(0, len(self.id), PART):
            angle = np.arccos(np.clip(self.m[s:s + PART] @ p, -1, 1)) - radius - MARGIN
            self.bound[s:s + PART] = np.cos(np.maximum(0, angle)) + 1e-6
        self.own = np.searchsorted(self.clusters, _column(self.rows, "cluster").to_numpy())
        # a row may be its own cluster's, so a cluster of k rows leaves a place empty
        self.small = (_column(rows, "size").to_numpy() <= self.k)[self.own]
        self.home = np.zeros(len(self.clusters), bool)
        self.home[self.own] = True

    def meet(self, b: pa.RecordBatch, side: int = AWAY) -> None:
        """Partners; rows whose bound does not reach their k-th score are left out."""
        ok, m = unit_rows(b.column("vec"))
        ids, s, edge = b.column("product_id").to_numpy()[ok], 0, [len(ok)]
        if self.bound is not None:                                               # one cluster at a time
            at = np.searchsorted(self.clusters, b.column("cluster").to_numpy()[ok])
            edge = [*(np.flatnonzero(np.diff(at)) + 1), len(ok)]
        for end in edge:
            while s < end:
                e = min(end, s + min(self.chunk, max(self.k, self.seen)))
                for part in range(len(self.waiting)):
                    self._multiply(part, m[s:e], ids[s:e], None if self.bound is None else int(at[s]), side)
                self.seen += e - s
                s = e

    def _multiply(self, part: int, m: np.ndarray, ids: np.ndarray, at: int | None, side: int) -> None:
        lo, hi = part * PART, min((part + 1) * PART, len(self.id))
        # partners of larger ids than the last place's need a better score than its
        floor = self.floor[lo:hi] + np.where(self.last[lo:hi] <= ids.min(), 1 / _SCALE, 0)
        act = np.arange(lo, hi)
        if at is not None:
            ok = self.bound[lo:hi, at] >= floor
            if side == HOME:
                ok &= (self.own[lo:hi] == at) | self.small[lo:hi]
            act = act[ok]
            if not len(act):
                return
        s = self.m[act] @ m.T
        x, y = np.nonzero(s >= floor[act - lo, None])
        q = np.rint(round5(s[x, y]) * _SCALE).astype(np.int32) + _SHIFT
        x, other = act[x], ids[y]
        keep = (other != self.id[x]) & ((q > self.low[x]) | ((q == self.low[x]) & (other < self.last[x])))
        self.waiting[part].append((x[keep] - lo, q[keep], other[keep]))
        self.width[part] += len(ids)
        self.held[part] += int(keep.sum())
        if self.held[part] > PART * self.k // 2 or self.width[part] >= 4 * max(self.chunk, PART):
            self._merge(part)

    def _merge(self, part: int) -> None:
        lo, hi = part * PART, min((part + 1) * PART, len(self.id))
        if self.held[part]:
            x, q, other = (np.concatenate(c) for c in zip(*self.waiting[part], strict=True))
            order = np.argsort(x, kind="stable")
            x, q, other = x[order], q[order], other[order]
            count = np.bincount(x, minlength=hi - lo)
            place = self.k + np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
            score = np.full((hi - lo, self.k + count.max()), -1, np.int32)
            ids = np.zeros(score.shape, np.int64)
            score[:, :self.k], ids[:, :self.k] = self.score[lo:hi], self.other[lo:hi]
            score[x, place], ids[x, place] = q, other
            self.score[lo:hi], self.other[lo:hi] = _best(score, ids, self.k)
            low = self.score[lo:hi, -1].astype(np.int64)
            self.low[lo:hi], self.last[lo:hi] = low, self.other[lo:hi, -1]
            self.floor[lo:hi] = np.where(low < 0, -np.inf, (low - _SHIFT) / _SCALE - _NEAR)
        self.waiting[part], self.width[part], self.held[part] = [], 0, 0

    def lists(self) -> Iterator[pa.RecordBatch]:
        """The rows' lists, a part at a time."""
        for part in range(len(self.waiting)):
            self._merge(part)
            lo = part * PART
            score, other = self.score[lo:lo + PART], self.other[lo:lo + PART]
            x, rank = np.nonzero(score >= 0)
            own = pa.array(x + lo)
            yield pa.RecordBatch.from_arrays(
                [*[_column(self.rows, c).take(own) for c in ("row_id", "product_id", "cat_path")],
                 pa.array(other[x, rank]), pa.array((score[x, rank] - _SHIFT) / _SCALE), pa.array(rank + 1, pa.int32())],
                ["row_id", "product_id", "cat_path", "other_id", "score", "rank"])

    def reach(self) -> Iterator[pa.RecordBatch]:
        """The block's clusters, and those that may hold partners better than the k-th so far of a row that
        has not met them, with the number of such rows."""
        key = self.rows.column("key")[0].as_py()
        away = np.zeros(len(self.clusters), np.int64)
        for part in range(len(self.waiting)):
            self._merge(part)
            lo, hi = part * PART, min((part + 1) * PART, len(self.id))
            want = self.bound[lo:hi] >= self.floor[lo:hi, None]
            want[self.small[lo:hi, None] & self.home] = False
            want[np.arange(hi - lo), self.own[lo:hi]] = False
            away += want.sum(axis=0)
        met = np.where(self.home, np.bincount(self.own[~self.small], minlength=len(away)) + self.small.sum(), 0)
        side = np.where(~self.home, AWAY, np.where(away > 0, NEAR, HOME))
        got = np.flatnonzero(met + away)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key] * len(got), pa.string()), pa.array(self.clusters[got], pa.int32()),
             pa.array(side[got], pa.int32()), pa.array((met + away)[got], pa.int64())],
            ["key", "cluster", "side", "guests"])


def _column(t: pa.Table, name: str) -> pa.Array:
    c = t.column(name).combine_chunks()
    return pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c


def _blocks(batches, k: int, chunk: int) -> Iterator[Block]:
    """The blocks of a sorted stream, each when all its partners have been met."""
    block, key, rows = None, None, {LEFT: [], PIVOT: []}
    for b in batches:
        names, side = b.column("key").dictionary_encode(), b.column("side").to_numpy()
        code = names.indices.to_numpy()
        edge = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (side[1:] != side[:-1])]) if len(code) else []
        for s, e in zip(edge, [*edge[1:], len(code)], strict=True):
            name, piece = names.dictionary[int(code[s])].as_py(), b.slice(s, e - s)
            if name != key:
                if block is not None:
                    yield block
                block, key, rows = None, name, {LEFT: [], PIVOT: []}
            if side[s] in rows:
                rows[side[s]].append(piece)
                continue
            if block is None and rows[LEFT]:
                block = Block(pa.Table.from_batches(rows[LEFT]), k, chunk)
                if rows[PIVOT]:
                    block.pivots(pa.Table.from_batches(rows[PIVOT]))
                rows = {LEFT: [], PIVOT: []}
            if block is not None and len(block.id):
                block.meet(piece, int(side[s]))
    if block is not None:
        yield block


def stream(rows: DataFrame, side: int | Column, key: Column) -> DataFrame:
    """Rows as one side of a stream; ``cluster`` and ``radius`` are null where they do not apply."""
    have = {**{c: F.lit(None) for c in STREAM}, **{c: F.col(c) for c in rows.columns}, "key": key,
            "side": F.lit(side) if isinstance(side, int) else side}
    kinds = {"key": "string", "side": "int", "cluster": "int", "radius": "double", "vec": "array<double>",
             "cat_path": "string"}
    return rows.select(*[have[c].cast(kinds.get(c, "bigint")).alias(c) for c in STREAM])


def _sorted(sides: list[DataFrame], tasks: int) -> DataFrame:
    rows = sides[0]
    for s in sides[1:]:
        rows = rows.unionByName(s)
    return rows.repartition(tasks, "key").sortWithinPartitions("key", "side", "cluster", "product_id")


def lists(sides: list[DataFrame], tasks: int, k: int, chunk: int) -> DataFrame:
    """Every left row's k best partners, ranked."""
    def run(batches):
        for block in _blocks(batches, k, chunk):
            yield from block.lists()
    return _sorted(sides, tasks).mapInArrow(run, LISTS)


def reach(sides: list[DataFrame], tasks: int, k: int, chunk: int) -> DataFrame:
    """(key, cluster, side, guests): the clusters each block has to meet, after those it met."""
    def run(batches):
        for block in _blocks(batches, k, chunk):
            if len(block.id):
                yield from block.reach()
    return _sorted(sides, tasks).mapInArrow(run, REACH)
