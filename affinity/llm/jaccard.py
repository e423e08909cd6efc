"""N-gram Jaccard join by grouped prefixes.

A document is its set of distinct word shingles.  Two sets of similarity t
share at least one shingle among the first ``n - ceil(t * n) + 1`` of each
under any common order (the prefix).  Shingles are ordered by how often they
occur, rarest first, so frequent lines and passages sit outside prefixes.

1. A fixed-size count sketch over the shingles of all documents gives the
   order (it ranks only; results do not depend on it).
2. One scan gives every document its class (hash of the set), its group
   (equal prefix and size), its prefix and its compressed text.
3. Groups are joined on prefix shingles; a shingle of one group is dropped.
   In a few turns every group is paired with pivot groups of its runs (size
   and position filters), the pairs are expanded to members, verified on
   whole texts, and merged to components.  Runs inside one component are done.
4. Runs and groups that still span several components are joined
   exhaustively, without the pairs inside a component; verified; merged.
   Nothing is capped: the pivots only save work, since a link between
   components that are still different is always tested here.

5. Links are counted inside the components, where all of them lie: a large
   component in blocks of classes, every pair of blocks one task that
   multiplies 0/1 matrices of shingles, so no pair is ever a row.

Exact copies are one class and equal prefixes one group, and a mass of near
copies closes in the turns, so copies are never expanded to all pairs.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_count, saved, scratch
from .components import components
from .textcore import BASE, mix, ngrams, text_blocks, words

SKETCH_BITS = 18
#: Slots in which a task remembers the shingles it has met.
_SEEN_BITS = 26
#: Prefix rows of a bucket, and prefix rows a task holds to deal them.
_BUCKET, _DEALT = 1 << 18, 1 << 21
#: Bits of the table that marks classes in pairs.
_NEED_BITS = 24
_CHUNKS = 64
_DEALS = 256


@dataclass(frozen=True)
class JaccardParams:
    """shingle: words per shingle; percent: least similarity in percent;
    turns, neighbours, pivots: rounds of pivot pairs, groups met in a run, and
    pairs tested of a group in each; block: classes of one side of a counting task."""

    shingle: int = 5
    percent: int = 75
    turns: int = 2
    neighbours: int = 3
    pivots: int = 4
    block: int = 2048

    def needed(self, n):
        """Least overlap of a set of n with any similar set."""
        return -(-n * self.percent // 100)


def _order(rank: np.ndarray, bits: int, g: np.ndarray) -> np.ndarray:
    """Order by (rank, g): one sort of rank and the upper bits of g, and an exact
    one in the rare case that different g agree in those bits."""
    packed = (rank.astype(np.uint64) << np.uint64(64 - bits)) | (g >> np.uint64(bits))
    order = np.argsort(packed)
    k, x = packed[order], g[order]
    if ((k[1:] == k[:-1]) & (x[1:] != x[:-1])).any():
        order = np.lexsort((g, rank))
    return order


def shingle_sets(data, offsets, n: int, rank=None):
    """(hash, row) of the distinct shingles, ordered by row, rank(hash) and hash.

    A row with fewer than n words has its whole word sequence as one shingle.
    ``rank`` maps hashes to integers below 2**20.
    """
    _, _, row, h = words(data, offsets)
    g, r = ngrams(h, row, n)
    rows = len(offsets) - 1
    per = np.bincount(row, minlength=rows)
    for k in range(1, n):
        short = np.flatnonzero(per == k)
        if len(short):
            m = np.isin(row, short)
            gk, rk = ngrams(h[m], row[m], k)
            g, r = np.concatenate([g, gk]), np.concatenate([r, rk])
    bits = max(1, int(rows).bit_length())
    if rank is None:
        order = _order(r, bits, g)
    else:
        order = _order((r.astype(np.uint64) << np.uint64(20)) | rank(g).astype(np.uint64), bits + 20, g)
    g, r = g[order], r[order]
    if len(g):
        new = np.r_[True, (g[1:] != g[:-1]) | (r[1:] != r[:-1])]
        g, r = g[new], r[new]
    return g, r


def set_ids(g, r, rows: int):
    """(size, class id) of every row: the class is a hash of the whole set."""
    n = np.bincount(r, minlength=rows).astype(np.int64)
    return n, mix(_row_sums(mix(g + BASE), r, rows) + n.astype(np.uint64) * BASE)


def _row_sums(x: np.ndarray, r: np.ndarray, rows: int) -> np.ndarray:
    """Sums of x per row; r is ascending."""
    total = np.zeros(rows, np.uint64)
    if len(x):
        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        total[r[first]] = np.add.reduceat(x, first)
    return total


def count_sketch(documents: DataFrame, p: JaccardParams) -> np.ndarray:
    """Repeated occurrences of shingles in 2**SKETCH_BITS hash slots (a fixed size).

    A task counts an occurrence if it has met the shingle (its slot) before,
    so the many shingles that occur once do not blur the counts.
    """
    size = 1 << SKETCH_BITS

    def count(batches):
        c, seen, held = np.zeros(size, np.int64), np.zeros(1 << _SEEN_BITS, bool), []
        for b in batches:
            for _, _, data, offsets in text_blocks(b):
                _, _, row, h = words(data, offsets)
                g, _ = ngrams(h, row, p.shingle)
                slot = (g & np.uint64((1 << _SEEN_BITS) - 1)).astype(np.int64)
                held.append((g[seen[slot]] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
                seen[slot] = True
                if sum(map(len, held)) > size:
                    c += np.bincount(np.concatenate(held), minlength=size)
                    held = []
        for x in held:
            c += np.bincount(x, minlength=size)
        parts = np.minimum(c, 2**31 - 1).astype(np.int32).reshape(_CHUNKS, -1)
        deal = TaskContext.get().partitionId() % _DEALS
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(_CHUNKS, dtype=np.int32)), pa.array(np.full(_CHUNKS, deal, np.int32)),
             pa.array([x.tobytes() for x in parts], pa.binary())], ["k", "deal", "c"])

    def add(table: pa.Table) -> pa.Table:
        c = sum(np.frombuffer(x.as_py(), np.int32).astype(np.int64) for x in table["c"])
        c = np.minimum(c, 2**31 - 1).astype(np.int32)
        return pa.table({"k": table["k"][:1], "c": pa.array([c.tobytes()], pa.binary())})

    # summed in two steps, so no task gathers a part of every task
    got = (documents.select("text").mapInArrow(count, "k int, deal int, c binary")
           .groupBy("k", "deal").applyInArrow(add, "k int, c binary")
           .groupBy("k").applyInArrow(add, "k int, c binary").collect())
    out = np.zeros((_CHUNKS, size // _CHUNKS), np.int32)
    for row in got:
        out[row.k] = np.frombuffer(row.c, np.int32)
    return out.reshape(-1)


def document_sets(documents: DataFrame, sketch, p: JaccardParams) -> DataFrame:
    """(doc_id, cid, gid, n, prefix, z) per row: class, group, set size, prefix hashes in order
    (without a sketch in that of the hashes) and the compressed text."""
    def scan(batches):
        counts = None if sketch is None else np.minimum(sketch.value, (1 << 20) - 1)

        def often(g):
            return counts[(g >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]

        for b in batches:
            for i, j, data, offsets in text_blocks(b):
                g, r = shingle_sets(data, offsets, p.shingle, None if sketch is None else often)
                n, cid = set_ids(g, r, j - i)
                pos = np.arange(len(g)) - (np.cumsum(n) - n)[r]
                size = np.where(n > 0, n - p.needed(n) + 1, 0)
                keep = pos < size[r]
                g, r = g[keep], r[keep]
                gid = mix(_row_sums(mix(g * BASE + BASE), r, j - i) + n.astype(np.uint64) * BASE)
                cut = np.concatenate([[0], np.cumsum(size)]).astype(np.int32) * 8
                prefix = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(cut), pa.py_buffer(g.tobytes())])
                z = [zlib.compress(data[s:e], 1) if k else b"" for s, e, k in zip(offsets[:-1], offsets[1:], n)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(cid.view(np.int64)), pa.array(gid.view(np.int64)),
                     pa.array(n), prefix, pa.array(z, pa.binary())], ["doc_id", "cid", "gid", "n", "prefix", "z"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, cid long, gid long, n long, prefix binary, z binary")


def postings(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, h, gid, n, pos): the prefix rows dealt into buckets by shingle, packed.

    A row holds what a task has for a bucket, as arrays: the lower half of the shingle's
    hash, group, size and position.  A task sends a group once in ``_DEALT`` prefix rows.
    """
    def deal(batches):
        held, size = [], 0
        for b in batches:
            gid, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            _, first = np.unique(gid, return_index=True)
            parts = [np.frombuffer(b.column(2)[int(k)].as_py(), np.uint64) for k in first]
            held.append((gid[first], n[first], parts))
            size += sum(len(x) for x in parts)
            if size >= _DEALT:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(held):
        gid, n = (np.concatenate([x[k] for x in held]) for k in (0, 1))
        parts = [x for _, _, some in held for x in some]
        gid, first = np.unique(gid, return_index=True)
        n, parts = n[first], [parts[k] for k in first]
        size = np.array([len(x) for x in parts], np.int64)
        own = np.repeat(np.arange(len(gid)), size)
        pos = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
        h = np.concatenate(parts)
        bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.r_[np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order)]
        small = np.uint16 if n.max() < 1 << 16 else np.int32
        own, pos = own[order], pos[order]
        columns = [x.tobytes() for x in (h[order].astype(np.uint32), gid[own], n[own].astype(small), pos.astype(small))]
        wide = (4, 8, np.dtype(small).itemsize, np.dtype(small).itemsize)
        blobs = [pa.Array.from_buffers(pa.binary(), len(cut) - 1, [
            None, pa.py_buffer((cut * w).astype(np.int32)), pa.py_buffer(x)]) for x, w in zip(columns, wide)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[order][cut[:-1]].astype(np.int32)), *blobs],
                                          ["bucket", "h", "gid", "n", "pos"])

    return rows.select("gid", "n", "prefix").mapInArrow(
        deal, "bucket int, h binary, gid binary, n binary, pos binary")


def _runs_of(h, gid, n, pos):
    """The rows of each shingle that occurs in several groups, one a group, by shingle."""
    order = np.argsort(h)
    x = h[order]
    same = x[1:] == x[:-1]
    k = order[np.r_[False, same] | np.r_[same, False]] if len(x) else order
    k = k[np.lexsort((gid[k], h[k]))]
    new = np.r_[True, (h[k][1:] != h[k][:-1]) | (gid[k][1:] != gid[k][:-1])] if len(k) else np.zeros(0, bool)
    k = k[new]
    same = h[k][1:] == h[k][:-1]
    k = k[np.r_[False, same] | np.r_[same, False]] if len(k) else k
    return h[k], gid[k], n[k], pos[k]


def _first_pairs(h, gid, n, pos, p: JaccardParams):
    """(g1, g2, shared shingles) of the pivot pairs of the first turn in whole runs (``pivot_pairs``)."""
    size = np.floor(np.log(n) / math.log(100 / p.percent)).astype(np.int64)
    order = np.lexsort((gid, mix(gid.view(np.uint64)), size, h))
    h, gid, n, pos, size = (x[order] for x in (h, gid, n, pos, size))
    at = np.arange(len(h))
    new = np.r_[True, (h[1:] != h[:-1]) | (size[1:] != size[:-1])] if len(h) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, at, 0)) if len(h) else at
    far = at - start > p.neighbours
    one, two = [at[far]], [start[far]]
    for k in range(1, p.neighbours + 1):
        near = at - start >= k
        one.append(at[near])
        two.append(at[near] - k)
    one, two = np.concatenate(one), np.concatenate(two)
    n1, n2, left = n[one], n[two], np.minimum(n[one] - pos[one], n[two] - pos[two])
    need = np.ceil((n1 + n2) * p.percent / (100 + p.percent) - 1e-9)
    ok = (n1 * 100 >= n2 * p.percent) & (n2 * 100 >= n1 * p.percent) & (left >= need)
    g1, g2 = gid[one[ok]], gid[two[ok]]
    order = np.lexsort((g2, g1))
    g1, g2 = g1[order], g2[order]
    first = np.flatnonzero(np.r_[True, (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])]) if len(g1) else np.zeros(0, np.int64)
    return g1[first], g2[first], np.diff(np.r_[first, len(g1)])


def shared_runs(postings: DataFrame, p: JaccardParams) -> DataFrame:
    """(pair, h, gid, n, pos): the prefix rows whose shingle occurs in several groups, and,
    where ``pair``, the groups (h, gid) that meet n times in the first turn.

    A bucket has all rows of its shingles.  Two shingles that agree in bucket and half
    their hash make one run, which is a few pairs more to verify.
    """
    def gather(table: pa.Table) -> pa.Table:
        h, gid, n, pos = [], [], [], []
        for k in range(table.num_rows):
            blob = [table[c][k].as_py() for c in ("h", "gid", "n", "pos")]
            small = np.uint16 if len(blob[2]) < len(blob[0]) else np.int32
            for out, x, kind in zip((h, gid, n, pos), blob, (np.uint32, np.int64, small, small)):
                x = np.frombuffer(x, kind)
                out.append(x if kind in (np.uint32, np.int64) else x.astype(np.int64))
        h, gid, n, pos = _runs_of(*(np.concatenate(x) for x in (h, gid, n, pos)))
        g1, g2, k = _first_pairs(h, gid, n, pos, p) if p.turns else (gid[:0], gid[:0], n[:0])
        h = h.astype(np.int64) | table["bucket"][0].as_py() << 32
        return pa.table({"pair": pa.array(np.repeat([False, True], [len(h), len(g1)])),
                         "h": pa.array(np.r_[h, g1]), "gid": pa.array(np.r_[gid, g2]),
                         "n": pa.array(np.r_[n, k].astype(np.int32)),
                         "pos": pa.array(np.r_[pos, np.zeros(len(g1), np.int64)].astype(np.int32))})

    return postings.groupBy("bucket").applyInArrow(gather, "pair boolean, h long, gid long, n int, pos int")


def _fits(n1, p1, n2, p2, percent: int):
    """Size and position filters of two groups that share a prefix shingle."""
    need = F.ceil((n1 + n2) * F.lit(percent) / F.lit(100 + percent) - F.lit(1e-9))
    return ((n1 * 100 >= n2 * percent) & (n2 * 100 >= n1 * percent)
            & (F.least(n1 - p1, n2 - p2) >= need))


def pivot_pairs(runs: DataFrame, turn: int, p: JaccardParams) -> DataFrame:
    """(g1, g2): every group with a few others of the runs it is in.

    Runs are split by size class (shifted by half a class every other turn)
    and put in the order of a hash of the group that is the same in all runs:
    a group meets the first of its run and the ones just before itself.  It
    keeps the ``pivots`` it shares most shingles with.  Pairs inside one
    component are left out.
    """
    size = F.floor(F.log(F.col("n")) / math.log(100 / p.percent) + 0.5 * (turn % 2))
    w = Window.partitionBy("h", "size").orderBy(F.xxhash64("gid", F.lit(turn)), "gid")
    it = F.struct("gid", "n", "pos", "lo", "hi")
    met = F.array(F.first(it).over(w), *[F.lag(it, k).over(w) for k in range(1, p.neighbours + 1)])
    t = (runs.withColumn("size", size).withColumn("met", F.array_distinct(met))
         .withColumn("l", F.explode("met"))
         .where((F.col("l.gid") != F.col("gid")) & _apart("lo", "hi", "l.lo", "l.hi")
                & _fits(F.col("n"), F.col("pos"), F.col("l.n"), F.col("l.pos"), p.percent))
         .groupBy(F.col("gid").alias("g1"), F.col("l.gid").alias("g2")).agg(F.count(F.lit(1)).alias("k")))
    return _closest(t, p)


def _closest(t: DataFrame, p: JaccardParams) -> DataFrame:
    """(g1, g2): the ``pivots`` of each g1 with the largest k."""
    best = Window.partitionBy("g1").orderBy(F.desc("k"), "g2")
    return t.withColumn("r", F.row_number().over(best)).where(F.col("r") <= p.pivots).select("g1", "g2")


def _apart(lo1, hi1, lo2, hi2):
    """The groups do not lie in one and the same component."""
    return (F.col(lo1) != F.col(hi1)) | (F.col(lo2) != F.col(hi2)) | (F.col(lo1) != F.col(lo2))


def open_pairs(runs: DataFrame, p: JaccardParams) -> DataFrame:
    """(g1, g2): all pairs of groups that share a run, may be similar, and are
    not in one component: those outside a run's main component with all others."""
    main = saved(runs.groupBy("h", "lo").agg(F.count(F.lit(1)).alias("k"))
                 .groupBy("h").agg(F.max_by("lo", F.struct("k", "lo")).alias("main")), "jaccard_main")
    left = runs.join(main, "h").where("lo <> main or hi <> main").drop("main")
    other = runs.select("h", *[F.col(c).alias(f"{c}2") for c in ("gid", "n", "pos", "lo", "hi")])
    return (left.join(other, "h")
            .where((F.col("gid") != F.col("gid2")) & _apart("lo", "hi", "lo2", "hi2")
                   & _fits(F.col("n"), F.col("pos"), F.col("n2"), F.col("pos2"), p.percent))
            .select(F.least("gid", "gid2").alias("g1"), F.greatest("gid", "gid2").alias("g2")).distinct())


def _sets(blobs: list[bytes], p: JaccardParams) -> list[np.ndarray]:
    """The shingle sets of compressed texts."""
    texts = pa.array([zlib.decompress(z) for z in blobs], pa.binary()).cast(pa.string())
    sets: list[np.ndarray] = []
    for i, j, data, offsets in text_blocks(pa.RecordBatch.from_arrays([texts], ["text"])):
        g, r = shingle_sets(data, offsets, p.shingle)
        sets += np.split(g, np.searchsorted(r, np.arange(1, j - i)))
    return sets


def verified(pairs: DataFrame, texts: DataFrame, p: JaccardParams) -> DataFrame:
    """(a, b) of the pairs whose whole texts have the required similarity."""
    def test(batches):
        for b in batches:
            a, c = b.column(0).to_pylist(), b.column(1).to_pylist()
            ids, blobs = {}, []
            for col, z in ((a, b.column(2)), (c, b.column(3))):
                for key, v in zip(col, z):
                    if key not in ids:
                        ids[key] = len(blobs)
                        blobs.append(v.as_py())
            sets = _sets(blobs, p)
            ok = np.zeros(b.num_rows, bool)
            for k, (x, y) in enumerate(zip(a, c)):
                u, v = sets[ids[x]], sets[ids[y]]
                if len(u) and len(v):
                    both = len(np.intersect1d(u, v, assume_unique=True))
                    ok[k] = 100 * both >= p.percent * (len(u) + len(v) - both)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    ta = texts.select(F.col("cid").alias("a"), F.col("z").alias("za"))
    tb = texts.select(F.col("cid").alias("b"), F.col("z").alias("zb"))
    return (pairs.join(ta, "a").join(tb, "b").select("a", "b", "za", "zb")
            .mapInArrow(test, "a long, b long"))


def in_pairs(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``cid`` is in a pair, before they are shuffled to meet it.

    A table of ``2**_NEED_BITS`` bits (a fixed size) marks the classes in pairs; rows
    that only share a bit with one are a few more to send.
    """
    slot = F.pmod(F.xxhash64("v"), F.lit(1 << _NEED_BITS))
    marked = (pairs.select(F.explode(F.array("a", "b")).alias("v")).select(slot.alias("s"))
              .groupBy(F.shiftright("s", 5).cast("int").alias("w"))
              .agg(F.expr("bit_or(shiftleft(1L, cast(s & 31 AS int)))").alias("m")).toArrow())
    table = np.zeros(1 << (_NEED_BITS - 5), np.uint32)
    table[marked["w"].to_numpy()] = marked["m"].to_numpy().astype(np.uint32)
    shared = texts.sparkSession.sparkContext.broadcast(table)              # fixed size

    @F.pandas_udf("boolean")
    def marked_slot(s: pd.Series) -> pd.Series:
        x = s.to_numpy()
        return pd.Series(shared.value[x >> 5] >> (x & 31).astype(np.uint32) & np.uint32(1) == 1)

    return texts.where(marked_slot(F.pmod(F.xxhash64("cid"), F.lit(1 << _NEED_BITS))))


def class_texts(documents: DataFrame, involved: DataFrame, p: JaccardParams) -> DataFrame:
    """(cid, z): the compressed text of one document of every involved class (cid)."""
    sets = document_sets(documents.where(F.col("doc_id").isNotNull()), None, p).where("n > 0")
    return sets.join(involved, "cid", "left_semi").select("cid", "z").dropDuplicates(["cid"])


def _verified_pairs(pairs: DataFrame, texts: DataFrame, p: JaccardParams) -> DataFrame:
    """(a, b), a < b: the verified ones of the distinct class pairs, written."""
    d = saved(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
              "jaccard_pairs")
    return saved(verified(d, in_pairs(texts, d), p), "jaccard_links")


def _open(member: DataFrame, runs: DataFrame, comp: DataFrame):
    """Members with their component, the runs over several components with the
    lowest and highest component of each group, and the groups of several."""
    of = saved(member.join(comp.withColumnRenamed("v", "cid"), "cid", "left")
               .select("gid", "cid", F.coalesce("c", "cid").alias("c")), "jaccard_members")
    gc = saved(of.groupBy("gid").agg(F.min("c").alias("lo"), F.max("c").alias("hi")), "jaccard_groups")
    rc = saved(runs.select("h", "gid", "n", "pos").join(gc, "gid"), "jaccard_run_components")
    several = (rc.groupBy("h").agg(F.min("lo").alias("x"), F.max("hi").alias("y")).where("x <> y").select("h"))
    return of, saved(rc.join(saved(several, "jaccard_several"), "h"), "jaccard_open"), gc.where("lo <> hi")


#: Shingles in at most this many sets are counted by pairs, the others by matrix products.
_FEW = 16
_COLUMNS = 1024


def common_counts(g: np.ndarray, r: np.ndarray, a: int, b: int) -> np.ndarray:
    """(a x b) common shingles of the sets 0..a-1 and a..a+b-1; (g, r) are distinct pairs."""
    out = np.zeros((a, b), np.float32)
    order = np.argsort(g, kind="stable")
    g, r = g[order], r[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(g)])
    few = _FEW if len(first) > _COLUMNS else 1
    for c in range(2, few + 1):
        at = first[count == c]
        for lo in range(0, len(at), 1 << 14):
            sets = r[at[lo:lo + (1 << 14), None] + np.arange(c)]
            x, y = np.repeat(sets, c, axis=1).ravel(), np.tile(sets, c).ravel()
            ok = (x < a) & (y >= a)
            np.add.at(out.reshape(-1), x[ok] * b + y[ok] - a, np.float32(1))
    many = count > few
    column = np.repeat(np.where(many, np.cumsum(many) - 1, -1), count)
    g, r, column = g[column >= 0], r[column >= 0], column[column >= 0]
    for lo in range(0, int(many.sum()), _COLUMNS):
        i, j = np.searchsorted(column, [lo, lo + _COLUMNS])
        m = np.zeros((a + b, _COLUMNS), np.float32)
        m[r[i:j], column[i:j] - lo] = 1
        out += m[:a] @ m[a:].T
    return out


def links_between(sets: list[np.ndarray], a: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Similar sets of each of the first a sets among the others, and the reverse."""
    size = np.array([len(x) for x in sets], np.int64)
    b = len(sets) - a
    left, right = np.zeros(a, np.int64), np.zeros(b, np.int64)
    if a and b:
        both = common_counts(np.concatenate(sets), np.repeat(np.arange(a + b), size), a, b)
        for lo in range(0, a, 256):
            x = both[lo:lo + 256].astype(np.int64)
            ok = 100 * x >= percent * (size[lo:min(lo + 256, a), None] + size[None, a:] - x)
            left[lo:lo + 256] = ok.sum(axis=1)
            right += ok.sum(axis=0)
    return left, right


def class_links(comp: DataFrame, texts: DataFrame, p: JaccardParams) -> DataFrame:
    """(cid, n_links): for each class of a component all other classes similar to it.

    Components of up to ``block`` classes are dealt by hash, several to a
    task.  The classes of a larger one are dealt into blocks; a class goes to
    one task per block, so rows are classes times blocks.
    """
    def count(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cid, c = table["cid"].to_numpy(), table["c"].to_numpy()
        mine, i, j = table["mine"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
        sets = _sets([v.as_py() for v in table["z"]], p)
        n = np.zeros(len(cid), np.int64)
        if i == j:                                   # whole components, or one block with itself
            order = np.argsort(c, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(c[order])) + 1):
                own = [sets[k] for k in part]
                n[part] = links_between(own + own, len(own), p.percent)[0] - 1
        else:
            one, two = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
            n[one], n[two] = links_between([sets[k] for k in [*one, *two]], len(one), p.percent)
        return pa.table({"cid": pa.array(cid), "n": pa.array(n)})

    size = saved(comp.groupBy("c").agg(F.count(F.lit(1)).alias("size")), "jaccard_sizes")
    small = size.where(F.col("size") <= p.block).agg(F.sum("size")).first()[0] or 0
    deals, blocks = bucket_count(small, p.block), F.ceil(F.col("size") / p.block).cast("int")
    mine = F.pmod(F.xxhash64("cid", F.lit(1)), blocks).cast("int")
    tasks = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(
        F.least("mine", k).alias("i"), F.greatest("mine", k).alias("j")))
    dealt = (comp.withColumnRenamed("v", "cid").join(size, "c").withColumn("mine", mine)
             .withColumn("deal", F.when(blocks > 1, F.col("c")).otherwise(F.pmod(F.xxhash64("c"), F.lit(deals))))
             .withColumn("big", blocks > 1).withColumn("t", F.explode(tasks))
             .select("cid", "c", "deal", "big", "mine", "t.i", "t.j"))
    return (dealt.join(texts, "cid").groupBy("deal", "big", "i", "j")
            .applyInArrow(count, "cid long, n long").groupBy("cid").agg(F.sum("n").alias("n_links")))


def near_duplicates(documents: DataFrame, p: JaccardParams | None = None, links: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, n_links) of every document row.

    Words are runs of non-space bytes, A-Z lower-cased.  Two documents link when
    100 * |intersection| >= percent * |union| of their shingle sets.
    ``component_id`` is the smallest doc_id reachable by links, itself
    included; ``class_id`` names the shingle set; ``n_links`` counts all
    other classes that link with the class (left out without ``links``).  A document without
    words or text is empty and links with nothing.  Rows with a null doc_id
    are returned with a null component and take no part; repeated rows are
    returned each; an empty table gives no rows; extra columns are ignored.
    """
    with scratch(documents.sparkSession):
        rows, final = _classes(documents.select("doc_id", "text"), p or JaccardParams(), links)
    out = (rows.join(final, "cid", "left")
           .select("doc_id", F.col("n").alias("n_shingles"),
                   F.when(F.col("n") == 0, F.col("doc_id")).otherwise(
                       F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).alias("component_id"),
                   F.col("cid").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))
    return out if links else out.drop("n_links")


def _classes(documents: DataFrame, p: JaccardParams, links: bool) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, cid, n) and the linked classes (cid, component_id, n_links), both kept."""
    spark = documents.sparkSession
    sketch = spark.sparkContext.broadcast(count_sketch(documents, p))      # fixed size
    rows = saved(document_sets(documents, sketch, p).withColumn("row", F.monotonically_increasing_id()), "jaccard_rows")
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    # inside, a class goes by one of its rows, whose text is read where a pair is verified
    classes = saved(known.groupBy(F.col("cid").alias("class_id"), "gid").agg(
        F.min("doc_id").alias("doc_id"), F.min("row").alias("cid")), "jaccard_classes")
    groups = classes.groupBy("gid").agg(F.min("cid").alias("lead"), F.max("cid").alias("other"))
    inside = groups.where("lead <> other").select("gid", "lead")

    total = known.agg(F.coalesce(F.sum(F.col("n") * (100 - p.percent) / 100 + 1), F.lit(0.0))).first()[0]
    gathered = saved(shared_runs(postings(known, bucket_count(int(total), _BUCKET)), p), "jaccard_runs")
    runs = gathered.where(~F.col("pair")).drop("pair")
    met = (gathered.where("pair").groupBy(F.col("h").alias("g1"), F.col("gid").alias("g2"))
           .agg(F.sum("n").alias("k")))
    member = classes.select("gid", "cid")
    texts = rows.select(F.col("row").alias("cid"), "z")

    of = member.withColumn("c", F.col("cid"))
    lead = groups.select(F.col("gid").alias("g2"), F.col("lead").alias("b"))
    own = member.join(inside, "gid").select(F.col("cid").alias("a"), F.col("lead").alias("b"))
    found = None
    for turn in range(p.turns):
        pairs = ((pivot_pairs(left, turn, p) if turn else _closest(met, p))
                 .join(of.select(F.col("gid").alias("g1"), F.col("cid").alias("a")), "g1")
                 .join(lead, "g2").select("a", "b"))
        if turn == 0:
            pairs = pairs.unionByName(own)
        new = _verified_pairs(pairs, texts, p)
        found = new if found is None else found.unionByName(new)
        of, left, torn = _open(member, runs if turn == 0 else left, components(found))

    # what the pivots left open, exhaustively
    m1 = of.select(F.col("gid").alias("g1"), F.col("cid").alias("a"), F.col("c").alias("ca"))
    m2 = of.select(F.col("gid").alias("g2"), F.col("cid").alias("b"), F.col("c").alias("cb"))
    rest = (open_pairs(left, p).unionByName(torn.select(F.col("gid").alias("g1"), F.col("gid").alias("g2")))
            .join(m1, "g1").join(m2, "g2").where("ca <> cb").select("a", "b"))
    comp = components(found.unionByName(_verified_pairs(rest, texts, p)))
    n_links = class_links(comp, texts, p) if links else comp.select(F.col("v").alias("cid"), F.lit(0).alias("n_links"))
    named = (classes.join(comp.withColumnRenamed("v", "cid"), "cid", "left")
             .withColumn("c", F.coalesce("c", "cid")))
    smallest = named.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    # written, so that a class with very many copies is an ordinary skewed join
    final = saved(named.select("class_id", "cid", "c").join(smallest, "c").join(n_links, "cid", "left")
                  .select(F.col("class_id").alias("cid"), "component_id",
                          F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")),
                  "jaccard_classes_out", keep=True)
    return saved(rows.select("doc_id", "cid", "n"), "jaccard_sizes_out", keep=True), final
