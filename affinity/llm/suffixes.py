"""Suffix-array deduplication with a logarithmic index family.

A byte goes if it lies in a string of ``length`` bytes that also starts
anywhere else.  The suffix arrays are sparse: of every window of ``length``
bytes only the suffix whose ``k`` first bytes hash lowest is indexed, so
equal windows always index the same suffix of theirs (its offset in the window
depends on the window alone) and about 2 in ``length - k`` suffixes are kept.

Index family.  Documents arrive in batches.  A batch becomes a sorted array
of its distinct suffix heads (first ``k`` bytes, hashed) with their counts, is
merge-scanned against every existing level for heads that occur elsewhere, and
becomes level 0; two arrays of one level merge into one of the next, so an
entry is rewritten O(log batches) times and a batch meets O(log batches)
levels.  Counts are summed before any shuffle, so a hot passage is one entry.

Exact matches.  The windows of the suffixes with a repeated head are settled
on their bytes: suffixes with equal surroundings (all their windows) are one
context; a head with a single context repeats as a whole, and of the others
the window hashes of one text per context are compared.  Heads with very many
contexts are compared by one row per window instead of in memory; both ways give the same
answer.  Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket_count, saved
from .textcore import Prefix, mix, runs, text_blocks

_POS = 24                      # bits of a position inside a chunk
_CHUNK = 4 << 20               # windows handled at a time in a very long text


@dataclass(frozen=True)
class SuffixParams:
    """length: bytes of a match; k: bytes of an indexed suffix's head;
    batches: deals of the documents; bucket: contexts compared in one task;
    crowd: contexts of one head from which they are compared row by row."""

    length: int = 200
    k: int = 64
    batches: int = 3
    bucket: int = 20_000
    crowd: int = 2_000


def _window_min(key: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, by doubling."""
    have = 1
    while have * 2 <= w:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    rest = w - have
    return np.minimum(key[:-rest], key[rest:]) if rest else key


def anchors(data: np.ndarray, offsets: np.ndarray, p: SuffixParams):
    """(row, first window, windows, head, context) of the indexed suffixes.

    Windows ``lo .. lo + n - 1`` (counted inside the row) share the suffix.
    """
    out = [[] for _ in range(5)]
    for base in range(0, max(1, len(data) - p.length + 1), _CHUNK):
        part = data[base:base + _CHUNK + p.length - 1]
        m = len(part) - p.length + 1
        if m <= 0:
            break
        prefix = Prefix(part)
        s = np.arange(len(part) - p.k + 1)
        h = prefix.of(s, s + p.k)
        low = np.uint64((1 << _POS) - 1)
        best = _window_min((h & ~low) | s.astype(np.uint64), p.length - p.k + 1)
        at = (best & low).astype(np.int64)[:m]
        # windows that cross the end of a row do not count
        edge = np.zeros(m + 1, np.int32)
        ends = offsets[1:] - base
        np.add.at(edge, np.clip(np.maximum(ends - p.length + 1, offsets[:-1] - base), 0, m), 1)
        np.add.at(edge, np.clip(ends, 0, m), -1)
        win = np.flatnonzero(np.cumsum(edge[:m]) == 0)
        if not len(win):
            continue
        at = at[win]
        cut = np.flatnonzero((at[1:] != at[:-1]) | (win[1:] != win[:-1] + 1)) + 1
        first, last = np.r_[0, cut], np.r_[cut, len(win)] - 1
        lo, n = win[first], win[last] - win[first] + 1
        row = np.searchsorted(offsets, lo + base, side="right") - 1
        head = h[at[first]]
        ctx = mix(prefix.of(lo, lo + n + p.length - 1) ^ mix(head + (at[first] - lo).astype(np.uint64)))
        for x, v in zip(out, (row, lo + base - offsets[row], n, head, ctx)):
            x.append(v)
    if not out[0]:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    return tuple(np.concatenate(x) for x in out)


def _rows(documents: DataFrame) -> DataFrame:
    return documents.withColumn("row_key", F.xxhash64("doc_id", "text"))


class SuffixIndex:
    """A family of sorted suffix-head arrays; level i holds 2**i batches."""

    def __init__(self, spark: SparkSession, p: SuffixParams):
        self.spark, self.p = spark, p
        self.levels: dict[int, DataFrame] = {}

    def array(self, documents: DataFrame) -> DataFrame:
        """(head, n): the batch's distinct suffix heads, sorted, with counts."""
        p = self.p

        def scan(batches):
            for b in batches:
                for _, _, data, offsets in text_blocks(b):
                    head, n = np.unique(anchors(data, offsets, p)[3], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(head.view(np.int64)), pa.array(n)], ["head", "n"])

        heads = documents.select("text").mapInArrow(scan, "head long, n long")
        return saved(heads.groupBy("head").agg(F.sum("n").alias("n")).sortWithinPartitions("head"), "suffix_array")

    def add(self, documents: DataFrame) -> DataFrame:
        """Index a batch; returns the heads now known to occur more than once."""
        new = self.array(documents)
        found = new.where("n > 1").select("head")
        for level in self.levels.values():                      # merge scans of sorted arrays
            found = found.unionByName(new.hint("merge").join(level.select("head"), "head").select("head"))
        found = saved(found.distinct(), "suffix_repeats")
        depth = 0
        while depth in self.levels:                             # equal sizes merge
            old = self.levels.pop(depth)
            new = saved(old.unionByName(new).groupBy("head").agg(F.sum("n").alias("n"))
                        .sortWithinPartitions("head"), "suffix_level")
            depth += 1
        self.levels[depth] = new
        return found


def repeated_heads(documents: DataFrame, p: SuffixParams) -> DataFrame:
    """Heads that occur more than once, found by adding the batches one by one."""
    index = SuffixIndex(documents.sparkSession, p)
    deal = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(p.batches))
    found = None
    for i in range(p.batches):
        x = index.add(documents.where(deal == i))
        found = x if found is None else found.unionByName(x)
    return saved(found.distinct(), "suffix_heads")


def _entries(rows: DataFrame, p: SuffixParams) -> DataFrame:
    def scan(batches):
        for b in batches:
            keys = b.column(0)
            for i, _, data, offsets in text_blocks(b):
                row, lo, n, head, ctx = anchors(data, offsets, p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(head.view(np.int64)), pa.array(ctx.view(np.int64)), keys.take(pa.array(row + i)),
                     pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["head", "ctx", "row_key", "lo", "n"])

    return rows.select("row_key", "text").mapInArrow(scan, "head long, ctx long, row_key long, lo int, n int")


def _squeezed(rows: DataFrame, *keep: str) -> DataFrame:
    """The rows with their text compressed, for the joins that carry whole texts."""
    cols = [*keep, "row_key"]
    src = rows.select(*cols, "text")
    schema = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in cols) + ", z binary"

    def squeeze(batches):
        c = zstandard.ZstdCompressor(level=3)
        for b in batches:
            z = [c.compress(v.as_py().encode()) for v in b.column(len(cols)).fill_null("")]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(len(cols))], pa.array(z, pa.binary())],
                                             [*cols, "z"])

    return src.mapInArrow(squeeze, schema)


def _regions(contexts: DataFrame, rows: DataFrame, p: SuffixParams) -> DataFrame:
    """(head, ctx, c, n, region): the bytes of one occurrence of each context."""
    need = contexts.groupBy("row_key").agg(F.collect_list(F.struct("head", "ctx", "c", "lo", "n")).alias("spots"))

    def cut(batches):
        d = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for z, spots in zip(b.column(0), b.column(1).to_pylist()):
                text = d.decompress(z.as_py())
                out += [(s["head"], s["ctx"], s["c"], s["n"], text[s["lo"]:s["lo"] + s["n"] + p.length - 1])
                        for s in spots]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], t) for k, t in
                 enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                ["head", "ctx", "c", "n", "region"])

    return (_squeezed(rows).join(need, "row_key").select("z", "spots")
            .mapInArrow(cut, "head long, ctx long, c long, n int, region binary")
            .dropDuplicates(["head", "ctx"]))


def _window_hashes(regions, n: np.ndarray, length: int):
    """(owner, window, hash) of every window of the regions."""
    size = n + length - 1
    data = np.frombuffer(b"".join(regions), np.uint8)
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(n)), n)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    s = begin[owner] + window
    return owner, window, Prefix(data).of(s, s + length)


def _run_bytes(owner, window, flag, count: int) -> list[bytes]:
    """Per owner its runs of flagged windows as int32 pairs (first, last)."""
    if not len(owner):
        return [b""] * count
    offsets = np.r_[0, np.cumsum(np.bincount(owner, minlength=count))]
    s, e, row = runs(flag, offsets)
    pairs = np.stack([window[s], window[e - 1]], axis=1).astype(np.int32)
    cut = np.searchsorted(row, np.arange(1, count))
    return [x.tobytes() for x in np.split(pairs, cut)]


def _settled(regions: DataFrame, total: int, p: SuffixParams) -> DataFrame:
    """(head, ctx, found): runs of repeated windows, contexts compared in memory."""
    nb = bucket_count(total, p.bucket)

    def compare(table: pa.Table) -> pa.Table:
        n = table["n"].to_numpy().astype(np.int64)
        owner, window, h = _window_hashes([x.as_py() for x in table["region"]], n, p.length)
        h = mix(h + table["head"].to_numpy().view(np.uint64)[owner])
        _, inv, times = np.unique(h, return_inverse=True, return_counts=True)
        flag = (times[inv] > 1) | (table["c"].to_numpy() > 1)[owner]
        return pa.table({"head": table["head"], "ctx": table["ctx"],
                         "found": pa.array(_run_bytes(owner, window, flag, len(n)), pa.binary())})

    return (regions.withColumn("bucket", F.pmod(F.xxhash64("head"), F.lit(nb))).groupBy("bucket")
            .applyInArrow(compare, "head long, ctx long, found binary"))


def _settled_by_rows(regions: DataFrame, p: SuffixParams) -> DataFrame:
    """The same for heads with very many contexts: one row per window."""
    def explode(batches):
        for b in batches:
            n = b.column(3).to_numpy().astype(np.int64)
            owner, window, h = _window_hashes([x.as_py() for x in b.column(4)], n, p.length)
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), b.column(2).take(take),
                 pa.array(window.astype(np.int32)), pa.array(h.view(np.int64))], ["head", "ctx", "c", "w", "h"])

    w = saved(regions.select("head", "ctx", "c", "n", "region")
              .mapInArrow(explode, "head long, ctx long, c long, w int, h long"), "suffix_windows")
    twice = saved(w.groupBy("head", "h").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
                  .select("head", "h", F.lit(True).alias("twice")), "suffix_twice")
    hit = w.join(twice, ["head", "h"], "left").where("c > 1 or twice")

    def pack(batches):
        for b in batches:
            out = []
            for ws in b.column(2).to_pylist():
                x = np.sort(np.array(ws, np.int64))
                cut = np.flatnonzero(np.diff(x) > 1) + 1
                out.append(np.stack([x[np.r_[0, cut]], x[np.r_[cut, len(x)] - 1]], axis=1).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())],
                                             ["head", "ctx", "found"])

    return (hit.groupBy("head", "ctx").agg(F.collect_list("w").alias("w"))      # at most length - k windows
            .mapInArrow(pack, "head long, ctx long, found binary"))


def repeated_spans(documents: DataFrame, p: SuffixParams) -> DataFrame:
    """(row_key, spots): per row its windows that repeat, as found runs at ``lo``."""
    rows = _rows(documents)
    heads = repeated_heads(documents, p)
    hits = saved(_entries(rows, p).join(heads, "head"), "suffix_hits")
    contexts = (hits.groupBy("head", "ctx")
                .agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("row_key", "lo", "n")).alias("o"))
                .select("head", "ctx", "c", "o.row_key", "o.lo", "o.n"))
    contexts = saved(contexts, "suffix_contexts")
    per = saved(contexts.groupBy("head").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "suffix_open")
    regions = saved(_regions(contexts.join(per, "head").drop("k"), rows, p).join(per, "head"), "suffix_regions")
    few = regions.where(F.col("k") < p.crowd)
    found = (_settled(few, few.count(), p)
             .unionByName(_settled_by_rows(regions.where(F.col("k") >= p.crowd), p))
             .where(F.octet_length("found") > 0))
    # contexts that are alone with their head repeat as a whole: found is null
    single = contexts.join(per, "head", "left_anti").select("head", "ctx", F.lit(None).cast("binary").alias("found"))
    verdict = saved(found.unionByName(single), "suffix_verdict")
    return (hits.join(verdict, ["head", "ctx"])
            .groupBy("row_key").agg(F.collect_set(F.struct("lo", "n", "found")).alias("spots")))


def _mask(size: int, spots, length: int) -> np.ndarray:
    edge = np.zeros(size + 1, np.int32)
    for s in spots:
        pairs = (np.array([[0, s["n"] - 1]]) if s["found"] is None
                 else np.frombuffer(s["found"], np.int32).reshape(-1, 2))
        np.add.at(edge, s["lo"] + pairs[:, 0], 1)
        np.add.at(edge, s["lo"] + pairs[:, 1] + length, -1)
    return np.cumsum(edge[:size]) > 0


def deduplicate(documents: DataFrame, p: SuffixParams | None = None, keep: tuple[str, ...] = (),
                texts: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, *keep[, text]) per row.

    Every byte of a ``length``-byte string that also starts anywhere else,
    same document included, is removed; overlaps count and strings are judged
    on the input.  Matches never cross documents.  Null text is empty and
    hashes as no bytes; texts shorter than ``length`` stay whole; repeated
    rows are occurrences of their own; a null doc_id is a document like any
    other; an empty table gives no rows; extra columns are ignored unless kept.
    ``texts`` adds what is left, without characters cut in the middle.
    """
    p = p or SuffixParams()
    keep = tuple(c for c in keep if c not in ("doc_id", "text"))
    documents = documents.select("doc_id", "text", *keep)
    spots = repeated_spans(documents, p)
    src = (_squeezed(_rows(documents), "doc_id", *keep).join(spots, "row_key", "left")
           .select("doc_id", *keep, "z", "spots"))
    cols = ["doc_id", *keep]
    kinds = {c: src.schema[c].dataType.simpleString() for c in cols}

    def apply(batches):
        d = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for z, spots in zip(b.column(len(cols)), b.column(len(cols) + 1).to_pylist()):
                raw = d.decompress(z.as_py())
                if spots:
                    mask = _mask(len(raw), spots, p.length)
                    gone, n = int(mask.sum()), int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                    left = np.frombuffer(raw, np.uint8)[~mask].tobytes()
                else:
                    gone, n, left = 0, 0, raw
                out.append((len(raw), gone, n, hashlib.sha256(left).hexdigest(),
                            left.decode("utf-8", "ignore") if texts else None))
            arrays = [b.column(k) for k in range(len(cols))]
            arrays += [pa.array([o[k] for o in out], t) for k, t in
                       enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            names = [*cols, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if texts:
                arrays.append(pa.array([o[4] for o in out], pa.string()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in cols)
    schema += ", n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * texts
    return src.mapInArrow(apply, schema)
