"""Benchmark decontamination: n-gram seeds, rare ones first, then Smith-Waterman alignment.

1. The word n-grams of the test items are counted over all documents (number
   of documents holding each; partial sums before the shuffle).
2. Every n-gram of an item that occurs at all is a seed.  Those in at most
   ``rare`` documents and the rarer half of each item's are its rare seeds.
3. A document passage holding a rare seed is aligned with the item word by
   word (local alignment, linear gaps), which scores edited copies; score =
   alignment score / words of the item.  A passage holding common seeds only
   is aligned unless an upper bound from its words is below the threshold.
   So the counts decide the amount of work, never the result.

Test items are the stated query set: they are dealt into blocks of a bounded
number of words, and each block's table (bounded by construction) goes to
every task of one scan over the whole documents.  Nothing else is collected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import bucket_count
from .textcore import column_bytes, counts_of, ngrams, text_blocks, words

_FILTER_BITS = 20


@dataclass(frozen=True)
class DecontamParams:
    """n: words of a seed; rare: documents up to which every n-gram is a rare seed;
    threshold: least alignment score per item word; mismatch, gap: penalties
    (a match scores 1); block_words: words of test items handled per scan."""

    n: int = 3
    rare: int = 50
    threshold: float = 0.5
    mismatch: float = 0.5
    gap: float = 0.5
    block_words: int = 2_000_000


@dataclass
class Items:
    """One block of test items: word hashes and their n-grams."""

    ids: np.ndarray
    words: list[np.ndarray]
    keys: np.ndarray           # sorted distinct n-gram hashes
    item: np.ndarray           # of every n-gram occurrence, ordered by key
    pos: np.ndarray
    first: np.ndarray          # occurrences of keys[i] are first[i]:first[i + 1]
    n: int

    @staticmethod
    def build(ids: list, texts: list, n: int) -> Items:
        data, offsets = column_bytes(pa.array(texts, pa.string()))
        _, _, row, h = words(data, offsets)
        per = np.split(h, np.cumsum(counts_of(row, len(ids)))[:-1]) if len(ids) else []
        item, pos, key = [], [], []
        for i, w in enumerate(per):
            k = min(n, len(w))                    # a shorter item is one seed
            if k:
                g, _ = ngrams(w, np.zeros(len(w), np.int64), k)
                item.append(np.full(len(g), i))
                pos.append(np.arange(len(g)))
                key.append(g)
        cat = (lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t))
        return Items._index(np.array(ids, object), per, cat(item, np.int64), cat(pos, np.int64),
                            cat(key, np.uint64), n)

    @staticmethod
    def _index(ids, per, item, pos, key, n) -> Items:
        order = np.argsort(key, kind="stable")
        keys, first = np.unique(key[order], return_index=True)
        return Items(ids, per, keys, item[order], pos[order], np.r_[first, len(key)], n)

    def lookup(self, h: np.ndarray, bits: np.ndarray):
        """(index into h, index into keys) of the hashes that are keys."""
        maybe = np.flatnonzero(bits[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(maybe) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
        ok = self.keys[at] == h[maybe]
        return maybe[ok], at[ok]

    def bits(self) -> np.ndarray:
        b = np.zeros(1 << _FILTER_BITS, bool)
        b[(self.keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        return b

    def lengths(self) -> list[int]:
        return sorted({min(self.n, len(w)) for w in self.words if len(w)})

    def rare(self, df: np.ndarray, limit: int) -> Items:
        """The rare seeds: of the n-grams that occur, those in at most ``limit``
        documents and the rarer half of each item's."""
        return self._pick(self._rare(df, limit))

    def seeds(self, df: np.ndarray, limit: int) -> tuple[Items, np.ndarray]:
        """All n-grams that occur, and for each occurrence if it is a rare seed."""
        mark = np.zeros(len(self.item), bool)
        mark[self._rare(df, limit)] = True
        pick = np.flatnonzero(np.repeat(df, np.diff(self.first)) > 0)      # ordered by key, as the occurrences are
        return self._pick(pick), mark[pick]

    def _rare(self, df: np.ndarray, limit: int) -> np.ndarray:
        key = np.repeat(np.arange(len(self.keys)), np.diff(self.first))
        there = np.flatnonzero(df[key] > 0)
        order = there[np.lexsort((self.pos[there], df[key[there]], self.item[there]))]
        item = self.item[order]
        per = np.bincount(item, minlength=len(self.words))
        rank = np.arange(len(order)) - (np.cumsum(per) - per)[item]
        return order[(df[key[order]] <= limit) | (rank < (per[item] + 1) // 2)]

    def _pick(self, pick: np.ndarray) -> Items:
        key = np.repeat(np.arange(len(self.keys)), np.diff(self.first))
        return Items._index(self.ids, self.words, self.item[pick], self.pos[pick], self.keys[key[pick]], self.n)


def doc_hits(items: Items, bits: np.ndarray, h: np.ndarray, row: np.ndarray):
    """(word position, row, key index) of every item n-gram in a text block."""
    at, rows, keys = [], [], []
    for k in items.lengths():
        if len(h) < k:
            continue
        g, r = ngrams(h, row, k)
        place = np.flatnonzero(row[:len(h) - k + 1] == row[k - 1:])
        x, key = items.lookup(g, bits)
        at.append(place[x])
        rows.append(r[x])
        keys.append(key)
    if not at:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(at), np.concatenate(rows), np.concatenate(keys)


def smith_waterman(a: np.ndarray, b: np.ndarray, mismatch: float, gap: float) -> tuple[float, int]:
    """(best local alignment score, end in b) of two word-hash sequences."""
    if not len(a) or not len(b):
        return 0.0, 0
    steps = gap * np.arange(len(b) + 1)
    prev, best, end = np.zeros(len(b) + 1), 0.0, 0
    for x in a:
        cur = np.maximum(prev - gap, 0)
        cur[1:] = np.maximum(cur[1:], prev[:-1] + np.where(b == x, 1.0, -mismatch))
        cur = np.maximum.accumulate(cur + steps) - steps        # gaps along b
        j = int(cur.argmax())
        if cur[j] > best:
            best, end = float(cur[j]), j
        prev = cur
    return best, end


def score_bound(a: np.ndarray, b: np.ndarray, mismatch: float, gap: float) -> float:
    """Upper bound of the alignment score: a word of ``a`` that ``b`` lacks costs
    the smaller penalty wherever the alignment runs over it."""
    total = np.r_[0.0, np.cumsum(np.where(np.isin(a, b), 1.0, -min(mismatch, gap)))]
    return float((total - np.minimum.accumulate(total)).max())


def _slack(n: int, p: DecontamParams) -> int:
    """Words an alignment of an item of n words may insert or leave out in all.

    At most n words match, so beyond this many gaps the score is below the
    threshold; seeds of one alignment differ by no more in where the item would begin.
    """
    return max(4, math.ceil((1 - p.threshold) * n / p.gap)) if p.gap > 0 else 1 << 40


def align_block(items: Items, seeds: Items, rare: np.ndarray, bits: np.ndarray, h: np.ndarray, row: np.ndarray,
                rows: int, p: DecontamParams):
    """Yield (row, item, score, end word) of every passage that reaches the threshold."""
    at, r, key = doc_hits(seeds, bits, h, row)
    if not len(at):
        return
    begin = np.searchsorted(row, np.arange(rows))
    end = np.searchsorted(row, np.arange(rows), side="right")
    count = seeds.first[key + 1] - seeds.first[key]
    occ = np.repeat(seeds.first[key] - np.cumsum(count) + count, count) + np.arange(count.sum())
    r, item = np.repeat(r, count), seeds.item[occ]
    start = np.repeat(at, count) - seeds.pos[occ]
    best: dict[tuple[int, int], tuple[float, int]] = {}
    order = np.lexsort((start, item, r))
    r, item, start, sure = r[order], item[order], start[order], rare[occ[order]]
    i = 0
    while i < len(r):
        w = items.words[item[i]]
        slack = _slack(len(w), p)
        j = i + 1                                   # seeds of one passage lie close together
        while j < len(r) and r[j] == r[i] and item[j] == item[i] and start[j] - start[j - 1] <= slack:
            j += 1
        lo = max(begin[r[i]], start[i] - slack)
        hi = min(end[r[i]], start[j - 1] + len(w) + slack)
        if not sure[i:j].any() and score_bound(w, h[lo:hi], p.mismatch, p.gap) < p.threshold * len(w) - 1e-9:
            i = j
            continue
        score, stop = smith_waterman(w, h[lo:hi], p.mismatch, p.gap)
        score /= len(w)
        k = (int(r[i]), int(item[i]))
        if score >= p.threshold and score > best.get(k, (0.0, 0))[0]:
            best[k] = (score, int(lo - begin[r[i]] + stop))
        i = j
    for (a, b), (score, stop) in best.items():
        yield a, b, score, stop


def _blocks(benchmark: DataFrame, p: DecontamParams):
    b = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text").distinct()
    total = b.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = bucket_count(total, p.block_words)
    for k in range(n):
        part = b.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        if part:                                    # about block_words words
            yield Items.build([r.item_id for r in part], [r.text for r in part], p.n)


def _seeds(src: DataFrame, items: Items, limit: int) -> tuple[Items, np.ndarray]:
    """The n-grams that occur in the documents, and which are rare over all of them."""
    sc = src.sparkSession.sparkContext
    shared, bits = sc.broadcast(items), sc.broadcast(items.bits())

    def count(batches):
        it, bt = shared.value, bits.value
        seen = np.zeros(len(it.keys), np.int64)
        for b in batches:
            for _, _, data, offsets in text_blocks(b):
                _, _, row, h = words(data, offsets)
                _, r, key = doc_hits(it, bt, h, row)
                if len(key):
                    seen += np.bincount(np.unique(r * len(it.keys) + key) % len(it.keys), minlength=len(it.keys))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["k", "n"])

    df = np.zeros(len(items.keys), np.int64)
    # one row per n-gram of the block at most
    for r in src.select("text").mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        df[r.k] = r.n
    return items.seeds(df, limit)


def _plan(src: DataFrame, benchmark: DataFrame, p: DecontamParams):
    """Per block of test items the broadcasts that ``align_block`` needs."""
    sc = src.sparkSession.sparkContext
    for items in _blocks(benchmark, p):
        seeds, rare = _seeds(src, items, p.rare)
        yield sc.broadcast((items, seeds, rare, seeds.bits()))


def contaminated(documents: DataFrame, benchmark: DataFrame, p: DecontamParams | None = None,
                 keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*keys, item_id, score, end_word): documents holding (edited) test items.

    One row per document row and item whose best passage scores at least
    ``threshold``.  Words are whitespace separated, A-Z lower-cased.  Null or
    empty texts and items match nothing; items shorter than ``n`` words are
    one seed; of several texts of one item id each is matched, and a document
    row is reported with the id once per text; repeated items count once;
    repeated documents are reported each; an empty benchmark or documents
    table gives no rows; extra columns are ignored.
    """
    p = p or DecontamParams()
    src = documents.select(*keys, "text")
    kind = benchmark.schema["item_id"].dataType
    schema = ", ".join(f"`{k}` {src.schema[k].dataType.simpleString()}" for k in keys)
    schema += f", item_id {kind.simpleString()}, score double, end_word long"
    id_type = to_arrow_type(kind)

    def finder(block):
        def align(batches):
            items, seeds, rare, bits = block.value
            for b in batches:
                rows, ids, score, stop = [], [], [], []
                for i, j, data, offsets in text_blocks(b):
                    _, _, row, h = words(data, offsets)
                    for a, k, s, e in align_block(items, seeds, rare, bits, h, row, j - i, p):
                        rows.append(i + a)
                        ids.append(items.ids[k])
                        score.append(s)
                        stop.append(e)
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c).take(take) for c in range(len(keys))], pa.array(ids, id_type),
                     pa.array(score, pa.float64()), pa.array(stop, pa.int64())],
                    [*keys, "item_id", "score", "end_word"])
        return align

    parts = [src.mapInArrow(finder(block), schema) for block in _plan(src, benchmark, p)]
    if not parts:
        return documents.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, p: DecontamParams | None = None) -> DataFrame:
    """The documents without those that hold a test item, all columns unchanged.

    A filter in one scan per block of test items: no shuffle.  Null cases as
    in ``contaminated``; a document without text stays.
    """
    p = p or DecontamParams()
    out = documents

    def dropper(block):
        def clean(batches):
            items, seeds, rare, bits = block.value
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for i, j, data, offsets in text_blocks(b):
                    _, _, row, h = words(data, offsets)
                    for a, *_ in align_block(items, seeds, rare, bits, h, row, j - i, p):
                        keep[i + a] = False
                yield b.filter(pa.array(keep))
        return clean

    for block in _plan(documents.select("text"), benchmark, p):
        out = out.mapInArrow(dropper(block), documents.schema)
    return out
