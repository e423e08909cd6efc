"""Hashed sparse logistic regression with follow-the-regularised-leader updates.

Rows carry a binary feature list; a model is one float32 weight per hash slot
plus a bias, so its size is fixed by ``dim`` whatever the data.
Training runs FTRL-proximal inside ``shards`` groups and averages their
weights; scoring is a sparse dot product per document in one scan.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textcore import BASE, mix, runs, text_blocks

SPACE, LETTER, DIGIT, PUNCT = 0, 1, 2, 3
_CLASS = np.full(256, PUNCT, np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = SPACE
_CLASS[48:58] = DIGIT
_CLASS[65:91] = LETTER
_CLASS[97:123] = LETTER
_CLASS[128:] = LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class FtrlParams:
    """dim: hash slots (a power of two); max_rows: bound of the training
    sample; shards: most models trained side by side and averaged, each on
    ``shard_rows`` rows or more; updates: least number of updates of a model
    (small samples get more epochs, at most ``most_epochs``); l1 is the
    penalty at ``updates`` updates and grows with their number."""

    dim: int = 1 << 18
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.2
    l2: float = 1.0
    epochs: int = 3
    most_epochs: int = 60
    updates: int = 18_000
    shards: int = 6
    shard_rows: int = 2_000
    max_rows: int = 18_000
    seed: int = 7


class Tokens:
    """Runs of letters, digits or punctuation of a text block."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        from .textcore import Prefix
        cls = _CLASS[data]
        parts = [runs(cls == c, offsets) for c in (LETTER, DIGIT, PUNCT)]
        kind = np.concatenate([np.full(len(p[0]), c, np.uint8) for c, p in zip((1, 2, 3), parts)])
        s, e, row = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.argsort(s, kind="stable")
        self.s, self.e, self.row, self.kind = s[order], e[order], row[order], kind[order]
        self.prefix = Prefix(_LOWER[data])
        self.hash = self.prefix.of(self.s, self.e)
        upper = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data >= 65) & (data <= 90), out=upper[1:])
        n = upper[self.e] - upper[self.s]
        self.shouted = (n >= 2) & (self.kind == LETTER)


def _slots(h: np.ndarray, salt: int, dim: int) -> np.ndarray:
    return (mix(h + np.uint64(salt * int(BASE) % (1 << 64))) & np.uint64(dim - 1)).astype(np.int64)


def word_ngram_features(data, offsets, dim: int):
    """(row, slot) of every word 1- and 2-gram and token-shape 1- to 3-gram.

    The shape of a token is its class, whether it is shouted, and whether it
    repeats the token before; a punctuation run keeps its own characters.
    """
    t = Tokens(data, offsets)
    if not len(t.s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same_row = np.r_[False, t.row[1:] == t.row[:-1]]
    repeat = same_row & np.r_[False, t.hash[1:] == t.hash[:-1]]
    shape = t.kind.astype(np.uint64) + np.uint64(8) * t.shouted + np.uint64(16) * repeat
    shape = np.where(t.kind == PUNCT, t.hash, mix(shape))
    rows, slots = [t.row], [_slots(t.hash, 1, dim)]
    for seq, orders in ((t.hash, (2,)), (shape, (1, 2, 3))):
        for n in orders:
            if len(seq) < n:
                continue
            acc = np.zeros(len(seq) - n + 1, np.uint64)
            for j in range(n):
                acc = acc * BASE + seq[j:len(seq) - n + 1 + j]
            ok = t.row[:len(acc)] == t.row[n - 1:]
            rows.append(t.row[:len(acc)][ok])
            slots.append(_slots(acc[ok], 16 + n + 8 * (seq is shape), dim))
    return np.concatenate(rows), np.concatenate(slots)


def unique_pairs(row: np.ndarray, slot: np.ndarray, dim: int):
    """Distinct (row, slot) with their counts, ordered by row."""
    key, n = np.unique(row * dim + slot, return_counts=True)
    return key // dim, key % dim, n


def log_tf(row, n, rows: int) -> np.ndarray:
    """(1 + log count), scaled to unit length per row."""
    v = 1.0 + np.log(n)
    norm = np.sqrt(np.bincount(row, v * v, rows))
    return v / norm[row]


def presence(row, n, rows: int) -> np.ndarray:
    return np.ones(len(n))


@dataclass(frozen=True)
class FeatureMap:
    """features(bytes, offsets, dim) -> (row, slot); value(row, count, rows)."""

    features: Callable
    value: Callable

    def sparse(self, data, offsets, dim: int):
        rows = len(offsets) - 1
        r, s = self.features(data, offsets, dim)
        r, s, n = unique_pairs(r, s, dim)
        return r, s, self.value(r, n, rows)


def ftrl(examples, dim: int, p: FtrlParams) -> np.ndarray:
    """Weights (last one the bias) after FTRL-proximal over (slots, values, y)."""
    z, n = np.zeros(dim + 1), np.zeros(dim + 1)
    epochs = min(p.most_epochs, max(p.epochs, math.ceil(p.updates / max(1, len(examples)))))
    l1 = p.l1 * epochs * len(examples) / p.updates

    def weights(i):
        zi = z[i]
        w = (np.sign(zi) * l1 - zi) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2)
        return np.where(np.abs(zi) > l1, w, 0.0)

    order = np.random.default_rng(p.seed)
    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            i, v, y = examples[k]
            w = weights(i)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ v, -35, 35))) - y) * v
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / p.alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(dim + 1)).astype(np.float32)


def bounded_sample(rows: DataFrame, id_col: str, max_rows: int, seed: int, *then: str) -> DataFrame:
    """At most ``max_rows`` rows, those of the smallest hash of the id (then in the order of ``then``)."""
    return (rows.withColumn("_o", F.xxhash64(F.col(id_col), F.lit(seed)))
            .orderBy("_o", id_col, *then).limit(max_rows).drop("_o"))


def train(sample: DataFrame, fm: FeatureMap, p: FtrlParams) -> np.ndarray:
    """Averaged weights over a bounded sample with columns doc_id, text, y.

    Returns zeros for an empty sample.  The driver receives ``shards`` weight
    vectors of ``dim + 1`` floats, a size that does not depend on the data.
    """
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"], kind="stable")
        batch = pa.RecordBatch.from_pydict({"text": pa.array(pdf["text"].tolist(), pa.string())})
        y = pdf["y"].to_numpy(float)
        ex = []
        for i, j, data, offsets in text_blocks(batch):
            r, s, v = fm.sparse(data, offsets, p.dim)
            cut = np.searchsorted(r, np.arange(j - i + 1))
            ex.extend((np.r_[s[a:b], p.dim], np.r_[v[a:b], 1.0], y[i + q])
                      for q, (a, b) in enumerate(zip(cut[:-1], cut[1:])))
        return pd.DataFrame({"n": [len(ex)], "w": [ftrl(ex, p.dim, p).tobytes()]})

    shards = max(1, min(p.shards, sample.count() // p.shard_rows))
    shard = F.pmod(F.xxhash64("doc_id", F.lit(p.seed + 1)), F.lit(shards))
    got = (sample.select("doc_id", "text", F.col("y").cast("double").alias("y"), shard.alias("shard"))
           .groupBy("shard").applyInPandas(fit, "n long, w binary").collect())
    if not got:
        return np.zeros(p.dim + 1, np.float32)
    total = sum(g.n for g in got)
    return sum(np.frombuffer(g.w, np.float32) * (g.n / total) for g in got).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, fm: FeatureMap, dim: int,
          id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, score): probability of label 1 of every whole text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(weights)     # dim + 1 floats
    cols = [id_col, *[c for c in keep if c != "text"], "text"]
    src = docs.select(*cols)
    out = [f for f in src.schema.fields if f.name != "text" or "text" in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out) + ", score double"

    def run(batches):
        w = shared.value.astype(np.float64)
        for b in batches:
            s = np.zeros(b.num_rows)
            for i, j, data, offsets in text_blocks(b):
                r, slot, v = fm.sparse(data, offsets, dim)
                s[i:j] = np.bincount(r, w[slot] * v, j - i)
            p = 1.0 / (1.0 + np.exp(-np.clip(s + w[dim], -35, 35)))
            names = [f.name for f in out]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in names] + [pa.array(p)], [*names, "score"])

    return src.mapInArrow(run, schema)
