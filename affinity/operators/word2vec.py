"""Skip-gram word vectors with negative sampling, partitioned by blocks of words.

No task and no driver ever holds the vocabulary: words are hashed into B blocks
of about ``block_words``, and a pair of blocks (i, j) is a cell that holds the
counts of center words of i with context words of j and trains on exactly
those center and context vectors.  The cells (i, i + s mod B) of a turn s share no
block, so they run side by side without conflict; B turns are an epoch.

Nothing depends on the number of tasks or the order rows arrive in: a cell sorts its rows,
draws negatives and the order of its pairs from a generator seeded by (seed, epoch, i, j),
and first vectors come from the words' hashes.  Two runs agree bit by bit.

A pair that occurs n times counts sqrt(n); negatives come from the cell's own context
words, by their frequency to the 3/4.  Steps are scaled per word by the
squares of its gradients so far (Adagrad, one number a word).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Words on each side of a center word that are its contexts.
WINDOW = 5
BLOCK_WORDS = 4096
_STATE = "kind int, blk int, word string, n bigint, vec array<float>, acc float"


def vocabulary(items: DataFrame, min_count: int) -> DataFrame:
    """(word, n) of the words with at least ``min_count`` occurrences."""
    return (items.select(F.explode("text").alias("word")).where("word IS NOT NULL").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def pair_counts(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(c, o, n): how often ``o`` stands within ``window`` words of ``c``."""
    t = items.select("text", F.posexplode("text").alias("i", "c"))
    low = F.greatest(F.col("i") - window, F.lit(0))
    before = F.slice("text", low + 1, F.col("i") - low)
    after = F.slice("text", F.col("i") + 2, F.lit(window))
    return (t.select("c", F.explode(F.concat(before, after)).alias("o")).where("c IS NOT NULL AND o IS NOT NULL")
            .groupBy("c", "o").agg(F.count(F.lit(1)).alias("n")))


def first_vectors(words: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """Uniform in (-1/2, 1/2) / dim, from the hash of word, component and seed."""
    with np.errstate(over="ignore"):
        x = (pd.util.hash_array(words, categorize=False)[:, None] + np.uint64(seed)
             + np.arange(1, dim + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (((x >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 - 0.5) / dim).astype(np.float32)


def train_cell(u, v, ua, va, c, o, n, noise, rng, passes: int, negative: int, rate: float, batch: int) -> None:
    """Mini-batch steps on one cell, in place.

    u, v: center and context vectors; ua, va: their squared gradients; c, o, n: pairs and
    counts; noise: cumulative frequency of the context words.
    """
    weight = np.sqrt(n).astype(np.float32)
    for _ in range(passes):
        order = rng.permutation(len(c))
        for s in range(0, len(c), batch):
            k = order[s:s + batch]
            drawn = np.minimum(np.searchsorted(noise, rng.random((len(k), negative))), len(v) - 1)
            ctx = np.concatenate([o[k][:, None], drawn], axis=1)
            x = np.einsum("bd,bkd->bk", u[c[k]], v[ctx])
            g = -1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))
            g[:, 0] += 1.0
            g = (g * weight[k][:, None]).astype(np.float32)
            gu = np.einsum("bk,bkd->bd", g, v[ctx])
            gv = (g[:, :, None] * u[c[k]][:, None, :]).reshape(-1, u.shape[1])
            for m, acc, at, grad in ((u, ua, c[k], gu), (v, va, ctx.ravel(), gv)):
                order_at = np.argsort(at, kind="stable")
                rows, starts = np.unique(at[order_at], return_index=True)
                total = np.add.reduceat(grad[order_at], starts, axis=0)
                acc[rows] += np.einsum("rd,rd->r", total, total) / total.shape[1]
                m[rows] += rate * total / np.sqrt(acc[rows] + 1e-8)[:, None]


def _cell(turn: int, epoch: int, seed: int, dim: int, passes: int, negative: int, rate: float, batch: int):
    schema = pa.schema([("kind", pa.int32()), ("blk", pa.int32()), ("word", pa.string()), ("n", pa.int64()),
                        ("vec", pa.list_(pa.float32())), ("acc", pa.float32())])

    def side(t: pa.Table, kind: int):
        t = t.filter(pa.compute.equal(t.column("kind"), kind)).sort_by("word")
        words = t.column("word").combine_chunks().to_numpy(zero_copy_only=False)
        if t.column("vec").null_count:                          # the first turn
            m = first_vectors(words, dim, seed) if kind == 0 else np.zeros((len(words), dim), np.float32)
        else:
            m = t.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim).copy()
        return t, words, m, t.column("acc").combine_chunks().to_numpy().copy()

    def run(pairs: pa.Table, state: pa.Table) -> pa.Table:
        if not len(state):
            return schema.empty_table()
        both = [side(state, 0), side(state, 1)]
        (_, cw, u, ua), (ot, ow, v, va) = both
        if len(pairs) and len(cw) and len(ow):
            pairs = pairs.sort_by([("c", "ascending"), ("o", "ascending")])
            c, o, n = (pairs.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in ("c", "o", "n"))
            freq = ot.column("n").combine_chunks().to_numpy().astype(np.float64) ** 0.75
            noise = np.cumsum(freq) / freq.sum()
            at = int(state.column("key")[0].as_py())
            rng = np.random.default_rng([seed, epoch, at, turn])
            train_cell(u, v, ua, va, np.searchsorted(cw, c), np.searchsorted(ow, o), n, noise, rng, passes,
                       negative, rate, batch)
        out = []
        for t, _, m, acc in both:
            vec = pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, dim), pa.int32()), pa.array(m.ravel()))
            out.append(pa.Table.from_arrays([t.column(k).combine_chunks() for k in ("kind", "blk", "word", "n")]
                                            + [vec, pa.array(acc)], schema=schema))
        return pa.concat_tables(out)
    return run


def train(items: DataFrame, dim: int, min_count: int = 0, seed: int = 42, window: int = WINDOW, epochs: int = 2,
          passes: int = 8, negative: int = 5, rate: float = 0.1, batch: int = 4096,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, vec array<double>) of the words of ``text`` (array<string>).

    Null texts and words are skipped; without any word the result is empty.
    """
    words = stored(vocabulary(items, min_count), "w2v_words")
    blocks = math.ceil(words.count() / block_words)
    if not blocks:
        return words.select("word", F.array().cast("array<double>").alias("vec"))

    def block(word: str):
        return F.pmod(F.xxhash64(word), F.lit(blocks)).cast("int")

    known = words.select("word")
    pairs = pair_counts(items, window)
    if min_count > 1:
        pairs = pairs.join(known.withColumnRenamed("word", "c"), "c", "left_semi").join(
            known.withColumnRenamed("word", "o"), "o", "left_semi")
    pairs = stored(pairs.select("c", "o", "n", block("c").alias("cb"), block("o").alias("ob")), "w2v_pairs")
    state = stored(words.select(
        F.explode(F.array(F.lit(0), F.lit(1))).alias("kind"), block("word").alias("blk"), "word", "n",
        F.lit(None).cast("array<float>").alias("vec"), F.lit(0.0).cast("float").alias("acc")), "w2v_state")
    for epoch in range(epochs):
        for turn in range(blocks):
            cell = pairs.where(F.pmod(F.col("ob") - F.col("cb"), F.lit(blocks)) == turn).select(
                F.col("cb").alias("key"), "c", "o", "n")
            at = F.when(F.col("kind") == 0, F.col("blk")).otherwise(F.pmod(F.col("blk") - turn, F.lit(blocks)))
            state = stored(cell.groupBy("key").cogroup(state.withColumn("key", at).groupBy("key")).applyInArrow(
                _cell(turn, epoch, seed, dim, passes, negative, rate, batch), _STATE), "w2v_state")
    return state.where("kind = 0").select("word", F.col("vec").cast("array<double>").alias("vec"))
