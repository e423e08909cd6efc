"""Conflict-constrained best-fit packing of documents into training sequences.

Bins have a fixed capacity in tokens (words plus one end mark per piece).  A
bin keeps its residual and two bitmaps, of the sources and the duplicate
clusters it holds.  Pieces are placed largest first: the bins are ordered by
residual, the search starts at the tightest bin that is large enough and
goes on to its successors until one has neither the piece's source nor its
cluster; else a new bin is opened.  A cluster is a component of near
duplicates (the Jaccard join with its parameters), so near copies never share
a bin, whether they are alike themselves or by a chain of others.

Scale: pieces are dealt by hash, with a number that differs between repeated
rows and is written with them, into shards of about ``shard_pieces`` pieces,
each packed in one task, so a task's work does not grow with the input and a
source with a third of all rows is spread evenly over the shards.  Bins never
cross shards; the cost is a few partly filled bins per shard.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jaccard
from .common import bucket_count, saved
from .textcore import text_blocks, word_counts


@dataclass(frozen=True)
class PackParams:
    capacity: int = 2048
    shard_pieces: int = 4096


def best_fit(sizes, sources, clusters, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece; negative source or cluster never conflicts."""
    place: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    order: list[tuple[int, int]] = []              # (residual, bin), ascending
    bits: list[list[int]] = []                     # [source bitmap, cluster bitmap]
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        n = sizes[i]
        s = 1 << sources[i] if sources[i] >= 0 else 0
        c = 1 << clusters[i] if clusters[i] >= 0 else 0
        k = bisect_left(order, (n, -1))
        while k < len(order) and (bits[order[k][1]][0] & s or bits[order[k][1]][1] & c):
            k += 1
        if k < len(order):
            residual, b = order.pop(k)
        else:
            residual, b = capacity, len(bits)
            bits.append([0, 0])
        place[i] = (b, capacity - residual)
        bits[b][0] |= s
        bits[b][1] |= c
        entry = (residual - n, b)
        order.insert(bisect_left(order, entry), entry)
    return place


def pieces(documents: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, source, same, piece, start_word, end_word, n_tokens).

    A document longer than a bin is cut into full bins and a rest.  ``same``
    is a hash of the text, null without words.
    """
    src = documents.select("doc_id", F.col("source").cast("string").alias("source"), "text",
                           F.xxhash64("text").alias("same"))
    kind = src.schema["doc_id"].dataType.simpleString()
    room = capacity - 1

    def cut(batches):
        for b in batches:
            for i, j, data, offsets in text_blocks(b):
                n = word_counts(data, offsets)
                k = np.maximum(1, -(-n // room))
                own = np.repeat(np.arange(j - i), k)
                piece = np.arange(len(own)) - np.repeat(np.cumsum(k) - k, k)
                start = piece * room
                end = np.minimum(start + room, n[own])
                take = pa.array(own + i)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take),
                     pa.array(b.column(3).to_numpy()[own + i], mask=n[own] == 0),
                     pa.array(piece.astype(np.int32)), pa.array(start), pa.array(end),
                     pa.array((end - start + 1).astype(np.int32))],
                    ["doc_id", "source", "same", "piece", "start_word", "end_word", "n_tokens"])

    return src.mapInArrow(cut, f"doc_id {kind}, source string, same long, piece int, start_word long, "
                               "end_word long, n_tokens int")


def clusters(documents: DataFrame) -> DataFrame:
    """(same, cluster): the near-duplicate component of every text with words.

    The texts' hashes stand in for ids, so rows without an id and ids with
    several texts take part like all others.
    """
    texts = documents.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("doc_id"), "text")
    return (jaccard.near_duplicates(texts, links=False).where("n_shingles > 0")
            .groupBy(F.col("doc_id").alias("same")).agg(F.min("component_id").alias("cluster")))


def pack(documents: DataFrame, p: PackParams | None = None) -> DataFrame:
    """(doc_id, source, cluster, piece, start_word, end_word, n_tokens, bin_id, bin_offset).

    Every piece of every document is in exactly one bin; no bin holds more
    than ``capacity`` tokens, two pieces of one source, or two of one cluster (so
    copies, near copies and pieces of one document never share a bin).  Null
    sources conflict with nothing; null and empty texts are one piece of one
    token without a cluster; repeated rows are packed each; an empty table
    gives no rows; extra columns are ignored.
    """
    p = p or PackParams()
    rows = saved(pieces(documents, p.capacity).withColumn("salt", F.monotonically_increasing_id()), "pack_pieces")
    shards = bucket_count(rows.count(), p.shard_pieces)
    # both written, so that a text with very many copies is an ordinary skewed join
    rows = (rows.join(saved(clusters(documents), "pack_clusters"), "same", "left")
            .select("doc_id", "source", "cluster", *rows.columns[3:]))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "cluster", "salt"), F.lit(shards)).cast("int")

    def fill(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([(c, "ascending") for c in ("doc_id", "piece", "cluster", "source")])
        codes = [pc.fill_null(table[c].combine_chunks().dictionary_encode().indices, -1).to_pylist()
                 for c in ("source", "cluster")]
        got = best_fit(table["n_tokens"].to_pylist(), *codes, p.capacity)
        first = table["shard"][0].as_py() << 20
        return (table.drop_columns(["shard", "salt"])
                .append_column("bin_id", pa.array([first + b for b, _ in got], pa.int64()))
                .append_column("bin_offset", pa.array([o for _, o in got], pa.int32())))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("salt").schema.fields)
    return (rows.withColumn("shard", shard).groupBy("shard")
            .applyInArrow(fill, schema + ", bin_id long, bin_offset int"))
