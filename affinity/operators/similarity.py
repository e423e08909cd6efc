"""Item text vectors and exact in-category top-k cosine neighbours.

``item_desc``      catalogue -> (product_id, cat_path, cat4cat, text tokens)
``text_vectors``   mean word vectors (``word2vec``) per item row
``vector_similarity``  top-k neighbours by cosine among rows of the same
                   category, excluding the item itself

Every input row has a list of its own, also when an item comes several times
with different texts.

The all-pairs product inside a category grows as n_c^2, and one category
may hold a large share of all items: exact neighbours cost n_c^2 * dim
multiplications.  It is computed as a blocked matrix product:

* each category is hashed into left blocks of at least ``block_size`` and at
  most ``strip_size`` rows, about eight up to that size, and every row of the
  category is sent to each of its blocks once;
* one task per block holds the block's unit vectors and lists and reads
  the partners as a sorted stream (``nearest``), so its memory does not grow with the
  category; it keeps a running exact top-k per row in the final order (score
  desc, partner id asc), and a row's list leaves it once, ranked.

A category of more than ``CLUSTER_ROWS`` rows is clustered first, and a block
is only sent the clusters that can hold a neighbour (``clusters``).

No item pair is ever a row, candidates are not shuffled, nothing goes through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import category_of_path, tokens
from ..params import NEIGHBOURS, W2V_DIM, W2V_MIN_COUNT
from ..session import stored
from ..sources.tables import CatalogueTables
from . import clusters, nearest, word2vec
from .nearest import round5  # noqa: F401

SIM_COLUMNS = ("product_id", "cat_path", "other_id", "score", "rank")
#: Bytes of word vectors up to which every task looks words up in a table of its own.
LOOKUP_BYTES = 64 << 20
#: Words of a block, and words of item rows that meet one, beyond that size.
LOOKUP_WORDS, LOOKUP_TOKENS = 8192, 2_000_000
#: Rows of a category from which it is clustered before rows are compared.
CLUSTER_ROWS = 32768
#: Blocks of a category until they reach ``strip_size`` rows; pairs and rows a task is sized for.
BLOCKS, TASK_PAIRS, TASK_ROWS = 8, 1 << 28, 1 << 20


def item_desc(cat: CatalogueTables) -> DataFrame:
    """(product_id, cat_path, cat4cat, text): one row per product text and category."""
    d = cat.products_description.where(F.col("products_name").isNotNull())
    c = cat.products_to_categories.where(F.col("cat_path").isNotNull())
    return d.join(c, "products_id").select(
        F.col("products_id").alias("product_id"), "cat_path",
        category_of_path(F.col("cat_path")).alias("cat4cat"),
        tokens(F.col("products_name")).alias("text"))


def _word_sums(words: np.ndarray, m: np.ndarray, row: np.ndarray, token: np.ndarray):
    """(rows, their sums) of the vectors of tokens, given sorted words; unknown tokens are left out."""
    at = np.minimum(np.searchsorted(words, token), max(len(words) - 1, 0))
    ok = words[at] == token if len(words) else np.zeros(len(token), bool)
    order = np.lexsort((at[ok], row[ok]))                  # one order of summation, however rows arrive
    at, row = at[ok][order], row[ok][order]
    rows, starts = np.unique(row, return_index=True)
    parts = []
    for s in range(0, len(rows), 4096):                    # bounds the vectors gathered at a time
        lo, hi = starts[s], starts[s + 4096] if s + 4096 < len(rows) else len(at)
        parts.append(np.add.reduceat(m[at[lo:hi]], starts[s:s + 4096] - lo, axis=0))
    return rows, np.concatenate(parts) if parts else np.zeros((0, m.shape[1]))


def _packed(words: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted words and their vectors as a matrix."""
    t = words.sort_by("word")
    w = t.column("word").combine_chunks().to_numpy(zero_copy_only=False)
    flat = t.column("vec").combine_chunks().flatten().to_numpy()
    return w, flat.reshape(len(w), -1) if len(w) else np.zeros((0, 0))


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))


def _tokens_of(b) -> tuple[np.ndarray, np.ndarray]:
    """(row in the batch, token) of every non-null token of a batch's ``text``."""
    text = b.column("text")
    parent = pa.compute.list_parent_indices(text).to_numpy(zero_copy_only=False)
    flat = pa.compute.list_flatten(text)
    ok = pa.compute.is_valid(flat).to_numpy(zero_copy_only=False)
    return parent[ok], flat.to_numpy(zero_copy_only=False)[ok]


def mean_word_vectors(items: DataFrame, words: DataFrame, lookup_bytes: int = LOOKUP_BYTES,
                      block_words: int = LOOKUP_WORDS, block_tokens: int = LOOKUP_TOKENS) -> DataFrame:
    """(product_id, cat_path, cat4cat, vec): the mean vector of each item row's words.

    ``words`` is (word, vec).  The sum runs over the known words and is
    divided by the number of all words, as Word2Vec's transform does; a row
    without a known word has no vector and is dropped.

    Up to ``lookup_bytes`` of vectors every task has them all, and nothing is shuffled.
    Beyond, words are dealt into blocks and item rows into as many blocks as
    their words need; tokens meet vectors in (word block, row block) groups, which
    return one sum per row, so no vector is ever copied per token.
    """
    spark = items.sparkSession
    w = stored(words.select("word", F.col("vec").cast("array<double>").alias("vec")), "similarity_words")
    n, size = w.agg(F.count(F.lit(1)), F.coalesce(F.sum(8 * F.size("vec") + F.length("word")), F.lit(0))).first()
    out = "product_id bigint, cat_path string, cat4cat string, vec array<double>"
    if size <= lookup_bytes:
        shared = spark.sparkContext.broadcast(_packed(w.toArrow()))      # at most lookup_bytes, counted above

        def look_up(batches):
            known, m = shared.value
            for b in batches:
                row, token = _tokens_of(b)
                rows, sums = _word_sums(known, m, row, token)
                length = pa.compute.list_value_length(b.column("text")).to_numpy(zero_copy_only=False)
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c).take(take) for c in ("product_id", "cat_path", "cat4cat")],
                     _lists(sums / length[rows][:, None])], ["product_id", "cat_path", "cat4cat", "vec"])

        return items.select("product_id", "cat_path", "cat4cat", "text").mapInArrow(look_up, out)

    rows = stored(items.select("product_id", "cat_path", "cat4cat", "text").withColumn(
        "row_id", F.monotonically_increasing_id()), "similarity_items")
    word_blocks = -(-n // block_words)
    tokens = rows.agg(F.coalesce(F.sum(F.greatest(F.size("text"), F.lit(0))), F.lit(0))).first()[0]
    row_blocks = max(1, -(-tokens // (word_blocks * block_tokens)))
    wb = F.pmod(F.xxhash64("word"), F.lit(word_blocks)).cast("int")
    left = (rows.select(F.pmod(F.xxhash64("row_id"), F.lit(row_blocks)).cast("int").alias("rb"), "row_id",
                        F.explode("text").alias("word")).where("word IS NOT NULL").withColumn("wb", wb))
    right = w.select("word", "vec", wb.alias("wb"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"))
    part = pa.schema([("row_id", pa.int64()), ("wb", pa.int32()), ("s", pa.list_(pa.float64()))])

    def sums_of(tokens: pa.Table, known: pa.Table) -> pa.Table:
        if not len(tokens) or not len(known):
            return part.empty_table()
        token, row = (tokens.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("word", "row_id"))
        found, s = _word_sums(*_packed(known.select(["word", "vec"])), row, token)
        block = np.full(len(found), known.column("wb")[0].as_py())
        return pa.Table.from_arrays([pa.array(found), pa.array(block, pa.int32()), _lists(s)], schema=part)

    sums = left.groupBy("wb", "rb").cogroup(right.groupBy("wb", "rb")).applyInArrow(
        sums_of, "row_id bigint, wb int, s array<double>")
    # a row has at most one sum per word block; added in the order of the blocks
    add = F.aggregate(F.slice("l", 2, F.size("l")), F.col("l")[0]["s"],
                      lambda a, x: F.zip_with(a, x["s"], lambda p, q: p + q))
    total = sums.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("wb", "s"))).alias("l")).select(
        "row_id", add.alias("s"))
    return rows.join(total, "row_id").select(
        "product_id", "cat_path", "cat4cat", F.transform("s", lambda x: x / F.size("text")).alias("vec"))


def text_vectors(items: DataFrame, dim: int = W2V_DIM, min_count: int = W2V_MIN_COUNT,
                 seed: int = 42) -> DataFrame:
    """Word vectors trained on the item texts; (product_id, cat_path, cat4cat, vec)."""
    return mean_word_vectors(items, word2vec.train(items, dim, min_count, seed))


def vector_similarity(vectors: DataFrame, k: int = NEIGHBOURS, block_size: int = 4096,
                      strip_size: int = 32768, chunk: int = 2048, cluster_rows: int = CLUSTER_ROWS) -> DataFrame:
    """(product_id, cat_path, other_id, score, rank, row_id) within ``cat4cat``.

    ``vectors``: product_id, cat_path, cat4cat, vec (array<double>).  The
    score is the cosine rounded to 5 places; rank orders by score desc,
    then partner id.  Zero vectors have no cosine and are dropped.  Each
    vector row gets its own list (``row_id``), and repeated items are
    partners once per row, never of themselves.

    A category of n rows is hashed into blocks of n / BLOCKS rows, at least
    ``block_size`` and at most ``strip_size``; each is one task that streams
    the category in ``chunk``-row slices and keeps a running exact top-k
    per row.  Every row is sent to each block of its category once.

    A category of more than ``cluster_rows`` rows is clustered first, and
    pairs of rows that cannot be neighbours are not compared (``clusters``).
    """
    return _neighbours(vectors, k, block_size, strip_size, chunk, cluster_rows)[0]


def skipped_pairs(vectors: DataFrame, k: int = NEIGHBOURS, block_size: int = 4096, strip_size: int = 32768,
                  chunk: int = 2048, cluster_rows: int = CLUSTER_ROWS) -> DataFrame:
    """(cat4cat, rows, clusters, pairs, compared) of the categories ``vector_similarity`` clusters."""
    visits = _neighbours(vectors, k, block_size, strip_size, chunk, cluster_rows)[1]
    if visits is None:
        return vectors.sparkSession.createDataFrame(
            [], "cat4cat string, rows long, clusters long, pairs long, compared long")
    return clusters.pruning_report(visits)


def _neighbours(vectors, k, block_size, strip_size, chunk, cluster_rows):
    """(neighbours, visits of the clustered categories or None)."""
    spark = vectors.sparkSession
    v = (vectors.where(F.col("vec").isNotNull() & F.col("cat4cat").isNotNull()
                       & F.col("product_id").isNotNull())
         .select("product_id", "cat_path", "cat4cat", "vec",
                 F.monotonically_increasing_id().alias("row_id")))
    # written tables: row ids are fixed, and the size join is a plain exchange
    # that AQE can split on a large category
    v = stored(v, "similarity_vectors")
    block = F.least(F.lit(strip_size), F.greatest(F.lit(block_size), F.ceil(F.col("n") / F.lit(BLOCKS)))).cast("long")
    sizes = stored(v.groupBy("cat4cat").agg(F.count(F.lit(1)).alias("n")).withColumn("l", block)
                   .withColumn("nl", F.ceil(F.col("n") / F.col("l"))), "similarity_sizes")
    pairs, copies, blocks, most = sizes.agg(F.sum(F.col("n").cast("double") * F.col("n")), F.sum(F.col("n") * F.col("nl")),
                                            F.sum("nl"), F.max("n")).first()
    tasks = int(min(blocks or 1, max(int(spark.conf.get("spark.sql.shuffle.partitions")), (pairs or 0) // TASK_PAIRS,
                                     (copies or 0) // TASK_ROWS)))
    clustered = (most or 0) > cluster_rows
    small = v.join(sizes.where(F.col("n") <= cluster_rows), "cat4cat")
    key = F.concat_ws("/", "cat4cat", "blk")
    left = nearest.stream(small.withColumn("blk", F.floor(F.pmod(F.xxhash64("row_id"), F.col("n")) / F.col("l")))
                          .drop("n"), nearest.LEFT, key)
    right = nearest.stream(small.select("cat4cat", "product_id", "vec", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("nl") - 1)).alias("blk")), nearest.HOME, key)
    found, visits = nearest.lists([left, right], tasks, k, chunk), None
    if clustered:
        large = sizes.where(F.col("n") > cluster_rows).select("cat4cat", "n")
        more, visits = clusters.neighbours(v, large, k, block, block_size, cluster_rows, chunk, tasks)
        found = found.unionByName(more)
    return found.select(*SIM_COLUMNS, "row_id"), visits


def text_similarity(cat: CatalogueTables, k: int = NEIGHBOURS, dim: int = W2V_DIM,
                    min_count: int = W2V_MIN_COUNT, seed: int = 42, words: DataFrame | None = None) -> DataFrame:
    """Item vectors by word vectors, then ``vector_similarity`` within categories.

    ``words`` (word, vec), from ``word2vec.train``, is applied where given; else
    the vectors are trained on the catalogue itself.
    """
    items = stored(item_desc(cat), "similarity_desc")
    vectors = text_vectors(items, dim, min_count, seed) if words is None else mean_word_vectors(items, words)
    return vector_similarity(vectors, k)
