"""Exact cosine neighbours in a large category without all of its products.

The rows of a category are clustered round pivots (rows of the category, the nearest
one wins).  A cluster has its pivot as centre and the largest angle to
it as radius; there are about as many clusters as a cluster has rows.  A row ``x`` can have no partner of a larger cosine in a
cluster than

    cos(max(0, angle(x, centre) - radius))

as angles are a metric on the sphere.  Whole clusters are dealt into blocks of rows
(a larger cluster into several).  Each row is first compared with its own
cluster (if that is too small for a list, with all of its block), which gives it a floor, the k-th score; the clusters whose
bound reaches the floor of a row are those the block has to meet, and no others are sent to
it.  There a row is multiplied with a cluster only if its bound reaches the
floor it has by then.  Ties at the floor are met: the bound is
rounded as scores are, with a margin for the arithmetic.

How much is skipped depends on the data: most of it where rows lie in groups,
little where they are spread evenly over many dimensions; the result is the same
(``pruning_report`` counts it).  However little is skipped, a row is sent to each block
at most once, and what the first pass keeps is one row per block and cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from . import nearest

#: Pivots of a category: the root of its rows, or one per ``cluster_rows``, but no more than this.
MOST_PIVOTS = 1024
_ROW = ["row_id", "product_id", "cat_path", "vec"]
_ASSIGNED = ("cat4cat string, row_id long, product_id long, cat_path string, vec array<double>, "
             "cluster int, angle double")
_CLUSTER = ["cat4cat", "cluster"]


def _unit(vec: pd.Series) -> np.ndarray:
    m = np.stack(vec.to_numpy()).astype(np.float64, copy=False)
    return m / np.linalg.norm(m, axis=1)[:, None]


def _assign(key, rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    """Nearest pivot of every row, and the angle to it."""
    if rows.empty:
        return pd.DataFrame({c.split(" ")[0]: [] for c in _ASSIGNED.split(", ")})
    pivots = pivots.sort_values("cluster", ignore_index=True)
    angle = np.arccos(np.clip(_unit(rows["vec"]) @ _unit(pivots["pivot"]).T, -1, 1))
    return pd.DataFrame({"cat4cat": rows["cat4cat"], **{c: rows[c] for c in _ROW},
                         "cluster": angle.argmin(axis=1).astype(np.int32), "angle": angle.min(axis=1)})


def _pivots(rows: DataFrame, sizes: DataFrame, cluster_rows: int) -> DataFrame:
    """(cat4cat, m, cluster, pivot): the ``m`` rows of smallest hash of each category."""
    # small clusters have small radii; finding the nearest pivots still costs less than comparing rows
    m = F.least(F.lit(MOST_PIVOTS), F.greatest(F.ceil(F.col("n") / F.lit(cluster_rows)), F.ceil(F.sqrt("n")))).cast("int")
    h = F.xxhash64(F.lit(1), "row_id")
    # about 2 m + 32 rows of a category reach the ranking, however large it is
    few = rows.join(sizes.select("cat4cat", "n", m.alias("m")), "cat4cat").where(
        F.pmod(h, F.col("n")) < 2 * F.col("m") + 32)
    w = Window.partitionBy("cat4cat").orderBy(h, "row_id")
    top = few.select("cat4cat", "m", (F.row_number().over(w) - 1).alias("cluster"), F.col("vec").alias("pivot"))
    return top.where(F.col("cluster") < F.col("m")).select("cat4cat", "cluster", "pivot")


def assigned(rows: DataFrame, sizes: DataFrame, cluster_rows: int, block_size: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their cluster and the angle to its pivot.

    ``sizes``: (cat4cat, n) of the categories to cluster.  Vectors without a direction are dropped.
    """
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    rows = rows.where((norm > 0) & (norm < float("inf")) & ~F.isnan(norm))
    # rows may have lost vectors: count what is left, so that every category has a pivot
    sizes = stored(rows.join(sizes.select("cat4cat"), "cat4cat").groupBy("cat4cat").agg(F.count(F.lit(1)).alias("n")),
                   "cluster_sizes")
    pivots = stored(_pivots(rows, sizes, cluster_rows), "cluster_pivots")
    parts = F.ceil(F.col("n") / F.lit(block_size)).cast("int")
    held = pivots.select("cat4cat").distinct().join(sizes, "cat4cat")
    # a string key of category and part: the join's partitioning does not serve for it, so parts spread
    key = F.concat_ws("/", "cat4cat", "part").alias("key")
    left = (rows.join(held, "cat4cat").withColumn("part", F.pmod(F.xxhash64("row_id"), parts))
            .select(key, "cat4cat", *_ROW))
    right = (pivots.join(held, "cat4cat").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select(key, "cluster", "pivot"))
    rows = left.groupBy("key").cogroup(right.groupBy("key")).applyInPandas(_assign, _ASSIGNED)
    return stored(rows, "clustered"), pivots


def neighbours(rows: DataFrame, sizes: DataFrame, k: int, block: Column, block_size: int, cluster_rows: int,
               chunk: int, tasks: int) -> tuple[DataFrame, DataFrame]:
    """(lists, visits): every row's k best partners of its category, ranked.

    ``block``: rows of a block, given ``n``.  visits: (key, cat4cat, cluster, z, guests), the clusters of ``z`` rows a block meets, and
    its rows that are compared with the cluster at home, or whose first floor its bound reaches.
    """
    a, pivots = assigned(rows, sizes, cluster_rows, block_size)
    # at most MOST_PIVOTS clusters of a category, laid end to end and cut into blocks
    z = a.groupBy(*_CLUSTER).agg(F.count(F.lit(1)).alias("z"), F.max("angle").alias("radius"))
    w = Window.partitionBy("cat4cat")
    before = w.orderBy("cluster").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    clusters = stored(z.select(*_CLUSTER, "z", "radius", (F.sum("z").over(before) - F.col("z")).alias("start"),
                               F.sum("z").over(w).alias("n")).withColumn("l", block), "clusters")
    key = F.concat_ws("/", "cat4cat", "blk")
    place = F.col("start") + F.pmod(F.xxhash64("row_id"), F.col("z"))
    cut = clusters.select(*_CLUSTER, "z", "start", "l")
    left = nearest.stream(a.join(cut, _CLUSTER).withColumn("blk", F.floor(place / F.col("l"))), nearest.LEFT, key)
    last = F.floor((F.col("start") + F.col("z") - 1) / F.col("l"))
    own = stored(clusters.withColumn("blk", F.explode(F.sequence(F.floor(F.col("start") / F.col("l")), last)))
                 .select(key.alias("key"), *_CLUSTER), "cluster_blocks")
    # a pivot no row chose is no cluster
    centre = nearest.stream(
        own.select("key", "cat4cat").distinct().join(pivots.join(clusters, _CLUSTER), "cat4cat")
        .withColumnRenamed("pivot", "vec").withColumnRenamed("z", "size"), nearest.PIVOT, F.col("key"))
    partners = a.select(*_CLUSTER, "product_id", "vec")
    home = nearest.stream(partners.join(own, _CLUSTER), nearest.HOME, F.col("key"))
    got = nearest.reach([left, centre, home], tasks, k, chunk)
    of = own.select("key", "cat4cat").distinct()
    visits = stored(got.join(of, "key").join(clusters.select(*_CLUSTER, "z"), _CLUSTER)
                    .select("key", *_CLUSTER, "side", "z", "guests"), "cluster_visits")
    met = nearest.stream(partners.join(visits.select("key", *_CLUSTER, "side"), _CLUSTER), F.col("side"), F.col("key"))
    return nearest.lists([left, centre, met], tasks, k, chunk), visits


def pruning_report(visits: DataFrame) -> DataFrame:
    """(cat4cat, rows, clusters, pairs, compared): row pairs of a category, and those not skipped."""
    made = visits.groupBy(*_CLUSTER).agg(F.first("z").alias("z"), F.sum(F.col("z") * F.col("guests")).alias("met"))
    return made.groupBy("cat4cat").agg(
        F.sum("z").alias("rows"), F.count(F.lit(1)).alias("clusters"),
        (F.sum("z") * F.sum("z")).alias("pairs"), F.sum("met").alias("compared"))
