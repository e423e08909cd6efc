"""Connected components of a distributed edge list by label minima and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, c): every vertex of ``edges`` with the smallest vertex reachable from it.

    Each round a vertex takes the smallest label among its neighbours (partial
    minima before the shuffle, so a hub is cheap) and then its label's label.
    Labels, edges and round results are written tables; only the number of
    changed labels reaches the driver.
    """
    both = saved(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                 .unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v")))
                 .where("u <> v").distinct(), "cc_edges")
    label = saved(both.groupBy("u").agg(F.min("v").alias("m"))
                  .select(F.col("u").alias("v"), F.least("u", "m").alias("c")), "cc_labels")
    while True:
        near = (both.join(label, "v").groupBy("u").agg(F.min("c").alias("m"))
                .withColumnRenamed("u", "v"))
        low = label.join(near, "v").select("v", "c", F.least("c", "m").alias("m"))
        up = label.select(F.col("v").alias("p"), F.col("c").alias("pc"))
        step = F.least("m", "pc")
        new = saved(low.join(up, F.col("m") == F.col("p")).select(
            "v", step.alias("c"), (step != F.col("c")).alias("changed")), "cc_labels")
        label = new.select("v", "c")
        if not new.where("changed").limit(1).count():
            return label
