"""Hot keys: one user / one category holding a third of all rows.

Results must equal the brute-force models, and the hot key's work must be
split over several join keys / tasks rather than land on one.
"""

from contextlib import contextmanager

import numpy as np
from pyspark.sql import functions as F

from affinity.operators import cooccurrence as cco
from affinity.operators import similarity as sim
from affinity.params import CcoParams, Indicator
from affinity.session import shared_dir

from .test_cco_bruteforce import brute
from .test_similarity import _brute


def _skewed_edges(seed=3):
    rng = np.random.default_rng(seed)
    edges = set()
    for u in range(1, 40):                                   # ordinary users
        for _ in range(4):
            edges.add((str(rng.choice(["order", "cart", "click"])), u, int(rng.integers(0, 30))))
    hot = [("order" if i % 2 else "cart", 0, i % 30) for i in range(len(edges) // 2)]
    edges.update(hot)                                        # user 0: ~1/3 of all edges
    return sorted(edges)


def _frame(spark, edges):
    return spark.createDataFrame([(e, u, i, 1) for e, u, i in edges],
                                 "event string, user_id long, product_id long, event_uvs long")


def test_hot_user_is_split_and_exact(spark):
    edges = _skewed_edges()
    p = CcoParams(indicators=(Indicator("order", None, 5), Indicator("cart", None, 5),
                              Indicator("click", None, 5)),
                  hot_user_items=4, checkpoint=False)
    df = _frame(spark, edges)
    got = sorted((r.event, r.product_id, r.other_id, r.rank)
                 for r in cco.cross_occurrence(df, p).collect())
    assert got == [x[:3] + x[4:] for x in brute(edges, p)]


@contextmanager
def _conf(spark, **conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


SPLIT = {"spark.sql.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.coalescePartitions.enabled": "false",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k"}


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    df.collect()
    return qe.executedPlan().toString()


def _hot(spark, column):
    """200,000 edges, 90 % of them of one user or item, over many shuffle files."""
    other = "user_id" if column == "product_id" else "product_id"
    return (spark.range(0, 200_000, 1, 40)
            .select(F.lit("order").alias("event"), F.col("id").alias(other),
                    F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id")).cast("long").alias(column))
            .select(*cco.EDGE))


def test_joins_on_a_hot_item_and_a_hot_user_are_split(spark):
    p = CcoParams()
    with _conf(spark, **SPLIT):
        by_item = cco.with_item_counts(_hot(spark, "product_id"), p)
        plan = _executed(by_item)
        assert "SortMergeJoin(skew=true)" in plan, plan
        out = shared_dir(spark, "hot-item")
        by_item.write.parquet(out)                           # a file per task
        files = spark.read.parquet(out).where("product_id = 7").select(F.input_file_name()).distinct()
        assert files.count() > 1
        e = _hot(spark, "user_id")
        users = cco._keep(cco._primary_user_counts(e, F.lit("order"), p), p, "t")
        plan = _executed(cco.restricted(e, users))
        assert "SortMergeJoin(skew=true)" in plan, plan


def test_the_restriction_join_runs_once(spark, monkeypatch):
    seen = []
    real = cco.restricted
    monkeypatch.setattr(cco, "restricted", lambda e, u: seen.append(1) or real(e, u))
    df = _frame(spark, _skewed_edges())
    out = cco.cross_occurrence(df, CcoParams())
    assert len(seen) == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FlatMapCoGroupsInArrow") == 1     # only the blocked product is left


def test_hot_category_is_split_and_exact(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(90):
        cat = "0" if i % 3 == 0 or i < 30 else str(1 + i % 4)   # category 0 holds > 1/3
        rows.append((i, f"p{cat}", cat, [float(x) for x in rng.normal(size=4)]))
    df = spark.createDataFrame(rows, "product_id long, cat_path string, cat4cat string, "
                                     "vec array<double>")
    got = sorted(tuple(r)[:5] for r in sim.vector_similarity(df, k=6, block_size=8, strip_size=16,
                                                             chunk=5).collect())
    assert got == _brute(rows, 6)


def test_hot_item_is_exact(spark):
    rng = np.random.default_rng(11)
    edges = {(str(rng.choice(["order", "cart", "wish"])), int(u), int(rng.integers(1, 25)))
             for u in range(60) for _ in range(3)}
    edges |= {("order" if u % 2 else "cart", u, 0) for u in range(60)}   # item 0 everywhere
    edges = sorted(edges)
    p = CcoParams(indicators=(Indicator("order", None, 4), Indicator("cart", None, 4),
                              Indicator("wish", None, 4)), checkpoint=False)
    df = _frame(spark, edges)
    got = sorted((r.event, r.product_id, r.other_id, r.rank)
                 for r in cco.cross_occurrence(df, p).collect())
    assert got == [x[:3] + x[4:] for x in brute(edges, p)]
