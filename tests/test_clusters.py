"""Clustered neighbour search against brute force, and what it skips."""

import numpy as np

from affinity.operators import similarity as sim

from .test_similarity import _brute, _vectors

SCHEMA = "product_id long, cat_path string, cat4cat string, vec array<double>"


def _grouped(n=400, groups=16, dim=12, spread=0.05, seed=4):
    """Rows close round a few directions, one category, some zero and opposite vectors, a small category."""
    r = np.random.default_rng(seed)
    centre = r.normal(size=(groups, dim))
    rows = [(i, "c-0", "big", [float(x) for x in centre[i % groups] + spread * r.normal(size=dim)]) for i in range(n)]
    rows += [(n + 1, "c-0", "big", [0.0] * dim), (n + 2, "c-0", "big", [float(-x) for x in centre[0]])]
    return rows + [(n + 10 + i, "c-1", "small/1", [float(x) for x in r.normal(size=dim)]) for i in range(9)]


def _lists(df):
    return sorted(tuple(r)[:5] for r in df.collect())


def test_clustered_equals_brute_force_and_skips_most_pairs_of_grouped_rows(spark):
    rows = _grouped()
    df = spark.createDataFrame(rows, SCHEMA)
    args = dict(k=5, block_size=50, strip_size=64, chunk=16, cluster_rows=20)
    assert _lists(sim.vector_similarity(df, **args)) == _brute(rows, 5)
    (r,) = sim.skipped_pairs(df, **args).collect()
    assert (r.cat4cat, r.rows, r.pairs) == ("big", 401, 401 ** 2) and r.clusters > 10
    assert r.compared < 0.5 * r.pairs, r


def test_even_rows_ties_and_small_clusters_lose_nothing(spark):
    for dup in (True, False):                     # many exact ties; rows without groups
        df, rows = _vectors(spark, n=90, dup=dup)
        got = _lists(sim.vector_similarity(df, k=7, block_size=9, strip_size=11, chunk=4, cluster_rows=6))
        assert got == _brute(rows, 7)             # clusters hold fewer than k rows: no floor, all visited


def test_zero_vectors_only_and_nothing_large(spark):
    zero = spark.createDataFrame([(i, "c", "c", [0.0, 0.0]) for i in range(20)], SCHEMA)
    assert sim.vector_similarity(zero, k=3, cluster_rows=4).collect() == []
    assert sim.skipped_pairs(zero, k=3).collect() == []


def test_repeated_items_are_never_their_own_partners(spark):
    r = np.random.default_rng(1)
    rows = [(i % 15, "c", "c", [float(x) for x in r.normal(size=3)]) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(1)
    a, b = (sorted(map(tuple, sim.vector_similarity(df, k=6, block_size=8, strip_size=8, chunk=8, cluster_rows=c)
                       .drop("row_id").collect())) for c in (10, 1000))
    assert a == b and all(x[0] != x[2] for x in a)


def test_a_row_is_sent_to_a_block_at_most_once_however_small_the_clusters(spark):
    df, rows = _vectors(spark, n=400, dim=16, cats=1, dup=False)          # even rows: next to nothing is skipped
    found, visits = sim._neighbours(df, 5, 100, 100, 64, 8)
    got = [(r.key, r.cluster, r.z) for r in visits.collect()]
    assert len(got) == len({g[:2] for g in got}) and len({g[1] for g in got}) > 30
    assert sum(g[2] for g in got) <= 400 * 4                              # four blocks of 100 rows
    assert _lists(found) == _brute(rows, 5)


def test_lists_of_a_stream_need_the_block_only_and_take_any_ids():
    import tracemalloc

    import pyarrow as pa

    from affinity.operators import nearest

    r = np.random.default_rng(5)

    def batch(ids):
        m = r.normal(size=(len(ids), 8))
        vec = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * 8, pa.int32()), pa.array(m.ravel()))
        return m, pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(ids), pa.array(["c"] * len(ids)), pa.nulls(len(ids), pa.int32()), vec],
            ["product_id", "row_id", "cat_path", "cluster", "vec"])

    for scale in (1, 1 << 47):                            # ids that do and do not fit beside a score
        m, left = batch(np.arange(600, dtype=np.int64) * scale)
        block = nearest.Block(pa.Table.from_batches([left]), 20, 512)
        tracemalloc.start()
        all_m, all_ids = [m], [np.arange(600) * scale]
        block.meet(left)
        for s in range(600, 40_600, 4000):
            more, b = batch(np.arange(s, s + 4000, dtype=np.int64) * scale)
            block.meet(b)
            all_m.append(more)
            all_ids.append(np.arange(s, s + 4000) * scale)
        lists = pa.Table.from_batches(block.lists()).to_pandas()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 60 << 20, peak                      # 600 x 40,600 scores are 195 MB
        x, ids = np.concatenate(all_m), np.concatenate(all_ids)
        x /= np.linalg.norm(x, axis=1)[:, None]
        score = sim.round5(x[:600] @ x.T)
        score[np.arange(600), np.arange(600)] = -2
        want = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :20]
        assert (lists.other_id.to_numpy().reshape(600, 20) == ids[want]).all()
        assert np.allclose(lists.score.to_numpy().reshape(600, 20), np.take_along_axis(score, want, axis=1))


def test_a_category_just_over_the_limit_has_clusters_enough_to_skip_most_pairs(spark):
    rows = _grouped(n=600)
    df = spark.createDataFrame(rows, SCHEMA)
    args = dict(k=5, block_size=50, strip_size=100, chunk=16, cluster_rows=500)      # one cluster per 500 rows: two
    assert _lists(sim.vector_similarity(df, **args)) == _brute(rows, 5)
    (r,) = sim.skipped_pairs(df, **args).collect()
    assert r.clusters > 10 and r.compared < 0.5 * r.pairs, r
